"""Best-two-fit packing of documents into sequences of a fixed length.

Only piece lengths matter to the packing, and there are at most ``seq_len``
different ones: Spark counts the pieces of each length (a table of at most
``seq_len`` rows, whatever the corpus), the driver plans on those counts, and
every piece finds its place from its rank among the pieces of its length.

Plan, bin by bin: fill a bin greedily with the longest pieces that fit; if room
is left, take out the smallest and put in the two unpacked pieces that fill
its expanded gap most tightly, if they fill more than it did.  Bins of equal
content are planned at once, with their number.

Cases: a null text is empty (one piece holding the end id); repeated rows are
packed each; an empty table gives no rows; a null doc_id is packed like any.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from lakeops.llm._common import map_batches, stored
from lakeops.llm.tokens import pieces

RANK_BUCKET = 100_000          # pieces ranked by one task (on average)


@dataclass
class Plan:
    """Places by length: pieces of ``length`` with ranks from ``rank`` on go to
    sequences from ``sequence`` on, ``each`` to a sequence, from ``offset`` on."""
    length: list[int] = field(default_factory=list)
    rank: list[int] = field(default_factory=list)
    each: list[int] = field(default_factory=list)
    sequence: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)
    n_sequences: int = 0

    def add(self, used: dict[int, int], times: int, ranks: np.ndarray) -> None:
        """``times`` bins that hold ``used[length]`` pieces of each length."""
        offset = 0
        for n in sorted(used, reverse=True):
            self.length.append(n)
            self.rank.append(int(ranks[n]))
            self.each.append(used[n])
            self.sequence.append(self.n_sequences)
            self.offset.append(offset)
            ranks[n] += used[n] * times
            offset += n * used[n]
        self.n_sequences += times


def two_fit(left: np.ndarray, gap: int, least: int) -> tuple[int, int] | None:
    """The two available lengths a >= b of largest sum in (least, gap]."""
    sizes = np.arange(len(left))
    below = np.maximum.accumulate(np.where(left > 0, sizes, 0))        # longest available <= x
    a = sizes[1:gap][left[1:gap] > 0]
    if not len(a):
        return None
    b = below[np.minimum(gap - a, a)]
    single = (b == a) & (left[a] < 2)
    b = np.where(single, below[np.maximum(a - 1, 0)], b)
    total = np.where(b > 0, a + b, 0)
    k = int(np.argmax(total))
    return (int(a[k]), int(b[k])) if total[k] > least else None


def best_two_fit(counts: dict[int, int], seq_len: int) -> Plan:
    """The plan for ``counts[length]`` pieces of each length (1..seq_len)."""
    left = np.zeros(seq_len + 1, np.int64)
    for n, c in counts.items():
        left[n] = c
    ranks, plan = np.zeros(seq_len + 1, np.int64), Plan()
    while left.any():
        below = np.maximum.accumulate(np.where(left > 0, np.arange(seq_len + 1), 0))
        used, gap = {}, seq_len
        n = int(below[gap])
        while n:
            used[n] = int(min(gap // n, left[n]))
            gap -= used[n] * n
            n = int(below[min(gap, n - 1)])
        if gap:
            least = min(used)
            rest = left.copy()
            for n, c in used.items():
                rest[n] -= c
            pair = two_fit(rest, gap + least, least)
            if pair:
                used[least] -= 1
                for n in pair:
                    used[n] = used.get(n, 0) + 1
                used = {n: c for n, c in used.items() if c}
        times = int(min(left[n] // c for n, c in used.items()))
        plan.add(used, times, ranks)
        for n, c in used.items():
            left[n] -= c * times
    return plan


def ranked(parts: DataFrame, n_pieces: int) -> DataFrame:
    """Adds ``rank``: the piece's number among those of its length.  Each
    length is ranked in hashed buckets of about RANK_BUCKET pieces."""
    n = max(1, -(-n_pieces // RANK_BUCKET))
    b = parts.withColumn("_b", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n)))
    w = Window.partitionBy("length", "_b").orderBy("doc_id", "piece", "ids_crc32")
    first = (b.groupBy("length", "_b").agg(F.count("*").alias("_n"))
             .withColumn("_first", F.sum("_n").over(Window.partitionBy("length").orderBy("_b")) - F.col("_n"))
             .select(F.col("length").alias("_length"), F.col("_b").alias("_b2"), "_first"))
    return (b.withColumn("_r", F.row_number().over(w) - 1)
            .join(first, (F.col("length") == F.col("_length")) & (F.col("_b") == F.col("_b2")))
            .withColumn("rank", F.col("_r") + F.col("_first"))
            .select(*parts.columns, "rank"))


def placed(parts: DataFrame, plan: Plan) -> DataFrame:
    """Adds sequence_id and offset from the rank; the plan is a few numbers
    for each length and distinct bin, at any number of pieces."""
    order = np.lexsort((plan.rank, plan.length))
    length, rank, each, seq, off = (np.array(x, np.int64)[order] for x in
                                    (plan.length, plan.rank, plan.each, plan.sequence, plan.offset))
    keys = (length << 48) + rank
    schema = StructType([f for f in parts.schema.fields if f.name != "rank"]
                        + [StructField("sequence_id", LongType()), StructField("offset", LongType())])
    names = parts.columns
    n_at, r_at = names.index("length"), names.index("rank")

    def make():
        def step(batch):
            n = batch.column(n_at).to_numpy(zero_copy_only=False).astype(np.int64)
            r = batch.column(r_at).to_numpy(zero_copy_only=False).astype(np.int64)
            k = np.searchsorted(keys, (n << 48) + r, side="right") - 1
            at = r - rank[k]
            return ([batch.column(i) for i in range(len(names)) if i != r_at]
                    + [pa.array(seq[k] + at // each[k]), pa.array(off[k] + at % each[k] * n)])
        return step

    return map_batches(parts, make, schema)


def pack(docs: DataFrame, tokenizer: str, seq_len: int = 2048, eos: int = 0) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    parts = stored(pieces(docs, tokenizer, seq_len, eos), "pack-pieces")
    counts = {r["length"]: r["n"] for r in                     # at most seq_len rows
              parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = best_two_fit(counts, seq_len)
    return placed(ranked(parts, sum(counts.values())), plan)
