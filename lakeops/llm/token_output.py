"""Packed token-id matrices: best-fit-decreasing packing in bounded buffers.

Every task tokenizes its documents, cuts overlong ones into pieces without
loss, and packs a buffer of about ``buffer_tokens`` ids at a time: pieces in
decreasing order, each into the open row with the least sufficient room, found
in a segment tree over capacities.  No shuffle, and memory is bounded by the
buffer, so a task of any size and a lost executor cost nothing but a rerun; the
price is at most a few part-filled rows a buffer.

Cases: null and empty texts give the end id alone; repeated rows are packed
each; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from lakeops.llm._common import bounded_batches
from lakeops.llm.tokens import token_ids, word_ids


class CapacityTree:
    """Segment tree over capacities 0..size: finds the least capacity at or
    above a length that has an open bin."""

    def __init__(self, size: int):
        self.leaves = 1
        while self.leaves <= size:
            self.leaves *= 2
        self.open = [0] * (2 * self.leaves)          # bins below each node
        self.bins: list[list[int]] = [[] for _ in range(size + 1)]

    def _count(self, capacity: int, by: int) -> None:
        i = capacity + self.leaves
        while i:
            self.open[i] += by
            i //= 2

    def put(self, capacity: int, bin_no: int) -> None:
        self.bins[capacity].append(bin_no)
        self._count(capacity, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """Removes a bin of the least capacity >= length: (capacity, bin)."""
        i = length + self.leaves
        if not self.open[i]:
            while i > 1 and (i % 2 or not self.open[i + 1]):      # up, until a right sibling has bins
                i //= 2
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.open[2 * i] else 2 * i + 1
        capacity = i - self.leaves
        bin_no = self.bins[capacity].pop()
        self._count(capacity, -1)
        return capacity, bin_no


def best_fit_decreasing(lengths: list[int], seq_len: int) -> list[list[int]]:
    """Bins of piece numbers; ties in input order."""
    tree, bins = CapacityTree(seq_len), []
    for k in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[k])
        if found is None:
            found = seq_len, len(bins)
            bins.append([])
        bins[found[1]].append(k)
        tree.put(found[0] - lengths[k], found[1])
    return bins


SCHEMA = [StructField("doc_ids", ArrayType(LongType())), StructField("pieces", ArrayType(IntegerType())),
          StructField("starts", ArrayType(LongType())), StructField("n_tokens", IntegerType()),
          StructField("input_ids", BinaryType()), StructField("cu_seqlens", ArrayType(IntegerType())),
          StructField("position_ids", BinaryType())]


def packed_matrices(docs: DataFrame, tokenizer: str, seq_len: int = 2048, eos: int = 0, pad: int = 0,
                    dtype: str = "<u2", buffer_tokens: int = 4_000_000) -> DataFrame:
    """One row a sequence: sequence_id, the doc_ids, piece numbers and starts of
    its segments, n_tokens, input_ids and position_ids (``seq_len`` numbers of
    ``dtype`` each, padded with ``pad`` and 0; positions restart in every
    segment) and cu_seqlens (0, then the end of each segment).  doc_ids are
    long; a vocabulary that does not fit ``dtype`` is refused."""
    from tokenizers import Tokenizer
    largest = max([eos, pad, Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True) - 1])
    if largest > np.iinfo(dtype).max:
        raise ValueError(f"ids up to {largest} don't fit {dtype}")
    schema = StructType([StructField("sequence_id", LongType())] + SCHEMA)
    out = to_arrow_schema(schema)
    bounded_batches(docs.sparkSession)

    def rows(buffer, first):
        lengths = [len(p[3]) for p in buffer]
        cols = [[] for _ in out]
        resets = np.arange(seq_len, dtype=dtype)
        for n, members in enumerate(best_fit_decreasing(lengths, seq_len)):
            ids, pos = np.full(seq_len, pad, dtype), np.zeros(seq_len, dtype)
            ends = [0]
            for k in members:
                a, b = ends[-1], ends[-1] + lengths[k]
                ids[a:b], pos[a:b] = buffer[k][3], resets[:lengths[k]]
                ends.append(b)
            for c, x in zip(cols, (first + n, [buffer[k][0] for k in members], [buffer[k][1] for k in members],
                                   [buffer[k][2] for k in members], ends[-1], ids.tobytes(), ends, pos.tobytes())):
                c.append(x)
            if len(cols[0]) == 512:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, out)], schema=out)
                cols = [[] for _ in out]
        if cols[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, out)], schema=out)

    def run(batches):
        words, made = word_ids(tokenizer), TaskContext.get().partitionId() << 40
        buffer, size = [], 0
        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), token_ids(batch.column(1).to_pylist(), words, eos)):
                ids = ids.astype(dtype)
                for k, s in enumerate(range(0, len(ids), seq_len)):
                    buffer.append((doc, k, s, ids[s:s + seq_len]))
                    size += len(buffer[-1][3])
                    if size >= buffer_tokens:
                        for b in rows(buffer, made):
                            made += b.num_rows
                            yield b
                        buffer, size = [], 0
        for b in rows(buffer, made):
            yield b

    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(run, schema)


def write_matrices(packed: DataFrame, path: str) -> None:
    """Writes the rows as Parquet files: input_ids is the id matrix, a row a sequence."""
    packed.write.option("compression", "zstd").parquet(path)
