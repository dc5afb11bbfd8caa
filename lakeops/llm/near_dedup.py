"""Near-duplicate documents by ProbMinHash over weighted word shingles.

Similarity is the probability Jaccard of two weighted sets (shingles of
``WORDS`` words, weighted by how often they occur): with equal weights it is
the plain Jaccard.  A signature has M components; every shingle is a Poisson
process whose rate is its weight, each arrival picks a component at random, and
a component keeps the shingle that arrives first.  A shingle stops as soon as
its next arrival comes after the last component's time (early termination).

Copies of one word sequence are first reduced to a representative (the
smallest doc_id).  BANDS bands of ROWS components give buckets; a pair at 0.8
misses all buckets with probability 6e-5.  Candidates are verified exactly, in
rounds that avoid pairs within a group: each representative against the
smallest one it shares a bucket with; then against the smallest of each bucket
that has not linked to the same; then, in buckets that still hold several components,
pairs of different components only.  In buckets with more than ``CROWD`` such
pairs for each row, the rows outside the largest component first meet one row of
it, which only saves pairs: all of different components that are left then meet
in a last round, in blocks of ``BLOCK`` rows against each other, so that no task
holds a whole bucket.  What makes these pairs leaves out those whose weights
and parity bitmaps (Sandes et al. 2017) already bound the similarity below the
threshold, and a pair of a crowd that shares several buckets is verified in one of
them only; neither loses a link, and all other pairs are verified.

Result: one row a document with its class (the smallest doc_id of its
connected component of links).

Cases: documents without words and rows with a null doc_id take no part (no
class, kept); documents of fewer than WORDS words are one shingle; rows that
repeat a doc_id are one document: all stay or all go, and a link of any of
their texts counts; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (ArrayType, BinaryType, DoubleType, IntegerType, LongType, StructField,
                               StructType)

from lakeops.llm._common import map_batches, side, stored

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 6
M = BANDS * ROWS
BITS = 512                     # of a parity bitmap
CROWD = 16                     # pairs for each row of a bucket that meets no hub first
BLOCK = 512                    # rows of a crowd that one task holds, twice
STEP = 32                      # of these against a block at a time
MAX_CACHE = 200_000

# Fixed values of the splitmix64 generator (Steele, Lea, Flood 2014).
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


#: odd multipliers by position, for shingles and bands
ODD = mix(np.arange(1, M + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= MAX_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def shingles(text: str | None, hashes: WordHashes) -> tuple[bytes | None, np.ndarray, np.ndarray]:
    """(key of the word sequence, sorted shingle hashes, weights)."""
    words = (text or "").split()
    if not words:
        return None, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(WORDS, len(w))
    s = np.zeros(len(w) - n + 1, np.uint64)
    for j in range(n):
        s += w[j:len(w) - n + 1 + j] * ODD[j]
    sets, weights = np.unique(mix(s), return_counts=True)
    return xxhash.xxh3_128_digest(w), sets, weights


def signatures(sets: list[np.ndarray], weights: list[np.ndarray]) -> np.ndarray:
    """(documents, M): for each component the shingle that arrives first."""
    n_docs = len(sets)
    first = np.full(n_docs * M, np.inf)
    sig = np.zeros(n_docs * M, np.uint64)
    doc = np.repeat(np.arange(n_docs), [len(s) for s in sets])
    item = np.concatenate(sets) if n_docs else np.zeros(0, np.uint64)
    rate = (np.concatenate(weights) if n_docs else np.zeros(0)).astype(np.float64)
    time, drawn, step = np.zeros(len(item)), 0, 1
    while len(item):
        k = np.arange(drawn + 1, drawn + 1 + step, dtype=np.uint64)
        u = mix(mix(item[:, None] + k * GOLDEN))
        gap = -np.log(((u >> np.uint64(24)).astype(np.float64) + 0.5) * 2.0 ** -40) / rate[:, None]
        at = time[:, None] + np.cumsum(gap, axis=1)
        part = ((u & np.uint64(0xFFFFFF)) * np.uint64(M) >> np.uint64(24)).astype(np.int64) + doc[:, None] * M
        at_, part_ = at.ravel(), part.ravel()
        np.minimum.at(first, part_, at_)
        won = np.flatnonzero(at_ == first[part_])
        sig[part_[won]] = np.repeat(item, step)[won]
        last = first.reshape(n_docs, M).max(axis=1)
        go = at[:, -1] < last[doc]                                 # early termination
        doc, item, rate, time = doc[go], item[go], rate[go], at[go, -1]
        drawn += step
        step = min(2 * step, 256) if drawn > 2 else 1
    return sig.reshape(n_docs, M)


def bands(sig: np.ndarray) -> np.ndarray:
    """(documents, BANDS): a hash of each band's components and number."""
    parts = (sig * ODD[:M]).reshape(len(sig), BANDS, ROWS).sum(axis=2, dtype=np.uint64)
    return mix(parts + np.arange(BANDS, dtype=np.uint64) * GOLDEN).view(np.int64)


def parities(sets: list[np.ndarray], weights: list[np.ndarray]) -> np.ndarray:
    """(documents, BITS / 64) words: every shingle's every occurrence flips a bit,
    so two bitmaps differ in at most as many bits as the bags differ in members."""
    n_docs = len(sets)
    rate = np.concatenate(weights) if n_docs else np.zeros(0, np.int64)
    item = np.repeat(np.concatenate(sets) if n_docs else np.zeros(0, np.uint64), rate)
    doc = np.repeat(np.arange(n_docs), [int(w.sum()) for w in weights])
    nth = np.arange(len(item)) - np.repeat(np.cumsum(rate) - rate, rate)
    bit = (mix(item + nth.astype(np.uint64) * GOLDEN) % np.uint64(BITS)).astype(np.int64)
    odd = np.bincount(doc * BITS + bit, minlength=n_docs * BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(n_docs, BITS // 64)


def possible(x: Callable[[str], Column], y: Callable[[str], Column], threshold: float) -> Column:
    """Whether the similarity can reach the threshold, by ``total`` weights, ``n``
    distinct shingles and ``parity`` bitmaps of both.

    With d members in one bag only, S both totals, m the smaller one: a shingle of
    equal weight w in both adds w / ((S + d) / 2); one of unequal weights adds at
    most its smaller weight / m, and these smaller weights sum up to at most what
    repeats add to the totals, S less both n.  All equal ones and those weigh
    (S - d) / 2 together.  The bound falls with d, which is at least the differing
    bits and the difference of the totals.
    """
    bits = sum((F.bit_count(F.get(x("parity"), F.lit(i)).bitwiseXOR(F.get(y("parity"), F.lit(i))))
                for i in range(BITS // 64)), F.lit(0))
    both = x("total") + y("total")
    d = F.greatest(bits.cast("long"), F.abs(x("total") - y("total")))
    common = (both - d) / 2
    unequal = F.least(common, (both - x("n") - y("n")).cast("double"))
    return (common - unequal) * 2 / (both + d) + unequal / F.least(x("total"), y("total")) >= threshold - 1e-9


def similarity(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Probability Jaccard of two weighted sets (sorted distinct hashes)."""
    both, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    x, y = wa[i].astype(np.float64), wb[j].astype(np.float64)
    only_a, only_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    pairs, n = np.unique(np.stack([x, y]), axis=1, return_counts=True)
    return float(sum(c / (n @ np.maximum(pairs[0] / p, pairs[1] / q) + only_a / p + only_b / q)
                     for p, q, c in zip(pairs[0], pairs[1], n)))


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, bands, parity, n, total) of every document with words."""
    schema = StructType([docs.schema["doc_id"], StructField("key", BinaryType()),
                         StructField("bands", ArrayType(LongType())), StructField("parity", ArrayType(LongType())),
                         StructField("n", LongType()), StructField("total", LongType())])

    def lists(words: np.ndarray) -> pa.Array:
        n, width = words.shape
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(words.ravel(), pa.int64()))

    def make():
        hashes = WordHashes()

        def step(batch):
            found = [shingles(t, hashes) for t in batch.column(1).to_pylist()]
            sets, weights = [f[1] for f in found], [f[2] for f in found]
            return [batch.column(0), [f[0] for f in found], lists(bands(signatures(sets, weights))),
                    lists(parities(sets, weights)), [len(x) for x in sets], [int(w.sum()) for w in weights]]
        return step

    return map_batches(docs.select("doc_id", "text"), make, schema).filter(F.col("key").isNotNull())


def shingled(docs: DataFrame) -> DataFrame:
    """(doc, items, weights): shingle sets; weights are null where all are 1."""
    schema = StructType([StructField("doc", docs.schema["doc_id"].dataType), StructField("items", BinaryType()),
                         StructField("weights", BinaryType())])

    def make():
        hashes = WordHashes()

        def step(batch):
            found = [shingles(t, hashes) for t in batch.column(1).to_pylist()]
            return [batch.column(0), [f[1].tobytes() for f in found],
                    [None if (f[2] == 1).all() else f[2].astype("<i4").tobytes() for f in found]]
        return step

    return map_batches(docs.select("doc_id", "text"), make, schema)


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The stored pairs (a, b) with a similarity of ``threshold`` or more."""
    schema = StructType([f for f in pairs.schema.fields] + [StructField("sim", DoubleType())])
    left = sets.select(F.col("doc").alias("a"), F.col("items").alias("ia"), F.col("weights").alias("wa"))
    right = sets.select(F.col("doc").alias("b"), F.col("items").alias("ib"), F.col("weights").alias("wb"))
    rows = right.join(side(pairs), "b").join(left, "a").select("a", "b", "ia", "wa", "ib", "wb")

    def make():
        def step(batch):
            sims = []
            for ia, wa, ib, wb in zip(*[batch.column(i).to_pylist() for i in range(2, 6)]):
                x, y = np.frombuffer(ia, np.uint64), np.frombuffer(ib, np.uint64)
                sims.append(similarity(x, np.ones(len(x)) if wa is None else np.frombuffer(wa, "<i4"),
                                       y, np.ones(len(y)) if wb is None else np.frombuffer(wb, "<i4")))
            return [batch.column(0), batch.column(1), sims]
        return step

    return stored(map_batches(rows, make, schema).filter(F.col("sim") >= threshold - 1e-12), "near-links")


def stars(edges: DataFrame) -> bool:
    """Whether every u has one edge and no v is a u: the components are found."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up")),
                                          F.struct(F.col("v").alias("x"), F.lit(0).alias("up")))).alias("e")).select("e.*")
    return not (ends.groupBy("x").agg(F.sum("up").alias("n"), F.min("up").alias("low"))
                .filter("n > 1 OR (n = 1 AND low = 0)").limit(1).count())


def components(links: DataFrame) -> DataFrame:
    """(doc, class) of every linked document: the smallest id of its connected
    component, by alternating large-star and small-star steps (Kiveris et al.
    2014) until the edges are stars."""
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .filter("u <> v").distinct(), "near-edges")
    while not stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("x")).agg(F.least(F.min("v"), F.col("x")).alias("m"))
        large = (both.join(low, F.col("u") == F.col("x")).filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        low = large.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"))
        small = (large.join(low, F.col("u") == F.col("x"))
                 .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").filter("u <> v").distinct())
        edges = stored(small, "near-edges")
    return edges.select(F.col("u").alias("doc"), F.col("v").alias("class")).unionByName(
        edges.select(F.col("v").alias("doc"), F.col("v").alias("class")).distinct())


def labelled(buckets: DataFrame, classes: DataFrame) -> DataFrame:
    """Adds ``c``, the present component of ``rep``."""
    return (buckets.join(classes.select(F.col("doc").alias("_d"), F.col("class").alias("_c")),
                         F.col("rep") == F.col("_d"), "left")
            .withColumn("c", F.coalesce("_c", "rep")).drop("_d", "_c"))


def mixed(rows: DataFrame) -> DataFrame:
    """The rows (h, rep, c) of buckets that hold several components, with
    the bucket's largest component ``most``, one row ``hub`` of it, and whether the
    bucket is a ``crowd``: more than CROWD pairs of different components a row."""
    n, square = F.sum("n").cast("double"), F.sum(F.col("n").cast("double") * F.col("n"))
    sizes = (rows.groupBy(F.col("h").alias("_h"), "c")
             .agg(F.count("*").alias("n"), F.max("rep").alias("hub"))
             .groupBy("_h").agg(F.count("*").alias("k"), F.max(F.struct("n", "c", "hub")).alias("x"),
                                (n * n - square > 2 * CROWD * n).alias("crowd"))
             .filter("k > 1").select("_h", F.col("x.c").alias("most"), F.col("x.hub").alias("hub"), "crowd"))
    return rows.join(sizes, F.col("h") == F.col("_h")).select("h", "rep", "c", "most", "hub", "crowd")


def may_reach(px: np.ndarray, nx: np.ndarray, tx: np.ndarray, py: np.ndarray, ny: np.ndarray, ty: np.ndarray,
              threshold: float) -> np.ndarray:
    """``possible`` of every row of x with every row of y: (x, y) bools."""
    bits = np.bitwise_count(px[:, None, :] ^ py[None, :, :]).sum(axis=2, dtype=np.int64)
    both = tx[:, None] + ty[None, :]
    d = np.maximum(bits, np.abs(tx[:, None] - ty[None, :]))
    common = (both - d) / 2
    unequal = np.minimum(common, both - (nx[:, None] + ny[None, :]))
    return (common - unequal) * 2 / (both + d) + unequal / np.minimum(tx[:, None], ty[None, :]) >= threshold - 1e-9


def crowd_links(rows: DataFrame, threshold: float) -> DataFrame:
    """(a, b, sim) of every pair of different components in a bucket that reaches
    the threshold, verified once for all the buckets it shares."""
    size = rows.groupBy(F.col("h").alias("_h")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = (rows.join(size, F.col("h") == F.col("_h")).withColumn("own", own)
             .select("h", "rep", "c", "bands", "parity", "n", "total", "items", "weights", "own",
                     F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
             .select("h", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own",
                     "rep", "c", "bands", "parity", "n", "total", "items", "weights"))
    rep = rows.schema["rep"].dataType
    schema = StructType([StructField("a", rep), StructField("b", rep), StructField("sim", DoubleType())])
    to = to_arrow_schema(schema)

    def meet(key, group):
        h, i, j = (k.as_py() for k in key)
        ids = group.column("rep").combine_chunks()
        c = np.unique(group.column("c").to_numpy(), return_inverse=True)[1]
        side_, n, total = (group.column(x).to_numpy() for x in ("own", "n", "total"))
        band, parity = (np.array(group.column(x).to_pylist(), np.int64) for x in ("bands", "parity"))
        parity = parity.view(np.uint64)
        a, b = np.flatnonzero(side_ == i), np.flatnonzero(side_ == j)
        items = [np.frombuffer(x, np.uint64) for x in group.column("items").to_pylist()]
        weights = [np.ones(len(x)) if w is None else np.frombuffer(w, "<i4")
                   for x, w in zip(items, group.column("weights").to_pylist())]
        left, right, sims = [], [], []
        for at in range(0, len(a), STEP):
            p = a[at:at + STEP]
            meets = may_reach(parity[p], n[p], total[p], parity[b], n[b], total[b], threshold)
            meets &= c[p][:, None] != c[b][None, :]
            if i == j:
                meets &= p[:, None] < b[None, :]
            k, m = np.nonzero(meets)
            k, m = p[k], b[m]
            # a band's hash has its number, so shared bands stand at one place
            first = ~((band[k] == band[m]) & (band[k] < h)).any(axis=1)
            for x, y in zip(k[first].tolist(), m[first].tolist()):
                sim = similarity(items[x], weights[x], items[y], weights[y])
                if sim >= threshold - 1e-12:
                    left.append(x)
                    right.append(y)
                    sims.append(sim)
        k, m = pa.array(left, pa.int64()), pa.array(right, pa.int64())
        return pa.Table.from_arrays([ids.take(k), ids.take(m), pa.array(sims, pa.float64())], schema=to)

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(parts, "h", "i", "j").groupBy("h", "i", "j").applyInArrow(meet, schema)


def near_duplicates(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id, kept): kept is true for one document of each class,
    the one with the smallest doc_id."""
    every, docs = docs.select("doc_id"), docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull())
    marks = stored(signed(docs), "near-signatures")
    copies = stored(marks.groupBy("key").agg(F.min(F.struct("doc_id", "bands", "parity", "n", "total")).alias("x"))
                    .select("key", F.col("x.doc_id").alias("rep"), "x.bands", "x.parity", "x.n", "x.total"), "near-copies")
    rows = copies.select("rep", F.explode("bands").alias("h"))
    lead = rows.groupBy(F.col("h").alias("_h")).agg(F.min("rep").alias("lead"), F.count("*").alias("n")).filter("n > 1")
    buckets = stored(rows.join(lead, F.col("h") == F.col("_h")).select("h", "rep", "lead"), "near-buckets")

    wanted = stored(buckets.select(F.col("rep").alias("doc")).distinct(), "near-wanted")
    sets = stored(shingled(docs.join(side(wanted, 2_000_000), F.col("doc_id") == F.col("doc"), "left_semi")),
                  "near-sets")

    # each representative against the smallest it shares a bucket with
    pairs = stored(buckets.groupBy(F.col("rep").alias("b")).agg(F.min("lead").alias("a")).filter("a <> b")
                   .select("a", "b"), "near-pairs")
    tested = pairs
    links = verified(pairs, sets, threshold)
    # one link each, to a smaller one, so two that have linked to the same need no test
    classes = links.select(F.col("b").alias("doc"), F.col("a").alias("class"))

    # against the smallest of each bucket, where these differ
    own = labelled(buckets, classes)
    other = classes.select(F.col("doc").alias("_d"), F.col("class").alias("_c"))
    pairs = stored(own.join(other, F.col("lead") == F.col("_d"), "left").filter(F.coalesce("_c", "lead") != F.col("c"))
                   .select(F.col("lead").alias("a"), F.col("rep").alias("b")).distinct()
                   .join(tested, ["a", "b"], "left_anti"), "near-pairs")
    tested = tested.unionByName(pairs)
    links = links.unionByName(verified(pairs, sets, threshold))
    classes = stored(components(links), "near-classes")

    # pairs of different components in the buckets that still hold several; crowds
    # first meet a hub of their largest component, and what is left of them then
    # meets in full
    own = labelled(buckets.select("h", "rep"), classes)
    again = stored(mixed(own).join(copies.select("rep", "parity", "n", "total"), "rep"), "near-mixed")
    few, crowd = again.filter(~F.col("crowd")), again.filter("crowd")
    x, y = few.filter("c <> most").alias("l"), few.alias("r")
    left, right = (lambda c: F.col(f"l.{c}")), (lambda c: F.col(f"r.{c}"))
    pairs = (x.join(y, (left("h") == right("h")) & (left("c") != right("c"))
                    & ((right("c") == left("most")) | (left("rep") < right("rep")))
                    & possible(left, right, threshold)).select(left("rep").alias("x"), right("rep").alias("y"))
             .unionByName(crowd.filter("c <> most").select(F.col("rep").alias("x"), F.col("hub").alias("y"))))
    pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    pairs = stored(pairs.join(tested, ["a", "b"], "left_anti"), "near-pairs")
    links = links.unionByName(verified(pairs, sets, threshold))
    classes = stored(components(links), "near-classes")
    if crowd.limit(1).count():
        rest = stored(mixed(labelled(crowd.select("h", "rep"), classes)).select("h", "rep", "c"), "near-crowd")
        facts = (copies.select("rep", "bands", "parity", "n", "total")
                 .join(sets.select(F.col("doc").alias("rep"), "items", "weights"), "rep"))
        links = links.unionByName(stored(crowd_links(rest.join(facts, "rep"), threshold), "near-links"))
        classes = stored(components(links), "near-classes")

    found = (marks.select("doc_id", "key").join(copies.select(F.col("key").alias("_k"), "rep"), F.col("key") == F.col("_k"))
             .join(classes.select(F.col("doc").alias("_d"), "class"), F.col("rep") == F.col("_d"), "left")
             .select("doc_id", F.coalesce("class", "rep").alias("class_id")))
    one = found.groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    return (every.join(one.withColumnRenamed("doc_id", "_id"), F.col("doc_id") == F.col("_id"), "left")
            .select("doc_id", "class_id", (F.col("class_id").isNull() | (F.col("class_id") == F.col("doc_id"))).alias("kept")))


def drop_near_duplicates(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, without the later documents of a class."""
    mark = "_gone"
    while mark in docs.columns:
        mark = "_" + mark
    drop = stored(near_duplicates(docs, threshold).filter(~F.col("kept")).select(F.col("doc_id").alias(mark)).distinct(),
                  "near-drop")
    return docs.join(side(drop, 2_000_000), F.col("doc_id") == F.col(mark), "left_anti")
