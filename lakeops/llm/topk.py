"""Exact top-k search by distributed histogram selection.

Vectors become integers, floor(1024 * x).  Queries are packed into blocks and
candidates into slices; every block meets every slice in one cogroup, a matrix
product of bounded size.  Round by round each query's score range is cut into
``BINS`` bins, the counts of all slices are added up, and the range shrinks to
the bin that holds the kth score.  Only the upper tail of a slice's histogram
is sent: once k scores lie at or above a bin, no lower bin can hold the global
kth.  When every range is one score wide or few scores are left above its
lower end, the scores there are gathered and ranked; of a slice's ties at the
lower end only the k smallest ids can matter.

Cases: null vectors and vectors with null or non-finite components take no
part; a shorter vector counts as padded with zeros; rows with a null id take
no part; repeated rows are candidates each, and a query never meets rows of
its own id; queries with equal id and vector are one query; fewer than k
candidates are all returned; scores beyond a long take the nearest long.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from lakeops.llm._common import bounded_batches, stored

SCALE = 1024
BINS = 1024
SLICE = 1024                   # vectors a slice
BLOCK = 512                    # queries a block
GROUP_SLICES = 16              # slices that meet a block in one task call
LONG = 2 ** 63 - 1
EXACT = 2 ** 53                # sums below are exact in doubles
REACH = 2 ** 62

SLICES = StructType([StructField("slice", LongType()), StructField("n", IntegerType()), StructField("dim", IntegerType()),
                     StructField("ids", BinaryType()), StructField("vectors", BinaryType())])


def quantised(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, v): usable vectors as whole numbers (doubles: exact for any float)."""
    v = F.col(vector)
    usable = (F.col(vec_id).isNotNull() & v.isNotNull()
              & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)
                         & (F.abs(x.cast("double")) < float("inf"))))
    return df.filter(usable).select(
        F.col(vec_id).cast("long").alias("id"),
        F.transform(v, lambda x: F.floor(x.cast("double") * SCALE).cast("double")).alias("v"))


def sliced(vectors: DataFrame, size: int) -> DataFrame:
    """Packs vectors of each task into slices of ``size``: a row a slice, with
    ids and a zero-padded matrix."""
    bounded_batches(vectors.sparkSession)

    def packed(number, own):
        dim = max(len(v) for _, v in own)
        matrix = np.zeros((len(own), dim))
        for r, (_, v) in zip(matrix, own):
            r[:len(v)] = v
        ids = np.array([i for i, _ in own], "<i8")
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([len(own)], pa.int32()), pa.array([dim], pa.int32()),
             pa.array([ids.tobytes()], pa.binary()), pa.array([matrix.tobytes()], pa.binary())], names=SLICES.names)

    def run(batches):
        number, own = TaskContext.get().partitionId() << 40, []
        for batch in batches:
            flat = np.asarray(batch.column(1).flatten())
            ends = np.asarray(batch.column(1).value_lengths()).cumsum()
            own += zip(batch.column(0).to_pylist(), np.split(flat, ends[:-1]))
            while len(own) >= size:
                yield packed(number, own[:size])
                number, own = number + 1, own[size:]
        if own:
            yield packed(number, own)

    return vectors.mapInArrow(run, SLICES)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products, saturated to a long."""
    d = max(q.shape[1], c.shape[1])
    q, c = (np.pad(m, ((0, 0), (0, d - m.shape[1]))) for m in (q, c))
    if d * max(np.abs(q).max(initial=0), 1) * max(np.abs(c).max(initial=0), 1) < EXACT:
        return (q @ c.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])                     # rare: Python's whole numbers
    s = whole(q) @ whole(c).T
    return np.vectorize(lambda x: max(-LONG, min(LONG, x)), otypes=[np.int64])(s)


def at_least(score: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Distance above each query's lower end; scores beyond REACH count as it."""
    return np.clip(score, -REACH, REACH) - low[:, None]


def matrices(pdf: pd.DataFrame):
    """(ids, matrix) of each slice row."""
    for r in pdf.itertuples(index=False):
        yield (np.frombuffer(r.ids, "<i8"), np.frombuffer(r.vectors, "<f8").reshape(r.n, r.dim))


def query_arrays(pdf: pd.DataFrame):
    """(query numbers, ids, matrix, lows, widths) of the block's queries."""
    rows = [np.frombuffer(v, "<f8") for v in pdf["vector"]]
    m = np.zeros((len(rows), max(map(len, rows))))
    for r, x in zip(m, rows):
        r[:len(x)] = x
    return pdf["q"].to_numpy(), pdf["id"].to_numpy(), m, pdf["low"].to_numpy(), pdf["width"].to_numpy()


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best candidates of
    ``rows`` by integer inner product, ties to the smaller id."""
    spark = rows.sparkSession
    slices = stored(sliced(quantised(rows, vec_id, vector), SLICE), "topk-slices")
    wanted = (quantised(queries, vec_id, vector).distinct()
              .withColumn("q", F.xxhash64("id", "v")))
    to_bytes = StructType([StructField("q", LongType()), StructField("id", LongType()),
                           StructField("vector", BinaryType()), StructField("norm", LongType())])

    def pack(batches):
        for b in batches:
            own = [np.asarray(v.values) if v.is_valid else np.zeros(0) for v in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(2), b.column(0), pa.array([x.astype("<f8").tobytes() for x in own], pa.binary()),
                 pa.array([int(min(np.sqrt((x * x).sum()) + 1, LONG)) for x in own], pa.int64())],
                names=to_bytes.names)

    base = stored(wanted.mapInArrow(pack, to_bytes), "topk-queries")
    n_queries, n_slices = base.count(), slices.count()
    n_blocks, n_groups = max(1, -(-n_queries // BLOCK)), max(1, -(-n_slices // GROUP_SLICES))

    def longest(batches):
        for b in batches:
            norms = [float(np.sqrt((np.frombuffer(v, "<f8").reshape(n, d) ** 2).sum(1).max(initial=0)))
                     for n, d, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(norms, pa.float64())], names=["norm"])

    bound = slices.select("n", "dim", "vectors").mapInArrow(longest, "norm double").agg(F.max("norm")).first()[0] or 0.0
    block = F.pmod("q", F.lit(n_blocks)).cast("int")
    group = F.pmod(F.xxhash64("slice"), F.lit(n_groups)).cast("int")
    # every block meets every group of slices: replicate each side over the other's numbers
    left = slices.select("*", group.alias("g"), F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("b"))

    def paired(state: DataFrame) -> DataFrame:
        return state.select("*", block.alias("b"), F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))).alias("g"))

    histogram = "q long, id long, bin int, n long"

    def count(key, c: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        if not len(c) or not len(s):
            return pd.DataFrame({"q": [], "id": [], "bin": [], "n": []}).astype("int64")
        q, own, m, low, width = query_arrays(s)
        total = np.zeros((len(q), BINS), np.int64)
        for ids, vectors in matrices(c):
            above = at_least(products(m, vectors), low)
            valid = (above >= 0) & (ids[None, :] != own[:, None])
            at = np.minimum(above // width[:, None], BINS - 1) + np.arange(len(q))[:, None] * BINS
            total += np.bincount(at[valid], minlength=total.size).reshape(total.shape)
        higher = total[:, ::-1].cumsum(1)[:, ::-1] - total         # scores in higher bins of this group
        i, j = np.nonzero((total > 0) & (higher < k))
        return pd.DataFrame({"q": q[i], "id": own[i], "bin": j, "n": total[i, j]})

    # the range of scores: |score| <= |query| * longest candidate
    reach = F.least(F.ceil((F.col("norm") + 1) * F.lit(bound + 1.0)), F.lit(float(REACH))).cast("long")
    state = base.select("q", "id", "vector", (-reach).alias("low"),
                        (F.floor(reach / (BINS // 2)) + 1).cast("long").alias("width"))
    while True:
        hist = (left.groupBy("b", "g").cogroup(paired(state).groupBy("b", "g")).applyInPandas(count, histogram)
                .groupBy("q", "id", "bin").agg(F.sum("n").alias("n")))
        down = Window.partitionBy("q", "id").orderBy(F.desc("bin"))
        cut = (hist.withColumn("tail", F.sum("n").over(down)).groupBy(F.col("q").alias("_q"), F.col("id").alias("_id"))
               .agg(F.max(F.when(F.col("tail") >= k, F.col("bin"))).alias("bin"),
                    F.min(F.when(F.col("tail") >= k, F.col("tail"))).alias("tail")))
        # fewer than k scores in all: keep the lower end, nothing is left to refine
        state = stored(
            state.join(cut, (F.col("q") == F.col("_q")) & (F.col("id") == F.col("_id")), "left")
            .select("q", "id", "vector",
                    (F.col("low") + F.coalesce("bin", F.lit(0)) * F.col("width")).alias("low"),
                    F.when(F.col("bin").isNull() | (F.col("tail") <= 4 * k), F.lit(0))
                    .otherwise(F.when(F.col("width") > 1, F.ceil(F.col("width") / BINS)).otherwise(0))
                    .cast("long").alias("width")), "topk-state")
        if not state.filter("width > 0").limit(1).count():
            break
        state = state.withColumn("width", F.greatest("width", F.lit(1)))

    found = "query_id long, q long, vec_id long, score long"

    def gather(key, c: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        out = [np.zeros((0, 4), np.int64)]
        if len(c) and len(s):
            q, own, m, low, _ = query_arrays(s)
            for ids, vectors in matrices(c):
                score = products(m, vectors)
                valid = (at_least(score, low) >= 0) & (ids[None, :] != own[:, None])
                for i in np.flatnonzero(valid.any(1)):
                    j = np.flatnonzero(valid[i])
                    j = j[np.lexsort((ids[j], -score[i, j]))][:k]
                    out.append(np.column_stack([np.full(len(j), own[i]), np.full(len(j), q[i]), ids[j], score[i, j]]))
        return pd.DataFrame(np.concatenate(out), columns=["query_id", "q", "vec_id", "score"])

    last = left.groupBy("b", "g").cogroup(paired(state).groupBy("b", "g")).applyInPandas(gather, found)
    w = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return (last.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
