"""Exact k-nearest-neighbour search by cosine similarity.

Scale design
------------
The vector table is never shuffled and no (query, vector) pair is
materialised as a row.  Query vectors are shipped to the tasks as a
broadcast variable, but only after their count is checked: at most
``max_broadcast_queries`` per pass; more queries are split by hash into
several passes over the vectors.  Each task scores its Arrow batches against
the queries with numpy (in query blocks to bound memory) and keeps a running
top-k per query, so a task emits at most ``queries x k`` candidate rows.  The
final top-k per query is taken over ``tasks x k`` candidates.  Ties are broken
by the smaller vector id, so results are exact and deterministic.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CANDIDATE_SCHEMA = "query_id long, vec_id long, score double"


def _normalise(m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    norms[norms == 0] = np.nan
    return m / norms


def _merge_topk(ids, scores, k):
    """Top k of one query's candidates by (score desc, id asc)."""
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _score_partition(batches, q_ids, q_mat, k, id_col, vec_col, block=256):
    best = {int(q): (np.empty(0, np.int64), np.empty(0, np.float64)) for q in q_ids}
    for pdf in batches:
        if pdf.empty:
            continue
        ids = pdf[id_col].to_numpy(np.int64)
        mat = _normalise(np.stack(pdf[vec_col].to_numpy()).astype(np.float64))
        for start in range(0, len(q_ids), block):
            qb = q_mat[start:start + block]
            scores = mat @ qb.T                      # rows x queries
            for j in range(qb.shape[0]):
                qid = int(q_ids[start + j])
                s = scores[:, j]
                keep = ~np.isnan(s)
                s, i = s[keep], ids[keep]
                if len(s) > k:
                    kth = np.partition(-s, k - 1)[k - 1]
                    sel = -s <= kth                  # keeps every tie of the k-th score
                    s, i = s[sel], i[sel]
                bi, bs = best[qid]
                best[qid] = _merge_topk(np.concatenate([bi, i]), np.concatenate([bs, s]), k)
    rows = [(q, int(i), float(s)) for q, (ii, ss) in best.items() for i, s in zip(ii, ss)]
    yield pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype(
        {"query_id": "int64", "vec_id": "int64", "score": "float64"})


def usable(vector: str):
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull()), F.lit(False))


def vector_topk(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
                vec_col: str = "embedding", query_id: str = "query_id", query_vec: str = "query",
                max_broadcast_queries: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score) for the k most similar vectors of each query.

    Vectors that are null or hold a null take no part, nor do null vector ids;
    query ids must be unique."""
    spark = vectors.sparkSession
    queries = queries.filter(usable(query_vec))
    n_queries, n_ids = queries.agg(F.count("*"), F.count_distinct(query_id)).first()   # before any broadcast
    if n_ids != n_queries:
        raise ValueError(f"{n_queries} query vectors have {n_ids} ids: ids must be unique and not null")
    passes = max(1, math.ceil(n_queries / max_broadcast_queries))
    vec = vectors.filter(F.col(id_col).isNotNull() & usable(vec_col)).select(F.col(id_col).cast("long").alias(id_col),
                                                                             F.col(vec_col))
    results = None
    for p in range(passes):
        part = queries if passes == 1 else queries.filter(
            F.pmod(F.xxhash64(F.col(query_id)), F.lit(passes)) == p)
        local = part.select(F.col(query_id).cast("long"), F.col(query_vec)).toPandas()
        if local.empty:
            continue
        q_ids = local[query_id].to_numpy(np.int64)
        q_mat = _normalise(np.stack(local[query_vec].to_numpy()).astype(np.float64))
        bc = spark.sparkContext.broadcast((q_ids, q_mat))

        def score(batches, bc=bc):
            ids_, mat_ = bc.value
            yield from _score_partition(batches, ids_, mat_, k, id_col, vec_col)

        cand = vec.mapInPandas(score, CANDIDATE_SCHEMA)
        results = cand if results is None else results.unionByName(cand)
    if results is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = results.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def label_centroids(vectors: DataFrame, label: str = "label", vec_col: str = "embedding") -> DataFrame:
    """Mean vector per label (element-wise, by position): the per-position
    averages are a partial aggregate; each label's array has the vector's
    dimension, whatever the row count."""
    e = vectors.select(F.col(label), F.posexplode(vec_col).alias("i", "x"))
    per_pos = e.groupBy(label, "i").agg(F.avg("x").alias("x"))
    return (per_pos.groupBy(label).agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("s"))
            .select(F.col(label), F.transform("s", lambda t: t["x"]).alias("query")))
