"""Rolling (RANGE-frame) window aggregates over event time.

Frames are ``[sec - lower, sec - upper]`` over whole epoch seconds, so rows in
the same second are peers and all share one result (Spark RANGE semantics).

Scale design
------------
``Window.partitionBy(key)`` sends every row of a key to one task; a key that
holds a third of all rows would then run in a single task.  Two exact
strategies avoid that:

**cells** (sums, counts, least and greatest values, the default for them).
Rows are first reduced to one row per distinct (key, second), so duplicates of
a hot key collapse map-side.  Time is cut into cells of a day (or of the
shortest frame, where that is shorter).  A frame from ``a`` to ``e`` is the
rest of a's cell from ``a`` on, the whole cells between, and e's cell up to
``e``; the three parts are merged, never subtracted, so any associative
aggregate is exact and NaN, infinities, very large and very small values give
what the plain window gives.  The ends come from one window pass per
(key, cell), a group of 86,400 seconds at most however hot the key, in which a
"probe" row stands at every frame's start; the cells between come from a
window over the small key x cell table.  The parts meet again by (key, second)
and are joined back to the rows.

**halo** (any aggregate).  We partition by ``(key, time bucket)``.  A row belongs to bucket ``floor(sec / B)``;
because a frame only looks back ``W = max(lower)`` seconds, the rows of the
last ``W`` seconds of a bucket are also copied ("halo") into the following
buckets.  Each output row is computed inside its own bucket, where the halo
makes the frame complete, so the result is exact.  Copies per row are
``1 + ceil(W / B)`` at most and ``1 + W / B`` on average; with the default
``B = 4 W`` that is a 1.25x shuffle.  A hot key is spread over as many tasks
as it has buckets.  All frames share one Exchange and one Sort.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86400
HOUR = 3600

#: How an aggregate starts from rows, and how its partial values are merged.
MONOIDS = {
    "sum": (F.sum, F.sum),
    "count": (F.count, F.sum),
    "min": (F.min, F.min),
    "max": (F.max, F.max),
}


@dataclass(frozen=True)
class Frame:
    """One rolling aggregate: ``name = agg`` over ``[sec-lower, sec-upper]``.

    ``kind``/``column`` mark the aggregates of ``MONOIDS``, which the cells
    strategy can compute; use the ``sum_frame``, ``count_frame``, ``min_frame``
    and ``max_frame`` constructors for those.
    """

    name: str
    agg: Column
    lower: int
    upper: int = 0
    kind: str | None = None
    column: str | None = None


def sum_frame(name: str, column: str, lower: int, upper: int = 0) -> Frame:
    return Frame(name, F.sum(column), lower, upper, "sum", column)


def count_frame(name: str, lower: int, upper: int = 0, column: str | None = None) -> Frame:
    """Rows of the frame, or those with a value in ``column``."""
    return Frame(name, F.count(F.lit(1) if column is None else column), lower, upper, "count", column)


def min_frame(name: str, column: str, lower: int, upper: int = 0) -> Frame:
    return Frame(name, F.min(column), lower, upper, "min", column)


def max_frame(name: str, column: str, lower: int, upper: int = 0) -> Frame:
    return Frame(name, F.max(column), lower, upper, "max", column)


def rolling_aggregate(df: DataFrame, keys: list[str], seconds_col: str,
                      frames: list[Frame], bucket_seconds: int | None = None,
                      strategy: str = "auto") -> DataFrame:
    """Adds one column per frame; one output row per input row.

    ``seconds_col`` must be an integral epoch-seconds column.  Rows with a NULL
    key form their own partition, as in a plain ``partitionBy``; rows with a
    NULL time get NULL-time peers only.  ``strategy``: ``cells`` (frames of the
    constructors only; ``bucket_seconds`` is the length of a cell), ``halo``, or
    ``auto`` (cells when every frame allows it and spans an hour or more).
    """
    if not frames:
        return df
    if any(f.lower < 0 or f.upper < 0 or f.upper > f.lower for f in frames):
        raise ValueError("frames must look back: 0 <= upper <= lower")
    mergeable = all(f.kind in MONOIDS for f in frames)
    span = min(f.lower - f.upper for f in frames)
    if strategy == "cells" or (strategy == "auto" and mergeable and span >= HOUR):
        if not mergeable:
            raise ValueError("the cells strategy needs frames of a kind in MONOIDS")
        return _rolling_cells(df, keys, seconds_col, frames, max(1, min(bucket_seconds or DAY, span)))
    return _rolling_halo(df, keys, seconds_col, frames, bucket_seconds)


def _rolling_halo(df: DataFrame, keys: list[str], seconds_col: str,
                  frames: list[Frame], bucket_seconds: int | None) -> DataFrame:
    reach = max(f.lower for f in frames)
    bucket = int(bucket_seconds or max(4 * reach, 86400))
    sec = F.col(seconds_col)
    own = F.floor(sec / F.lit(bucket))
    last = F.floor((sec + F.lit(reach)) / F.lit(bucket))
    cols = df.columns
    staged = (
        df.withColumn("__own_b", own)
        # own bucket plus the buckets whose frames reach back into this row
        .withColumn("__b", F.explode(F.sequence(F.coalesce(own, F.lit(0)),
                                                F.coalesce(last, F.lit(0)))))
        .withColumn("__is_own", F.col("__b") == F.coalesce(F.col("__own_b"), F.lit(0)))
    )
    w = Window.partitionBy(*keys, "__b").orderBy(sec)
    out = staged.select(
        *cols, "__is_own",
        *[f.agg.over(w.rangeBetween(-f.lower, -f.upper)).alias(f.name) for f in frames],
    )
    return out.filter(F.col("__is_own")).drop("__is_own")


def rolling_aggregate_plain(df: DataFrame, keys: list[str], seconds_col: str,
                            frames: list[Frame]) -> DataFrame:
    """Reference form: ``partitionBy(keys)`` only.  Used by tests as the oracle."""
    w = Window.partitionBy(*keys).orderBy(F.col(seconds_col))
    return df.select(*df.columns,
                     *[f.agg.over(w.rangeBetween(-f.lower, -f.upper)).alias(f.name)
                       for f in frames])


def _merged(kind: str, parts: list[Column]) -> Column:
    """The aggregate of several parts; a NULL part is empty."""
    if kind in ("min", "max"):
        return (F.least if kind == "min" else F.greatest)(*parts, F.lit(None))
    total = sum((F.coalesce(p, F.lit(0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0)))
    return total if kind == "count" else F.when(F.coalesce(*parts).isNotNull(), total)


def _matches(left: DataFrame, right: DataFrame, names: list[tuple[str, str]]) -> list[Column]:
    return [left[a].eqNullSafe(right[b]) for a, b in names]


def _rolling_cells(df: DataFrame, keys: list[str], seconds_col: str, frames: list[Frame], cell: int) -> DataFrame:
    measures: dict[tuple, str] = {}
    for f in frames:
        measures.setdefault((f.kind, f.column), f"__m{len(measures)}")
    merge = {m: MONOIDS[kind][1] for (kind, _), m in measures.items()}
    names = [f"__k{i}" for i in range(len(keys))]

    # 1. one row per (key, second); NULL seconds are a peer group of their own
    per_sec = (df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(seconds_col).alias("__sec"))
               .agg(*[MONOIDS[kind][0](F.lit(1) if column is None else F.col(column)).alias(m)
                      for (kind, column), m in measures.items()]))
    timed = per_sec.filter(F.col("__sec").isNotNull())

    # 2. each key-second at its own place, at the start of each frame and at the end of
    #    each that ends earlier; one pass gives the merged values of its cell up to an end
    #    and from a start on (RANGE frames: equal seconds count as one place)
    ends = sorted({f.upper for f in frames} | {0})
    starts = sorted({f.lower for f in frames})
    places = [F.struct(F.lit(off).cast("long").alias("off"), F.lit(start).alias("start"))
              for start, offs in ((False, ends), (True, starts)) for off in offs]
    own = ~F.col("__start") & (F.col("__off") == 0)
    placed = (timed.select("*", F.explode(F.array(*places)).alias("__p"))
              .select(*names, "__sec", F.col("__p.off").alias("__off"), F.col("__p.start").alias("__start"),
                      (F.col("__sec") - F.col("__p.off")).alias("__pos"), *merge)
              .select(*names, "__sec", "__off", "__start", "__pos", F.floor(F.col("__pos") / cell).alias("__cell"),
                      *[F.when(own, F.col(m)).alias(m) for m in merge]))
    group = Window.partitionBy(*names, "__cell")
    up, down = group.orderBy(F.col("__pos")), group.orderBy(F.col("__pos").desc())
    ended = placed.select(*names, "__sec", "__off", "__start", "__cell", *[
        F.when(F.col("__start"), agg(m).over(down)).otherwise(agg(m).over(up)).alias(m) for m, agg in merge.items()])

    # 3. whole cells before each cell in which a frame ends: q or q - 1 of them, as its
    #    start falls; from the key x cell table
    between = {(m, k) for f in frames for m in [measures[f.kind, f.column]]
               for q in [(f.lower - f.upper) // cell] for k in (q, q - 1) if k > 0}
    cells = placed.filter(~F.col("__start")).groupBy(*names, "__cell").agg(*[agg(m).alias(m) for m, agg in merge.items()])
    row = Window.partitionBy(*names).orderBy("__cell")
    cells = cells.select(*[F.col(n).alias(f"_{n}") for n in names], F.col("__cell").alias("___cell"), *[
        merge[m](m).over(row.rangeBetween(-k, -1)).alias(f"__mid{m}_{k}") for m, k in sorted(between)])
    parts = ended.join(cells, _matches(ended, cells, [(n, f"_{n}") for n in [*names, "__cell"]]), "left")

    # 4. back to one row per key-second
    def whole(f: Frame) -> Column:
        q, m = (f.lower - f.upper) // cell, measures[f.kind, f.column]
        far = F.col("__cell") - F.floor((F.col("__sec") - f.lower) / cell) == q + 1
        mid = [F.col(f"__mid{m}_{k}") if k > 0 else F.lit(None) for k in (q, q - 1)]
        return F.when(far, mid[0]).otherwise(mid[1])

    found, outs = [], []
    for j, f in enumerate(frames):
        m = measures[f.kind, f.column]
        at_end, at_start = ~F.col("__start") & (F.col("__off") == f.upper), F.col("__start") & (F.col("__off") == f.lower)
        picked = {"e": F.when(at_end, F.col(m))}
        if f.lower > f.upper:
            picked |= {"a": F.when(at_start, F.col(m)), "w": F.when(at_end, whole(f))}
        found += [F.first(c, ignorenulls=True).alias(f"__{part}{j}") for part, c in picked.items()]
        outs.append((f, _merged(f.kind, [F.col(f"__{part}{j}") for part in picked])))
    types = df.select(*[f.agg.alias(f.name) for f in frames]).schema
    results = parts.groupBy(*names, "__sec").agg(*found).select(
        *names, "__sec", *[c.cast(types[f.name].dataType).alias(f.name) for f, c in outs])
    nulls = per_sec.filter(F.col("__sec").isNull()).select(
        *names, "__sec", *[F.col(measures[f.kind, f.column]).cast(types[f.name].dataType).alias(f.name) for f in frames])
    results = results.unionByName(nulls)

    # 5. every row of a (key, second) shares its result
    cond = _matches(df, results, [*zip(keys, names), (seconds_col, "__sec")])
    return df.join(results, cond, "left").select(*[df[c] for c in df.columns], *[results[f.name] for f in frames])
