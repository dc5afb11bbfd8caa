"""Data-quality expectations, range checks, key checks, profiles, classification.

Every check is a single aggregation pass (partial aggregates per task, one
small final merge), never a collect of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType


@dataclass(frozen=True)
class Expectation:
    """``EXPECT (condition) [ON VIOLATION DROP ROW | FAIL UPDATE]``.

    A condition that is NULL counts as a violation.
    """

    name: str
    condition: str | Column
    action: str = "keep"          # keep | drop | fail

    def holds(self) -> Column:
        c = F.expr(self.condition) if isinstance(self.condition, str) else self.condition
        return F.coalesce(c, F.lit(False))


def violation_counters(expectations: list[Expectation]) -> list[Column]:
    return [F.count(F.lit(1)).alias("total_rows")] + [
        F.count_if(~e.holds()).alias(f"{e.name}_violations") for e in expectations]


def apply_expectations(df: DataFrame, expectations: list[Expectation],
                       name: str | None = None) -> tuple[DataFrame, Observation]:
    """Counts violations while the data flows (``observe``, no extra job),
    then drops rows of ``drop`` expectations and fails on ``fail`` ones.

    The observation is filled once an action has run on the returned frame.
    """
    obs = Observation(name or "expectations")
    return enforce(df.observe(obs, *violation_counters(expectations)), expectations), obs


def enforce(df: DataFrame, expectations: list[Expectation]) -> DataFrame:
    """Drops the rows that break a ``drop`` expectation; a row that breaks a
    ``fail`` one ends the job.  For frames and streams."""
    out = df
    for e in expectations:
        if e.action == "drop":
            out = out.filter(e.holds())
        elif e.action == "fail":
            # a filter, not a dropped column: the optimizer cannot prune it away
            out = out.filter(F.when(~e.holds(), F.raise_error(F.lit(f"expectation {e.name} violated")))
                             .otherwise(F.lit(True)))
        elif e.action != "keep":
            raise ValueError(f"unknown action {e.action}")
    return out


def expectation_report(df: DataFrame, expectations: list[Expectation]) -> DataFrame:
    """One row: total rows and violations per expectation (batch form)."""
    return df.agg(*violation_counters(expectations))


def verify_ranges(df: DataFrame, checks: dict[str, tuple[float, float]]) -> DataFrame:
    """One row of booleans: every non-NULL value of each column lies in [lo, hi]."""
    return df.agg(*[
        F.coalesce(F.bool_and(F.col(c).between(lo, hi)), F.lit(True)).alias(f"{c}_in_range")
        for c, (lo, hi) in checks.items()])


def primary_key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once or contain a NULL, with counts."""
    any_null = None
    for k in keys:
        any_null = F.col(k).isNull() if any_null is None else (any_null | F.col(k).isNull())
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter((F.col("n_rows") > 1) | any_null))


# Classification tags and the patterns that recognise them.
CLASSIFY_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}",
    "url": r"https?://[A-Za-z0-9./?=&#%_-]+",
    "ipv4": r"[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}",
    "phone": r"[+]?[0-9][0-9 ().-]{7,}[0-9]",
    "iso_date": r"[0-9]{4}-[0-9]{2}-[0-9]{2}",
}
# Literals a pattern cannot match without: a cheap substring test runs first
# and the regex only on values that contain it (same result, far less work).
CLASSIFY_REQUIRED_LITERALS = {"email": "@", "url": "://"}


def classify_columns(df: DataFrame, columns: list[str] | None = None,
                     patterns: dict[str, str] | None = None) -> DataFrame:
    """Per (column, tag): rows whose value contains the tag's pattern.

    One aggregation pass over all columns and patterns, then an unpivot of the
    single result row.
    """
    patterns = patterns if patterns is not None else CLASSIFY_PATTERNS
    columns = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    aggs = [F.count(F.lit(1)).alias("__n")]
    pairs = []
    for i, c in enumerate(columns):
        for j, (tag, pat) in enumerate(patterns.items()):
            alias = f"__m{i}_{j}"
            hit = F.col(c).rlike(pat)
            literal = CLASSIFY_REQUIRED_LITERALS.get(tag) if patterns is CLASSIFY_PATTERNS else None
            if literal:
                hit = F.col(c).contains(literal) & hit
            aggs.append(F.count_if(hit).alias(alias))
            pairs.append((c, tag, alias))
    row = df.agg(*aggs)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(tag).alias("tag"),
                 F.col(alias).alias("n_match")) for c, tag, alias in pairs]))
    return (row.select(F.col("__n").alias("n_rows"), stacked.alias("s"))
            .select("s.column_name", "s.tag", "s.n_match", "n_rows",
                    F.round(F.try_divide(F.col("s.n_match"), F.col("n_rows")), 6).alias("share")))


def column_profile(df: DataFrame, columns: list[str] | None = None, exact: bool = False,
                   rsd: float = 0.01, tracked: int = 10_000, candidates: int = 32) -> DataFrame:
    """Per column: rows, NULLs, distinct count, numeric min/max/mean and, for
    text columns, the most frequent value (ties: smallest value).

    ``exact=False`` (default): distinct counts are HyperLogLog sketches (relative
    error ``rsd``) and text columns get a frequent-item sketch of value hashes
    (``tracked`` counters), both in the pass of the other statistics.  The one-row
    result is read by the driver.  The ``candidates`` most frequent hashes of each
    column are counted anew, exactly.  A column is settled where the best of these
    counts exceeds what any other value can have by the error bound of the sketch;
    the values of the columns left (no frequent value) are all counted.  The top value
    and its count are exact at any number of distinct values.
    ``exact=True``: every column is unpivoted to (column, value) and counted
    in one aggregation; hot values collapse in the map-side partial aggregate,
    so no task receives a whole column, but the shuffle grows with columns x
    distinct values.
    """
    columns = columns or df.columns
    fields = {f.name: f.dataType for f in df.schema.fields}
    numeric = [c for c in columns if isinstance(fields[c], NumericType)]
    text = [c for c in columns if isinstance(fields[c], StringType)]

    stats = df.agg(F.count(F.lit(1)).alias("n_rows"), *[
        x for c in columns for x in (
            F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"),
            (F.min(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias(f"{c}__min"),
            (F.max(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias(f"{c}__max"),
            (F.avg(c) if c in numeric else F.lit(None).cast("double")).alias(f"{c}__mean"),
            (F.lit(None).cast("long") if exact
             else F.approx_count_distinct(c, rsd)).alias(f"{c}__approx"),
            (F.call_function("approx_top_k", _hash(c), F.lit(candidates), F.lit(tracked))
             if c in text and not exact else F.lit(None).cast("array<struct<item:bigint,count:bigint>>"))
            .alias(f"{c}__often"))])
    per_col = stats.select("n_rows", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__nulls").alias("n_nulls"),
                 F.col(f"{c}__min").alias("min_value"), F.col(f"{c}__max").alias("max_value"),
                 F.col(f"{c}__mean").alias("mean_value"),
                 F.col(f"{c}__approx").alias("approx_distinct"),
                 F.col(f"{c}__often").alias("often")) for c in columns])).alias("s")
    ).select("s.column_name", "n_rows", "s.n_nulls", "s.min_value", "s.max_value", "s.mean_value",
             "s.approx_distinct", "s.often")

    if exact:
        counted = columns
    else:
        # the statistics are one row; keep them as a small local frame so the
        # pass over the data is not repeated for the final result
        row = per_col.collect()
        per_col = df.sparkSession.createDataFrame(row, per_col.schema)
        found, counted = _settled_tops(df, row, tracked, candidates)
        per_col = per_col.join(df.sparkSession.createDataFrame(
            found, "column_name string, sure_value string, sure_count long"), "column_name", "left")
    values = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v"),
                 F.lit(c in text).alias("is_text")) for c in counted])).alias("s")
    ).select("s.*").filter(F.col("v").isNotNull()) if counted else None
    if values is None:
        return per_col.select("column_name", "n_rows", "n_nulls",
                              F.col("approx_distinct").alias("n_distinct"),
                              F.round("min_value", 6).alias("min_value"),
                              F.round("max_value", 6).alias("max_value"),
                              F.round("mean_value", 6).alias("mean_value"),
                              F.col("sure_value").alias("top_value"), F.col("sure_count").alias("top_count"))
    freq = values.groupBy("column_name", "v", "is_text").agg(F.count(F.lit(1)).alias("n"))
    # distinct counts: a hash aggregate over all counted columns; the top value
    # (a sort-based min_by) only over the text columns' value counts
    n_distinct = freq.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct"))
    tops = (freq.filter(F.col("is_text")).groupBy("column_name")
            .agg(F.min_by(F.col("v"), F.struct(F.lit(0) - F.col("n"), F.col("v"))).alias("__top"),
                 F.max("n").alias("top_count")))
    per_value = n_distinct.join(tops, "column_name", "left")
    distinct = (F.coalesce(F.col("n_distinct"), F.lit(0)) if exact
                else F.coalesce(F.col("n_distinct"), F.col("approx_distinct")))
    if exact:
        per_col = per_col.withColumns({"sure_value": F.lit(None).cast("string"), "sure_count": F.lit(None).cast("long")})
    return (per_col.join(per_value, "column_name", "left")
            .select("column_name", "n_rows", "n_nulls", distinct.alias("n_distinct"),
                    F.round("min_value", 6).alias("min_value"),
                    F.round("max_value", 6).alias("max_value"),
                    F.round("mean_value", 6).alias("mean_value"),
                    F.coalesce("sure_value", "__top").alias("top_value"),
                    F.coalesce("sure_count", "top_count").alias("top_count")))


def _hash(c: str):
    return F.when(F.col(c).isNotNull(), F.xxhash64(c))


def _settled_tops(df: DataFrame, stats: list, tracked: int, candidates: int) -> tuple[list, list[str]]:
    """((column, top value, its count) proven by a count of the candidates; columns
    with values that are not).

    A value outside the candidates has at most ``5.25 / tracked`` of the rows (twice the
    sketch's error, which is 3.5 over its number of counters), and where the list is full
    as many more as the last candidate's estimate.
    """
    often = {r.column_name: [x for x in r.often if x["item"] is not None] for r in stats if r.often is not None}
    asked = {c: items for c, items in often.items() if items}
    tops = []
    if asked:
        pairs = F.array_compact(F.array(*[
            F.when(F.xxhash64(c).isin([x["item"] for x in items]),
                   F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v"))) for c, items in asked.items()]))
        counts = df.select(F.explode(pairs).alias("s")).groupBy("s.column_name", "s.v").agg(F.count(F.lit(1)).alias("n"))
        tops = counts.groupBy("column_name").agg(
            F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("v"), F.max("n").alias("n")).collect()
    found = []
    for r in tops:
        n_rows = next(s.n_rows for s in stats if s.column_name == r.column_name)
        listed = next(s.often for s in stats if s.column_name == r.column_name)
        bound = 5.25 * n_rows / tracked + (listed[-1]["count"] if len(listed) >= candidates else 0)
        if r.n > bound:
            found.append((r.column_name, r.v, r.n))
    sure = {c for c, _, _ in found}
    filled = {s.column_name for s in stats if s.n_rows > s.n_nulls}
    return found, [c for c in often if c in filled and c not in sure]
