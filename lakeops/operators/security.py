"""Row filters and column masks applied as a view over a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def secure_view(df: DataFrame, row_predicate: str | Column | None = None,
                masks: dict[str, Column] | None = None) -> DataFrame:
    """Rows the reader may see (predicate pushed down like any filter) with
    masked columns replaced in place; column order is kept."""
    out = df
    if row_predicate is not None:
        pred = F.expr(row_predicate) if isinstance(row_predicate, str) else row_predicate
        out = out.filter(F.coalesce(pred, F.lit(False)))
    if masks:
        out = out.withColumns(masks)
    return out


def hash_mask(col: str) -> Column:
    """SHA-256 hex digest: joinable, not readable."""
    return F.sha2(F.col(col).cast("string"), 256)


def round_mask(col: str, step: float) -> Column:
    """Coarsens a number to multiples of ``step``."""
    return F.floor(F.col(col) / step) * step
