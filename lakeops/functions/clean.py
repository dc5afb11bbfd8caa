"""Text-to-typed cleaning expressions.

All parsing is NULL-safe under ANSI mode: a value that does not parse becomes
NULL instead of failing the job (``try_cast``, ``try_to_date``, ``get``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

# Unit factors of the cleaning rules.
THOUSAND = 1000
MILLION = 1000000
CM_TO_INCH = 0.393701
KG_TO_LB = 2.20462


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_money(c) -> Column:
    """``€110.5M`` -> 110500000.0, ``€565K`` -> 565000.0, anything else -> NULL.

    First and last characters are dropped; ``k`` is tested before ``m``.
    """
    c = _c(c)
    body = F.substring(c, F.lit(2), F.length(c) - 2).try_cast("float")
    return (F.when(c.ilike("%k%"), body * THOUSAND)
            .when(c.ilike("%m%"), body * MILLION)
            .otherwise(F.lit(None))).cast("float")


def parse_height(c) -> Column:
    """``170cm`` -> inches; ``5'7`` -> 5*12+7; other text -> NULL (DOUBLE)."""
    c = _c(c)
    cm = F.substring(c, F.lit(1), F.length(c) - 2).try_cast("float").cast("double")
    parts = F.split(c, "'")
    feet = F.get(parts, 0).try_cast("float").cast("double")
    inch = F.get(parts, 1).try_cast("float").cast("double")
    return (F.when(c.ilike("%cm"), cm * CM_TO_INCH)
            .when(c.like("%'%"), feet * 12 + inch)
            .otherwise(F.lit(None).cast("double")))


def parse_weight(c) -> Column:
    """``72kg`` -> pounds; ``159lbs`` -> 159; other text -> NULL (DOUBLE)."""
    c = _c(c)
    kg = F.substring(c, F.lit(1), F.length(c) - 2).try_cast("float").cast("double")
    lbs = F.substring(c, F.lit(1), F.length(c) - 3).try_cast("float").cast("double")
    return (F.when(c.ilike("%kg"), kg * KG_TO_LB)
            .when(c.ilike("%lbs"), lbs)
            .otherwise(F.lit(None).cast("double")))


def strip_html(c) -> Column:
    """Removes tags (shortest ``<...>`` spans)."""
    return F.regexp_replace(_c(c), r"<.*?>", "")


def parse_month_day_year(c) -> Column:
    """``Jul 1, 2004`` -> DATE; other text -> NULL."""
    return F.try_to_date(_c(c), "MMM d, yyyy")


def parse_contract_end(c) -> Column:
    """4-character year -> that year's May 31st; ISO-like date/time text -> its
    date; anything else -> NULL."""
    c = _c(c)
    return (F.when(F.length(c) == 4, F.try_to_date(F.concat(c, F.lit("-05-31")), "yyyy-MM-dd"))
            .otherwise(F.to_date(c.try_cast("timestamp_ntz"))))


def try_cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Typed silver projection: every listed column ``try_cast`` to its type,
    other columns unchanged, column order kept."""
    return df.select(*[
        F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns
    ])


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN -> NULL on every float/double column (one projection)."""
    return df.select(*[
        F.when(F.isnan(F.col(f.name)), F.lit(None)).otherwise(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Lower-case names, spaces to underscores."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def row_mean(cols: list[str]) -> Column:
    """Sum of the columns over their count; NULL if any input is NULL."""
    total = F.col(cols[0])
    for c in cols[1:]:
        total = total + F.col(c)
    return total / len(cols)


def row_population_variance(cols: list[str], mean: Column | None = None) -> Column:
    """sum((x - mean)^2) / N over the columns (mean computed once)."""
    m = mean if mean is not None else row_mean(cols)
    acc = None
    for c in cols:
        term = F.pow(F.col(c) - m, 2)
        acc = term if acc is None else acc + term
    return acc / len(cols)
