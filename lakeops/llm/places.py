"""Places of rows in the order of their group, without a task that holds a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm._common import stored


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos`` (place from 0 in its group, by ``order``, nulls first)
    and ``total`` (rows of the group).

    Rows are dealt by ranges of (group, order), so a group with a third of all rows
    is spread over many tasks; each range numbers its rows where they stand, and a
    table of one row for each (range, group) gives the rows of the group before it.
    ``rows`` should be a stored table (finding the ranges reads it once more), its
    ``group`` never null, and ``order`` should end with a column that tells equal rows
    apart if a single value of the others may hold very many.
    """
    dealt = stored(rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
                   .withColumn("_at", F.monotonically_increasing_id()), f"{name}-ranges")
    part = F.shiftright("_at", 33)
    own = Window.partitionBy("_g")
    runs = (dealt.groupBy(F.col(group).alias("_g"), part.alias("_part"))
            .agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
            .withColumn("_before", F.coalesce(F.sum("_n").over(
                own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("total", F.sum("_n").over(own)))
    return (dealt.join(runs, (F.col(group) == F.col("_g")) & (part == F.col("_part")))
            .withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before"))
            .drop("_at", "_g", "_part", "_first", "_n", "_before"))
