"""Running totals over a total order, without gathering the rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.shared import stored


def running_totals(df: DataFrame, order: list[str], amounts: dict[str, str]) -> DataFrame:
    """The rows with, for each entry of ``amounts`` (new column: column of whole numbers), the sum over all rows before them.

    Rows are dealt out by ranges of ``order`` and written; one row per range carries its sums,
    and windows run inside the ranges only. Rows that are equal in ``order`` keep an arbitrary
    but fixed order, and may lie in several ranges, so that one value held by very many rows
    is no single task. Missing amounts count as 0.
    """
    by = [F.col(c).asc_nulls_first() for c in order] + [F.col("_tie")]
    ranged = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    ranged = stored(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    sums = ranged.groupBy("_range").agg(*[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(f"_sum_{c}") for c in set(amounts.values())])
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    within = Window.partitionBy("_range").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_range", *[_total(f"_sum_{c}", ahead).alias(f"_ahead_{name}") for name, c in amounts.items()])
    out = ranged.select("*", *[_total(c, within).alias(f"_within_{name}") for name, c in amounts.items()]).join(starts, "_range")
    return out.select(
        *[c for c in df.columns if c not in amounts],
        *[(F.col(f"_ahead_{name}") + F.col(f"_within_{name}")).alias(name) for name in amounts],
    )


def _total(column: str, window) -> Column:
    return F.coalesce(F.sum(F.coalesce(F.col(column), F.lit(0))).over(window), F.lit(0)).cast("bigint")
