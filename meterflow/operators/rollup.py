"""Usage summaries and bounded text reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.expr import in_interval


def daily_usage(log: DataFrame) -> DataFrame:
    """Usage per subscriber and day over the calculated rows."""
    return (
        log.where(F.col("summary_flag") == 1)
        .groupBy("subscriber_number", F.to_date("end_date").alias("day"))
        .agg(
            F.sum("usage_anytime").alias("usage_anytime"),
            F.sum("usage_offpeak").alias("usage_offpeak"),
            F.sum("usage_available_tokens").alias("usage_available_tokens"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def session_usage(history: DataFrame, start: Column, end: Column) -> DataFrame:
    """Octets per user over the session changes seen in ``(start, end]``."""
    return (
        history.where(in_interval(F.col("extract_date"), start, end))
        .groupBy("username")
        .agg(
            F.sum("diff_acctinputoctets").alias("input_octets"),
            F.sum("diff_acctoutputoctets").alias("output_octets"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def joined_text(
    df: DataFrame,
    group: list[str],
    order: list[str],
    text: str,
    max_lines: int,
    separator: str = "\n",
) -> DataFrame:
    """The lines of each group as texts of at most ``max_lines`` lines, numbered from 0.

    Lines are numbered in order and cut into runs, so the parts of a group joined in their order are the
    whole text, whatever its size, and no cell holds an unbounded group. One pass: parts keep the window's partitioning.
    """
    by = Window.partitionBy(*group).orderBy(*[F.asc_nulls_last(c) for c in (*order, text)])
    part = F.floor((F.row_number().over(by) - 1) / max_lines).cast("int")
    line = F.struct("_place", F.col(text).alias("_text"))
    lines = F.transform(F.sort_array(F.collect_list(line)), lambda x: x["_text"])
    return (
        df.withColumns({"part": part, "_place": F.row_number().over(by)})
        .groupBy(*group, "part")
        .agg(F.count(F.lit(1)).alias("n"), F.array_join(lines, separator).alias("text"))
    )
