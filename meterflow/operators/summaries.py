"""Sums that are kept up to date: what comes in adds, what is replaced subtracts its old value.

A summary table holds signed parts, a few rows for every run; the totals are the sums of all parts. So a run costs what it changes, and it never reads what was summed before.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Summary:
    """``keys`` and ``sums`` map a column of the summary to SQL over the rows; ``where`` tells which rows count."""

    keys: dict[str, str]
    sums: dict[str, str]
    where: str = "true"

    def schema(self, rows: T.StructType) -> T.StructType:
        """Of the parts: keys, n, and for each sum the sum and how many values were in it."""
        kinds = {f.name: f.dataType for f in rows.fields}
        parts = [T.StructField(k, kinds.get(sql, T.DateType())) for k, sql in self.keys.items()]
        names = ["n", *[x for s in self.sums for x in (s, f"values_{s}")]]
        return T.StructType([*parts, *[T.StructField(n, T.LongType()) for n in names]])


DAILY = Summary(
    {"subscriber_number": "subscriber_number", "day": "to_date(end_date)"},
    {c: c for c in ("usage_anytime", "usage_offpeak", "usage_available_tokens")},
    "summary_flag = 1",
)
SESSIONS = Summary({"username": "username"}, {"input_octets": "diff_acctinputoctets", "output_octets": "diff_acctoutputoctets"})


def _signed(summary: Summary, rows: DataFrame, sign: int) -> DataFrame:
    counted = rows.where(summary.where).select(
        *[F.expr(sql).alias(k) for k, sql in summary.keys.items()],
        F.lit(sign).cast("bigint").alias("n"),
        *[c for s, sql in summary.sums.items() for c in (
            (F.expr(sql) * sign).cast("bigint").alias(s), F.when(F.expr(sql).isNotNull(), sign).otherwise(0).cast("bigint").alias(f"values_{s}"))],
    )
    return counted


def merged(summary: Summary, parts: DataFrame) -> DataFrame:
    """One part for each key; keys of which nothing is left go."""
    added = [c for s in summary.sums for c in (F.coalesce(F.sum(s), F.lit(0)).cast("bigint").alias(s), F.sum(f"values_{s}").cast("bigint").alias(f"values_{s}"))]
    one = parts.groupBy(*summary.keys).agg(F.sum("n").cast("bigint").alias("n"), *added)
    something: Column = F.col("n") != 0
    for s in summary.sums:
        something = something | (F.col(s) != 0) | (F.col(f"values_{s}") != 0)
    return one.where(something)


def change(summary: Summary, after: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """The part that a run adds: its rows as they are ``after`` it, less the same rows as they were ``before``. Rows that the run leaves alone may be in both or in neither."""
    parts = _signed(summary, after, 1)
    if before is not None:
        parts = parts.unionByName(_signed(summary, before, -1))
    return merged(summary, parts)


def current(summary: Summary, parts: DataFrame) -> DataFrame:
    """The summary itself: a sum is missing where no value was ever in it, as in a sum over all rows."""
    total = merged(summary, parts).where("n <> 0")
    return total.select(*summary.keys, *[F.when(F.col(f"values_{s}") != 0, F.col(s)).alias(s) for s in summary.sums], "n")
