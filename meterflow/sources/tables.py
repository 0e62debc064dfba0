"""Table formats: CSV, parquet and database tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# row groups of 100,000 rows
PARQUET_OPTIONS = {"compression": "zstd", "parquet.block.row.count.limit": "100000"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str) -> DataFrame:
    return spark.read.schema(schema).option("sep", sep).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str, sep: str) -> None:
    """Text files with a header. CSV knows no empty text: it reads back as a missing one."""
    df.write.option("sep", sep).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "append", by: list[str] | None = None, find_by: list[str] | None = None) -> None:
    """Parquet files, in folders by the columns ``by``.

    With ``find_by`` files are made to be skipped: rows are sorted by these columns within each file, and every row group has a Bloom filter of
    each, so that a lookup of a few values reads the row groups that may hold them.
    """
    writer = df
    if find_by:
        writer = df.sortWithinPartitions(*(by or []), *find_by)
    writer = writer.write.mode(mode).options(**PARQUET_OPTIONS)
    for column in find_by or []:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    properties: dict[str, str],
    column: str,
    lower: str,
    upper: str,
    parts: int,
) -> DataFrame:
    """A database query read in parallel by ranges of one column; filters reach the database."""
    return (
        spark.read.format("jdbc")
        .options(**properties)
        .option("url", url)
        .option("dbtable", f"({query}) q")
        .option("partitionColumn", column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", parts)
        .load()
    )


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], parts: int = 16) -> None:
    """Append to a database table through at most ``parts`` connections."""
    df.coalesce(parts).write.mode("append").format("jdbc").options(**properties).option(
        "url", url
    ).option("dbtable", table).save()
