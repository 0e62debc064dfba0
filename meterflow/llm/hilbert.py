"""Shards as runs of a Hilbert curve over quantised metadata.

Every dimension becomes a number of ``bits`` bits with about equally many rows for each value;
the place on the curve through the cells orders the rows, so rows near each other have near values in all
dimensions. Runs of the order with equal shares of bytes are the shards: the smallest and largest value of each
dimension in a shard's file lie close together, which lets a reader skip files by any of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm.totals import running_totals

BITS = 5
CUT_ACCURACY = 10_000


def curve_index(codes: list[Column], bits: int = BITS) -> Column:
    """Place on the Hilbert curve of cells with coordinates ``codes``, each below 2**bits."""
    n = len(codes)
    steps = [(1 << b, i) for b in range(bits - 1, 0, -1) for i in range(n)]
    start = F.array(*[c.cast("int") for c in codes])
    if steps:
        todo = F.array(*[F.struct(F.lit(q).alias("q"), F.lit(i).alias("i")) for q, i in steps])
        start = F.aggregate(todo, start, _turn)
    gray = F.aggregate(F.sequence(F.lit(1), F.lit(n - 1)), start, _gray) if n > 1 else start
    return F.aggregate(F.array(gray), F.lit(0).cast("bigint"), lambda _, x: _interleaved(x, n, bits))


def _turn(x: Column, step: Column) -> Column:
    """Undo the rotation or reflection of the cell of one bit (``q``) that dimension ``i`` decides."""
    mask, own = step["q"] - 1, F.get(x, step["i"])
    high = own.bitwiseAND(step["q"]) != 0
    swap = F.get(x, F.lit(0)).bitwiseXOR(own).bitwiseAND(mask)
    return F.transform(
        x,
        lambda v, j: F.when(high & (j == 0), v.bitwiseXOR(mask))
        .when(~high & ((j == 0) | (j == step["i"])) & (step["i"] != 0), v.bitwiseXOR(swap))
        .otherwise(v),
    )


def _gray(x: Column, i: Column) -> Column:
    return F.transform(x, lambda v, j: F.when(j == i, v.bitwiseXOR(F.get(x, i - 1))).otherwise(v))


def _interleaved(x: Column, n: int, bits: int) -> Column:
    """Bits of the Gray code's numbers, highest first, after the last correction."""
    last = F.get(x, F.lit(n - 1))
    fix = reduce(
        lambda acc, b: acc.bitwiseXOR(F.when(last.bitwiseAND(F.lit(1 << b)) != 0, F.lit((1 << b) - 1)).otherwise(F.lit(0))),
        range(bits - 1, 0, -1),
        F.lit(0),
    )
    total = F.lit(0).cast("bigint")
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            bit = F.shiftright(F.get(x, F.lit(i)).bitwiseXOR(fix), b).bitwiseAND(F.lit(1))
            total = total + bit.cast("bigint") * F.lit(1 << (b * n + n - 1 - i)).cast("bigint")
    return total


def number_codes(df: DataFrame, column: str, bits: int) -> Column:
    """Code of a number: how many of 2**bits - 1 quantiles lie below it; a missing number is 0."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(F.percentile_approx(column, shares, CUT_ACCURACY).alias("cuts")).first()["cuts"] or []
    cuts = F.array(*[F.lit(c) for c in sorted(set(found))]) if found else F.array().cast("array<bigint>")
    return F.coalesce(F.size(F.filter(cuts, lambda c: c < F.col(column))), F.lit(0))


def text_codes(df: DataFrame, column: str, bits: int) -> DataFrame:
    """(column, column_code) for all texts in ``column``, codes rising with the texts' order; each has about equally many rows."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_rows"))
    placed = running_totals(counts, [column], {"_before": "_rows"})
    total = counts.agg(F.coalesce(F.sum("_rows"), F.lit(1)).alias("_all"))
    return placed.join(F.broadcast(total)).select(  # one row
        column, F.floor(F.col("_before") * F.lit(1 << bits) / F.col("_all")).cast("int").alias(f"{column}_code")
    )


def hilbert_shards(
    docs: DataFrame, shards: int, texts: tuple[str, ...] = ("lang", "source"), numbers: tuple[str, ...] = ("n_chars",), bits: int = BITS
) -> DataFrame:
    """doc_id, size, text_crc32, hilbert, shard, slot for each row of ``docs`` (doc_id, text and the dimensions).

    size is the UTF-8 bytes of the text plus 1; a missing text counts as empty. A missing value
    of a dimension has code 0, a column that is not there counts as missing. Rows lie on the curve by their place, rows of one cell by the
    crc of the text (equal texts side by side) and doc_id (missing ids first); wholly equal rows in any order. Shards are
    0 to ``shards`` - 1, cut at equal shares of all bytes: a shard is off its share by less than one row. A row larger than a share
    leaves shards empty. slot counts from 0 in each shard. No rows, no shards.
    """
    dims = [F.col(c) if c in docs.columns else F.lit(None).cast("string" if c in texts else "bigint").alias(c) for c in (*texts, *numbers)]
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")).alias("text_crc32"),
        *dims,
    )
    meta = docs.select(*dims)
    for c in texts:
        rows = rows.join(text_codes(meta, c, bits), c, "left")
    codes = [F.coalesce(F.col(f"{c}_code"), F.lit(0)) for c in texts] + [number_codes(meta, c, bits) for c in numbers]
    placed = rows.select("doc_id", "size", "text_crc32", curve_index(codes, bits).alias("hilbert"), F.lit(1).alias("one"))
    ran = running_totals(placed, ["hilbert", "text_crc32", "doc_id"], {"before": "size", "place": "one"})
    total = ran.agg(F.sum("size").alias("all_bytes"))
    cut = ran.join(F.broadcast(total)).withColumn(  # one row
        "shard", F.expr(f"cast(before * decimal({shards}) div all_bytes AS int)")
    )
    firsts = cut.groupBy("shard").agg(F.min("place").alias("first"))
    return cut.join(F.broadcast(firsts), "shard").select(  # a row per shard
        "doc_id", "size", "text_crc32", "hilbert", "shard", (F.col("place") - F.col("first")).alias("slot")
    )


def op9_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return hilbert_shards(docs, 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert"
    )
