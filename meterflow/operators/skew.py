"""Ordered look-back per key that stays parallel when one key holds much of the data.

A window partitioned by subscriber puts all rows of a subscriber in one task. That is
the right plan while every subscriber fits a task. ``plan_chunks`` counts rows per key
(map-side combined, key columns only) and finds the few keys that do not fit. Those keys
alone are cut into consecutive chunks of their order; a chunk's first row takes its
predecessor from the last row of the chunk before. Results are the same either way.

What the driver and the broadcasts hold is bounded by the number of shuffle partitions P:
at most P heavy keys, and, as no chunk is planned smaller than 1/P of all rows, at most 2 P
chunks in all. Any key beyond the P most frequent holds less than 1/P of the rows, which is
an ordinary partition, so leaving it whole is safe.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from meterflow.session import small_table

CHUNK = "_chunk"
HEAVY_ROWS = 1_000_000
SAMPLES_PER_CHUNK = 20
BLOCK = 64


def _position(order: tuple[str, ...]) -> Column:
    """Comparable place of a row in its key's order, missing values last."""
    fields = []
    for i, name in enumerate(order):
        fields += [F.col(name).isNull().alias(f"n{i}"), F.col(name).alias(f"v{i}")]
    return F.struct(*fields)


def _match(left: DataFrame, right: DataFrame, keys: tuple[str, ...]) -> Column:
    """Equality in which a missing key equals a missing key, as in a window partition."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_{k}"]) for k in keys])


@dataclass(frozen=True)
class KeyChunks:
    """How to cut the rows of each key. ``cuts`` is None when no key is heavy."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    cuts: DataFrame | None = None

    @property
    def window_keys(self) -> tuple[str, ...]:
        return self.keys if self.cuts is None else (*self.keys, CHUNK)

    def _side(self, *columns: str | Column) -> DataFrame:
        renamed = [F.col(k).alias(f"_{k}") for k in self.keys]
        return F.broadcast(self.cuts.select(*renamed, *columns))

    def assign(self, df: DataFrame) -> DataFrame:
        """Add the chunk number; rows of ordinary keys are all in chunk 0."""
        if self.cuts is None:
            return df
        # cut points in blocks: a row is compared with the first of each, then within one
        blocks = F.expr(
            f"transform(sequence(0, cast((size(_cuts) - 1) div {BLOCK} AS int)),"
            f" b -> slice(_cuts, b * {BLOCK} + 1, {BLOCK}))"
        )
        side = self._side(blocks.alias("_blocks"), F.transform(blocks, lambda b: b[0]).alias("_heads"))
        place = _position(self.order)

        def passed(cuts: Column | str) -> Column:
            return F.size(F.filter(cuts, lambda cut: cut <= place))

        block = passed("_heads") - 1
        chunk = F.when(F.col("_heads").isNull() | (block < 0), F.lit(0)).otherwise(
            block * BLOCK + passed(F.get("_blocks", block))
        )
        joined = df.join(side, _match(df, side, self.keys), "left")
        return joined.withColumn(CHUNK, chunk).drop("_blocks", "_heads", *[f"_{k}" for k in self.keys])

    def spread(self, df: DataFrame) -> DataFrame:
        """Copy one-row-per-key data to every chunk of its key, for a co-located join."""
        if self.cuts is None:
            return df
        side = self._side("_cuts")
        chunks = F.sequence(F.lit(0), F.coalesce(F.size("_cuts"), F.lit(0)))
        chunks = F.when(F.col("_cuts").isNull(), F.array(F.lit(0))).otherwise(chunks)
        joined = df.join(side, _match(df, side, self.keys), "left")
        return joined.withColumn(CHUNK, F.explode(chunks)).drop(
            "_cuts", *[f"_{k}" for k in self.keys]
        )

    def only_heavy(self, df: DataFrame) -> DataFrame:
        side = self._side()
        return df.join(side, _match(df, side, self.keys), "left_semi")


def plan_chunks(
    df: DataFrame,
    keys: tuple[str, ...] | list[str],
    order: tuple[str, ...] | list[str],
    heavy_rows: int = HEAVY_ROWS,
    max_keys: int | None = None,
) -> KeyChunks:
    """Find the heavy keys of ``df`` and cut points for them.

    Runs one narrow aggregation; a second pass over the heavy rows only if there are any.
    Cut points come from a random sample, as a range partitioner's do: it decides how
    evenly the chunks fill, never which rows they hold.
    """
    spark = df.sparkSession
    keys, order = tuple(keys), tuple(order)
    if max_keys is None:
        max_keys = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = Observation()
    top = (
        df.select(*keys)
        .observe(total, F.count(F.lit(1)).alias("rows"))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > heavy_rows)
        .orderBy(F.desc("_rows"))
        .limit(max_keys)
    )
    heavy = top.collect()
    if not heavy:
        return KeyChunks(keys, order)
    chunk_rows = max(heavy_rows, total.get["rows"] // max_keys)
    heavy = [r.asDict() for r in heavy if r["_rows"] > chunk_rows]
    if not heavy:
        return KeyChunks(keys, order)

    counts = small_table(spark, heavy, top.schema)
    side = F.broadcast(counts.withColumnsRenamed({k: f"_{k}" for k in keys}))
    chunks = F.ceil(F.col("_rows") / chunk_rows).cast("int")
    sample = (
        df.join(side, _match(df, side, keys))
        .withColumn("_n", chunks)
        .where(F.rand() * F.col("_rows") < F.col("_n") * SAMPLES_PER_CHUNK)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(_position(order))).alias("_s"), F.first("_n").alias("_n"))
    )
    # every (size / n)-th sampled place, the first one left out
    cut = F.expr(
        "array_distinct(transform(filter(sequence(1, _n), i -> i < _n AND size(_s) > 0),"
        " i -> _s[cast(floor(i * size(_s) / _n) AS int)]))"
    )
    cuts = sample.select(*keys, cut.alias("_cuts"))
    rows = [r.asDict(True) for r in cuts.collect()]
    return KeyChunks(keys, order, small_table(spark, rows, cuts.schema))


def lag_by_key(
    df: DataFrame, plan: KeyChunks, lags: dict[str, str], within: tuple[str, ...] = ()
) -> DataFrame:
    """``lag(column)`` per key in the plan's order, ascending, missing values last.

    ``lags`` maps the new column to the column looked back at; ``within`` names further
    columns that split the keys. With heavy keys the result also carries the chunk number,
    for joins that should keep its partitioning.
    """
    parts = (*plan.window_keys, *within)
    window = Window.partitionBy(*parts).orderBy(
        *[F.asc_nulls_last(c) for c in plan.order]
    )
    if plan.cuts is None:
        return df.withColumns({new: F.lag(col).over(window) for new, col in lags.items()})

    chunked = plan.assign(df)
    row = F.struct(*[F.col(col).alias(new) for new, col in lags.items()])
    last = (
        plan.only_heavy(chunked)
        .groupBy(*parts)
        .agg(F.max_by(row, _position(plan.order)).alias("_last"))
    )
    # one row per chunk, few in all
    by_key = Window.partitionBy(*plan.keys, *within).orderBy(CHUNK)
    carry = last.select(
        *[F.col(k).alias(f"_{k}") for k in parts],
        F.lag("_last").over(by_key).alias("_carry"),
    )
    carry = F.broadcast(carry)
    out = chunked.withColumn("_prior", F.lag(row).over(window))
    out = out.join(carry, _match(out, carry, parts), "left")
    prior = F.coalesce("_prior", "_carry")
    return out.withColumns({new: prior[new] for new in lags}).drop(
        "_prior", "_carry", *[f"_{k}" for k in parts]
    )


def latest_by(df: DataFrame, keys: list[str], *newest_first: Column) -> DataFrame:
    """One row per key: the first in the given order.

    Written as ``row_number() = 1``: each map task then keeps a single row per key before
    the shuffle, so copies of one key never travel together.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
