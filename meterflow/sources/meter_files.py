"""Meter files: finding them, reading their lines, turning lines into records."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.functions.expr import epoch_to_local
from meterflow.schemas import METER_RECORD

USABLE = ("normal", "minor")
BARRED = ("critical", "suspended")

# Field of a meter line -> column of the record.
COUNTERS = {
    "overallcapacity": "capacity_anytime",
    "offpeakoverallcapacity": "capacity_offpeak",
    "overallusage": "overall_usage_anytime",
    "offpeakoverallusage": "overall_usage_offpeak",
    "availtokens": "overall_available_tokens",
}
RENAMED = {
    "fapstatus": "fap_status",
    "terminalstatus": "terminal_status",
    "inpeakperiod": "in_peak_period",
    "esn": "esn",
    "serviceplan": "service_plan",
}
REQUIRED = ("deviceid", "lastpolledtime", *COUNTERS, "fapstatus", "inpeakperiod")
OPTIONAL = ("terminalstatus", "esn", "serviceplan")


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Paths in a folder; no file content is read."""
    return spark.read.format("binaryFile").load(folder).select("path")


def select_files(listing: DataFrame, cap: int | None = None, suffix: str = ".udr") -> DataFrame:
    """The meter files of a listing, oldest first by the time in their names; with ``cap`` so many of them."""
    name = F.element_at(F.split("path", "/"), -1)
    stamp = F.regexp_extract(name, r"_([0-9]{12})\.[^_]*$", 1)
    files = (
        listing.where(F.col("path").endswith(suffix))
        .withColumn("file_name", name)
        .withColumn("file_time", F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmm")).cast("timestamp_ntz"))
        .select("path", "file_name", "file_time")
    )
    # a name without a readable time sorts last instead of stopping the run
    ordered = files.orderBy(F.asc_nulls_last("file_time"), "file_name")
    return ordered if cap is None else ordered.limit(cap)


def scan_lines(spark: SparkSession, path: str | list[str], glob: str = "*.udr") -> DataFrame:
    """Lines of meter files, each with the name of its file."""
    return _named(spark.read.option("pathGlobFilter", glob).text(path))


def stream_lines(
    spark: SparkSession, folder: str, glob: str = "*.udr", max_files: int | None = None
) -> DataFrame:
    """The same as an incremental scan: each file once, all that are there in a batch, or at most ``max_files``."""
    reader = spark.readStream.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _named(reader.text(folder))


def _named(lines: DataFrame) -> DataFrame:
    return lines.select("value", F.col("_metadata.file_name").alias("udr_file_name"))


# Values whose kind or presence matters stay variants: null when the key is missing.
LINE = ", ".join([f"{f} variant" for f in REQUIRED] + [f"{f} string" for f in OPTIONAL])
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _as(field: str, kind: str) -> Column:
    return F.try_variant_get(field, "$", kind)


def _is_fraction(field: str) -> Column:
    return F.schema_of_variant(field).startswith("D")  # DECIMAL or DOUBLE


def _whole(field: str) -> Column:
    """A counter as it is stored. A fraction is rounded; text must be a whole number."""
    rounded = F.round(_as(field, "decimal(38,6)")).try_cast("bigint")
    return F.when(_is_fraction(field), rounded).otherwise(_as(field, "bigint"))


def _number(field: str) -> Column:
    """The value where it is a number; text that looks like one is no number."""
    numeric = (F.schema_of_variant(field) == "BIGINT") | _is_fraction(field)
    return F.when(numeric, _as(field, "double"))


def classify_lines(lines: DataFrame, tz: str, created_by: str) -> DataFrame:
    """Every line with its record columns and an ``outcome``.

    ``record``     accepted
    ``rejected``   usable status, but neither counter pair above 1
    ``dropped``    any other or no status
    ``bad_json``   not JSON
    ``bad_field``  a field the rules need is missing or of the wrong kind

    A line's keys and values are lower-cased before anything else. On a usable line a
    field counts only if the accept rule gets to it: the off-peak pair is looked at when
    the first pair fails, a usage when its capacity is above 1. Barred lines compare
    nothing, they only have to be complete.
    """
    # As the single element of an array a line with anything after its object is no JSON.
    array = F.concat(F.lit("["), F.lower("value"), F.lit("]"))
    parsed = lines.withColumn("_lines", F.from_json(array, f"array<struct<{LINE}>>", STRICT))
    one = F.when(F.size("_lines") == 1, F.col("_lines"))
    # The explode keeps a filter on the outcome above the parsing, which so happens once.
    read = parsed.select("value", "udr_file_name", F.explode_outer(one).alias("_line")).select(
        "value", "udr_file_name", F.col("_line").isNotNull().alias("is_object"), "_line.*"
    )

    status = F.coalesce("terminalstatus", F.lit(""))
    usable, barred = status.isin(*USABLE), status.isin(*BARRED)
    polled = _as("lastpolledtime", "string")
    clock, ms = F.substring(polled, 1, 10), F.substring(polled, 11, 3)
    seconds = clock.try_cast("bigint")
    cap, off_cap, use, off_use = (_number(f) for f in list(COUNTERS)[:4])

    complete = reduce(and_, [F.col(f).isNotNull() for f in REQUIRED])
    stored = reduce(and_, [F.is_variant_null(f) | _whole(f).isNotNull() for f in COUNTERS])
    keep = F.when(complete & stored, "record").otherwise("bad_field")
    reject = F.when(F.col("deviceid").isNotNull(), "rejected").otherwise("bad_field")

    def both_above_one(first: Column, second: Column, otherwise: Column) -> Column:
        """A comparison that cannot be made fails the line."""
        usage = F.when(second > 1, keep).when(second <= 1, otherwise).otherwise("bad_field")
        return F.when(first > 1, usage).when(first <= 1, otherwise).otherwise("bad_field")

    # valid JSON of another shape is a line whose fields cannot be read
    other_json = ~F.ltrim("value").startswith("{") & F.try_parse_json("value").isNotNull()
    outcome = (
        F.when(~F.col("is_object"), F.when(other_json, "bad_field").otherwise("bad_json"))
        .when(~usable & ~barred, "dropped")
        .when(seconds.isNull(), "bad_field")
        .when(barred, keep)
        .otherwise(both_above_one(cap, use, both_above_one(off_cap, off_use, reject)))
    )
    route = F.when(usable, "usable").when(barred, "barred").otherwise("none")
    values = {
        "subscriber_number": _as("deviceid", "string"),
        "clock": clock,
        "ns": F.when(barred & (ms == ""), F.lit("0")).otherwise(ms),
        "end_date": epoch_to_local(seconds, tz),
        **{column: _whole(field) for field, column in COUNTERS.items()},
        **{column: _as(field, "string") for field, column in RENAMED.items() if field in REQUIRED},
        **{column: F.col(field) for field, column in RENAMED.items() if field in OPTIONAL},
        "udr_file_name": F.col("udr_file_name"),
        "created_by": F.lit(created_by),
    }
    return read.select(
        *[values[c].alias(c) for c in METER_RECORD.names],
        F.col("value").alias("line"),
        route.alias("route"),
        outcome.alias("outcome"),
    )


def accepted(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("outcome") == "record").select(*METER_RECORD.names)


def quarantined(classified: DataFrame) -> DataFrame:
    bad = classified.where(F.col("outcome").startswith("bad_"))
    return bad.select("udr_file_name", F.col("outcome").alias("reason"), "line")


def parse_udr(lines: DataFrame, tz: str, created_by: str) -> tuple[DataFrame, DataFrame]:
    """Records, and the lines that could not become one."""
    classified = classify_lines(lines, tz, created_by)
    return accepted(classified), quarantined(classified)


def file_status(classified: DataFrame) -> DataFrame:
    """Per file the line counts, and whether it is done: a wrong field fails its whole file."""
    outcome = F.col("outcome")
    return (
        classified.groupBy("udr_file_name")
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.count_if(outcome == "record").alias("n_records"),
            F.count_if(outcome == "bad_json").alias("n_bad_json"),
            F.count_if(outcome == "bad_field").alias("n_bad_field"),
        )
        .withColumn("file_ok", F.col("n_bad_field") == 0)
    )


def finished_only(rows: DataFrame, status: DataFrame) -> DataFrame:
    """Rows of the files that are done; the other files wait as a whole."""
    failed = status.where(~F.col("file_ok")).select("udr_file_name")
    return rows.join(failed, "udr_file_name", "left_anti").select(*rows.columns)


def pending_files(status: DataFrame) -> DataFrame:
    """One row with the number of unfinished files, or none when all are done."""
    n = status.where(~F.col("file_ok")).agg(F.count(F.lit(1)).alias("pending_files"))
    return n.where(F.col("pending_files") > 0)
