"""Files that are made to be skipped, updates that rewrite touched files only, counts taken in passing, and the SQL texts."""

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from meterflow.catalog import bindings as b
from meterflow.operators import changes
from meterflow.plans import sessions, sql_text
from meterflow.schemas import FILE_STATUS, METER_RECORD, QUARANTINE, RUN_COUNTS
from meterflow.sources.tables import write_parquet
from meterflow.sources.versions import VersionedTables
from meterflow.streaming import jobs

SF_DIR = "/root/testdata/sf0.001"


def scanned(df):
    """Rows that the scans of a query have handed on."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getSimpleName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_row_groups_and_lookups(spark, tmp_path):
    rows = spark.range(350_000).selectExpr("id", "cast(id * 7919 % 350000 * 2 AS string) AS subscriber_number")
    write_parquet(rows.coalesce(1), str(tmp_path / "t"), find_by=["subscriber_number"])
    (file,) = glob.glob(f"{tmp_path}/t/*.parquet")
    footer = pq.read_metadata(file)
    assert [footer.row_group(i).num_rows for i in range(footer.num_row_groups)] == [100_000] * 3 + [50_000]
    assert {footer.row_group(i).column(1).compression for i in range(4)} == {"ZSTD"}
    table = spark.read.parquet(str(tmp_path / "t"))
    assert scanned(table.where("subscriber_number = '400000'")) <= 100_000
    # within the range of a row group, but in none: only the Bloom filter can tell
    assert scanned(table.where("subscriber_number = '400001'")) == 0
    assert scanned(table) == 350_000


def log_files(spark, path):
    schema = "id long, end_date timestamp_ntz, v long"
    store = VersionedTables(spark, str(path))
    for n in range(2):
        rows = [(i, dt.datetime(2024, 1, 1), 0) for i in range(100 * n, 100 * n + 100)]
        store.publish(n, append={"t": spark.createDataFrame(rows, schema).repartitionByRange(4, "id")})
    return store, spark.createDataFrame([], schema).schema


def test_update_rewrites_touched_files_only(spark, tmp_path):
    store, schema = log_files(spark, tmp_path)
    before = {f: open(f, "rb").read() for f in glob.glob(f"{tmp_path}/t/*/*.parquet")}
    assert len(before) == 8
    keys = ["id", "end_date"]
    fixes = spark.createDataFrame([(5, dt.datetime(2024, 1, 1), 50), (7, dt.datetime(2024, 1, 1), None), (160, dt.datetime(2024, 1, 1), 60), (9, dt.datetime(2025, 1, 1), 1), (None, None, 1)], schema)
    want = changes.keyed_update(store.read("t", schema), fixes, keys, ["v"]).collect()
    files = store.update("t", schema, fixes, keys, lambda target, rows: changes.keyed_update(target, rows, keys, ["v"]))
    assert len(files) == 2 and sorted(store.read("t", schema).collect()) == sorted(want)
    assert sum(f.endswith(".parquet") for f in store.folders("t")) == 6
    assert all(open(f, "rb").read() == data for f, data in before.items())
    # a second update meets files that are in the table by reference, and an upsert adds rows
    rows = spark.createDataFrame([(30, dt.datetime(2024, 1, 1), 3), (500, dt.datetime(2024, 1, 1), 5)], schema)
    merge = lambda target, new: target.join(new, keys, "left_anti").select(*target.columns).unionByName(new)
    want = merge(store.read("t", schema), rows).collect()
    assert len(store.update("t", schema, rows, keys, merge)) == 1
    assert sorted(store.read("t", schema).collect()) == sorted(want) and len(want) == 201
    assert store.update("t", schema, fixes.limit(0), keys, merge) == [] and store.read("t", schema).count() == 201
    assert store.compact("t", schema) and store.read("t", schema).count() == 201


def test_state_upsert_by_file(spark, tmp_path):
    """The upsert operator through file rewrites gives what it gives on the whole table."""
    state = b.usage_state(spark, SF_DIR)
    rows = state.where("id % 50 = 0").withColumn("id", F.col("id") + 1000000).drop("load_time")
    keys = ["subscriber_number", "end_date"]
    store = VersionedTables(spark, str(tmp_path))
    store.publish(0, append={"s": state.repartitionByRange(8, "end_date")})

    def work(target, new):
        return changes.upsert(target, new, keys, "2024-01-31 00:00:00", tie_break=["id"])

    files = store.update("s", state.schema, rows, keys, work)
    want = work(state, rows)
    got = store.read("s", state.schema)
    assert 0 < len(files) <= 8 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_counts_add_up(spark, tmp_path, monkeypatch):
    lines = b.meter_lines(spark, SF_DIR).where("value IS NOT NULL AND udr_file_name < 'nms_2024010212'")
    folder = tmp_path / "in"
    folder.mkdir()
    files = {}
    for r in lines.collect():
        files.setdefault(r.udr_file_name, []).append(r.value)
    for name, values in files.items():
        (folder / name).write_text("\n".join(values) + "\n")
    for _ in range(2):
        jobs.ingest_files(spark, str(folder), str(tmp_path / "t"), str(tmp_path / "c"), b.TZ, "me", max_files=20).awaitTermination()
    store = VersionedTables(spark, str(tmp_path / "t"))
    counts = store.read("run_counts", RUN_COUNTS)
    total = counts.agg(*[F.sum(c).alias(c) for c in RUN_COUNTS.names[2:]]).first()
    status = store.read("files", FILE_STATUS).agg(*[F.sum(c).alias(c) for c in ("n_lines", "n_records", "n_bad_json", "n_bad_field")]).first()
    assert counts.count() == len(store.batches()) > 1
    assert tuple(total)[:4] == tuple(status) and total.n_lines == sum(map(len, files.values()))
    assert total.n_new == store.read("records", METER_RECORD).count() > 0
    assert total.n_bad_json + total.n_bad_field == store.read("quarantine", QUARANTINE).where("reason LIKE 'bad%'").count()


def test_sql_functions(spark):
    sql_text.register_functions(spark)
    got = spark.sql("""SELECT is_not_anomaly(60, 100, 0, 0) a, is_not_anomaly(60, 101, 0, 0) b, is_not_anomaly(60, 101, 0, 0, 200) c,
        is_not_anomaly(NULL, 1, 0, 0) d, is_not_anomaly(60, 1, 0, -1) e, far_future(NULL) f, counter_delta(5, 7) g, counter_delta(7, 5) h, counter_delta(7, NULL) i""").first()
    assert tuple(got) == (True, False, True, False, False, dt.datetime(9999, 12, 31), 5, 2, 7)


@pytest.mark.parametrize("value", ["2024-01-01'; DROP TABLE x; --", "2024-01-01 00:00:00' OR '1'='1", ":end_time", "{snapshots}", "now()", "2024-01-01T00:00:00+07:00", "", None])
def test_hostile_times(spark, value):
    rows = b.session_snapshot(spark, SF_DIR)
    with pytest.raises((ValueError, PySparkException)):
        sql_text.session_stage_text(rows, value, "2024-01-01 02:00:00").collect()


def test_sql_stage_with_hostile_rows(spark):
    """Text of rows is data: quotes and markers change nothing."""
    rows = b.session_snapshot(spark, SF_DIR).withColumn("username", F.lit("x'; :end_time {snapshots} --"))
    got = sql_text.session_stage_text(rows, "2024-01-01 00:00:00", "2024-01-01 02:00:00")
    want = sessions.session_stage(rows)
    assert got.schema.names == want.schema.names and got.count() == rows.count()
    assert got.exceptAll(want).isEmpty()
    assert sql_text.session_stage_text(rows, "2024-01-01 02:00:00", "2024-01-01 03:00:00").isEmpty()
