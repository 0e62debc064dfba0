from meterflow.functions import expr
from meterflow.operators import changes, rollup
from pyspark.sql import functions as F


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_insert_ignore(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "v int, k string")
    new = spark.createDataFrame([(9, "a"), (8, "c"), (7, "c"), (6, None), (5, None)], "v int, k string")
    got = changes.insert_ignore(target, new, ["k"], ["v"])
    assert rows(got) == sorted([(1, "a"), (2, "b"), (3, None), (7, "c"), (6, None), (5, None)], key=str)


def test_keyed_update_overwrites_with_null(spark):
    target = spark.createDataFrame([(1, 10, "x"), (2, 20, "y"), (None, 30, "z")], "k int, v int, w string")
    updates = spark.createDataFrame([(1, None), (None, 5), (4, 4)], "k int, v int")
    assert rows(changes.keyed_update(target, updates, ["k"], ["v"])) == sorted(
        [(1, None, "x"), (2, 20, "y"), (None, 30, "z")], key=str
    )


def test_upsert(spark):
    schema = "id int, k string, load_time timestamp_ntz"
    target = spark.createDataFrame([(1, "a", None), (2, "b", None), (3, None, None)], schema)
    new = spark.createDataFrame([(0, "a"), (5, "c"), (6, "c"), (7, None)], "id int, k string")
    got = changes.upsert(target, new, ["k"], "2024-01-01 00:00:00", ["id"])
    assert sorted((r.id, r.k, r.load_time is not None) for r in got.collect() if r.k) == [
        (0, "a", True), (2, "b", False), (6, "c", True)
    ]
    assert sorted(r.id for r in got.collect() if r.k is None) == [3, 7]


def test_move_flagged_keeps_rows_without_state(spark):
    records = spark.createDataFrame([(1, 2), (2, None), (3, 0)], "id int, state int")
    remaining, log = changes.move_flagged(records, records.limit(0))
    assert rows(remaining) == [(2, None), (3, 0)] and rows(log) == [(1, 2)]


def test_joined_text_in_parts_holds_every_line(spark):
    df = spark.range(25).select(F.col("id"), F.floor(F.col("id") / 20).alias("g"), F.col("id").cast("string").alias("t"))
    df = df.withColumn("g", F.when(F.col("g") == 0, F.lit(None)).otherwise(F.col("g")))
    got = rollup.joined_text(df, ["g"], ["id"], "t", max_lines=6).collect()
    assert sum(r.n for r in got) == 25 and max(r.n for r in got) <= 6
    assert sorted(t for r in got for t in r.text.split("\n")) == sorted(str(i) for i in range(25))
    assert [r.text for r in got if r.g == 1] == ["20\n21\n22\n23\n24"]
    # parts in their order are the whole text
    long = "\n".join(r.text for r in sorted(got, key=lambda r: r.part) if r.g is None)
    assert long == "\n".join(map(str, range(20)))


def test_expressions_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(1706000000,)], "s bigint")
    ts = expr.epoch_to_local(F.col("s"), "Asia/Jakarta")
    row = [
        ts.cast("string"),
        expr.epoch_seconds(expr.ntz("2024-03-10 02:30:00")),
        expr.trunc_seconds(expr.ntz("2024-03-10 02:39:59.5"), 600).cast("string"),
    ]
    found = []
    for zone in ("America/New_York", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        found.append(tuple(df.select(*row).first()))
    assert found[0] == found[1] == ("2024-01-23 15:53:20", 1710037800, "2024-03-10 02:30:00")


def test_duration_text(spark):
    seconds = [0, 59, 1801, 86400 + 3661, 3 * 86400, -1]
    df = spark.createDataFrame([(s,) for s in seconds], "s bigint")
    got = [r[0] for r in df.select(expr.duration_text(F.col("s"))).collect()]
    import datetime as dt

    assert got == [str(dt.timedelta(seconds=s)) for s in seconds]


def test_not_in_keeps_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert rows(df.where(expr.not_in_keep_null(F.col("c"), ["a"]))) == sorted([("b",), (None,)], key=str)
