import datetime as dt

from meterflow.plans import telemetry
from meterflow.schemas import DISK_RULES, PROCESS_SNAPSHOT
from meterflow.session import small_table

T0 = dt.datetime(2024, 1, 1)


def proc(i, **more):
    base = dict(server="db1", snapshot_ts=T0, id=i, user="u", host="h", db="d", command="Query", time=10,
                state="executing long query", query_id=i, progress=0.0)
    return base | more


def snapshot(spark, rows):
    return small_table(spark, rows, PROCESS_SNAPSHOT)


def test_active(spark):
    rows = [proc(1), proc(2, command="Sleep"), proc(3, command="Daemon"), proc(4, command="Binlog Dump"),
            proc(5, command=None), proc(6, state="User sleep"), proc(7, state=None), proc(8, command="Killed")]
    assert sorted(r.id for r in telemetry.proc_active(snapshot(spark, rows)).collect()) == [1, 7, 8]


def test_report(spark):
    rows = [proc(i, user="busy") for i in range(50)] + [proc(100 + i, user="calm") for i in range(49)]
    rows += [proc(200 + i, user=None) for i in range(60)]
    rows += [proc(301, time=1800), proc(302, time=1801, user=None, db=None), proc(303, time=90061, command="Killed"),
             proc(304, time=None), proc(305, time=90061, state=None)]
    counts, long, texts = telemetry.proc_report(snapshot(spark, rows))
    assert [(r.user, r.commands) for r in counts.collect()] == [("busy", 50)]
    assert sorted((r.id, r.user, r.db, r.state, r.time) for r in long.collect()) == [
        (302, "-", "-", "executing lo", 1801), (305, "u", "d", "-", 90061)
    ]
    text = texts.first()
    assert text.n == 2 and text.part == 0
    assert text.text.startswith("302\nServer: db1\nUser: -\n") and text.text.endswith("Time: 1 day, 1:01:01")


def test_disks(spark):
    rules = small_table(spark, [dict(host_suffix=h, mount=m, min_pct=p) for h, m, p in (
        ("", "/", 80), (".7", "/tmpdir", 80), (".45", "/", 90), (".45", "/backup", 90))], DISK_RULES)
    lines = [("A - 1.7", f"/dev/a 9G 1G 1G {p}% {m}") for p, m in ((79, "/"), (80, "/"), (95, "/tmpdir"), (95, "/backup"))]
    lines += [("B - 1.45", f"/dev/b 9G 1G 1G {p}%  {m} ") for p, m in ((80, "/"), (90, "/"), (89, "/backup"), (91, "/backup"))]
    lines += [("B - 1.45", "Filesystem Size Used Avail Use% Mounted on"), ("B - 1.45", "/dev/c 9G"), ("B - 1.45", "")]
    df = spark.createDataFrame(
        [(h, T0, i, text) for i, (h, text) in enumerate(lines)],
        "host string, report_ts timestamp_ntz, line_no bigint, line string",
    )
    breaches, texts = telemetry.disk_report(df, rules)
    assert sorted((r.host[0], r.used_pct, r.mount, r.min_pct) for r in breaches.collect()) == [
        ("A", 80, "/", 80), ("A", 95, "/tmpdir", 80), ("B", 90, "/", 90), ("B", 91, "/backup", 90)
    ]
    assert {r.host[0]: r.text for r in texts.collect()}["B"] == (
        "Disk usage on /dev/b is 90% /\nDisk usage on /dev/b is 91% /backup"
    )
