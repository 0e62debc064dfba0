"""URL lists against a plain version that looks at every entry for every capture, and odd rows."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from meterflow.llm.url_lists import ACTIONS, filter_captures, op5_url_lists, validity

CAPTURES = "url string, fetched_at timestamp_ntz"
ENTRIES = "list string, pattern string, action string, effective timestamp_ntz"


def at(day, hour=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=hour)


def plain(captures, entries):
    out = []
    for url, time in captures:
        m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", url or "")
        host = re.sub(r"^.*@|:[0-9]*$|[.]$", "", m[1].lower()) if m else ""
        seg = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", url or "")
        active = []
        if host and time is not None:
            for lst, pattern in {(e[0], e[1]) for e in entries if e[1] is not None}:
                if not (host == pattern or host.endswith("." + pattern) or (seg and f"{host}/{seg[1]}" == pattern)):
                    continue
                past = [(e[3], ACTIONS.index(e[2])) for e in entries if e[:2] == (lst, pattern) and e[2] in ACTIONS and e[3] is not None and e[3] <= time]
                if past and max(past)[1] > 0:
                    active.append((len(pattern), pattern, ACTIONS[max(past)[1]]))
        best = max(active, default=(0, None, None))
        out.append((url, time, len(active), best[1], best[2], best[2] == "blocked"))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("url", "fetched_at", "n_active", "pattern", "action", "blocked").collect()), key=str)


def test_against_plain_version(spark):
    rng = random.Random(4)
    hosts = ["a.example.com", "example.com", "B.Example.com", "com", "x.org", "deep.a.example.com", "example.com."]
    urls = [f"{rng.choice(['http', 'https', 'HTTP'])}://{rng.choice(['', 'u:p@'])}{h}{rng.choice(['', ':80'])}{rng.choice(['', '/', '/en', '/en/x?y#z', '?q', '/EN'])}" for h in hosts for _ in range(6)]
    urls += ["", "no url", "://x", "http://", "http:///en", "ftp://x.org/a b", None, "http://x.org/" + "p" * 50000]
    captures = [(rng.choice(urls), rng.choice([None, *[at(rng.randrange(120), rng.randrange(24)) for _ in range(9)]])) for _ in range(250)] + [(u, at(60)) for u in urls]
    patterns = ["example.com", "a.example.com", "com", "x.org", "x.org/en", "example.com/en", "a.example.com/EN", "nowhere", None, "", "ample.com"]
    entries = [(rng.choice(["l1", "l2", None]), rng.choice(patterns), rng.choice([*ACTIONS, *ACTIONS, "other", None]), rng.choice([None, *[at(rng.randrange(-40, 130)) for _ in range(12)]])) for _ in range(160)]
    entries += [("l1", "x.org", "blocked", at(5)), ("l1", "x.org", "allowed", at(5)), ("l1", "x.org", "removed", at(5)), ("l2", "x.org", "allowed", at(60))]
    got = rows(filter_captures(spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(entries, ENTRIES)))
    assert got == plain(captures, entries) and any(r[5] for r in got)


def test_intervals(spark):
    entries = [("l", "p", "blocked", at(1)), ("l", "p", "allowed", at(3)), ("l", "p", "removed", at(5)), ("l", "p", "blocked", at(7)), ("l", "p", "blocked", at(7)), ("m", "p", "removed", at(2))]
    got = {tuple(r)[2:] for r in validity(spark.createDataFrame(entries, ENTRIES)).collect()}
    assert got == {("allowed", at(3), at(5)), ("blocked", at(1), at(3)), ("blocked", at(7), None)}


def test_bounds_and_ties(spark):
    """An entry holds from its time on and until the next one; of two lists that disagree the one that blocks counts."""
    entries = [("l", "a.b", "blocked", at(10)), ("l", "a.b", "removed", at(20)), ("m", "a.b", "allowed", at(10)), ("m", "b", "blocked", at(0))]
    captures = [("http://a.b/", t) for t in (at(9, 23), at(10), at(19, 23), at(20))]
    got = {r[1]: r[2:] for r in rows(filter_captures(spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(entries, ENTRIES)))}
    assert got == {at(9, 23): (1, "b", "blocked", True), at(10): (3, "a.b", "blocked", True), at(19, 23): (3, "a.b", "blocked", True), at(20): (2, "a.b", "allowed", False)}


def test_odd_tables(spark):
    captures = spark.createDataFrame([("http://a.b/", at(1)), ("http://a.b/", at(1)), (None, None)], CAPTURES)
    entries = spark.createDataFrame([("l", "b", "blocked", at(0))], ENTRIES)
    clash = captures.withColumns({c: F.lit("own") for c in ("pattern", "blocked", "host", "labels", "month", "list", "n_active")})
    got = filter_captures(clash, entries)
    assert sorted((r.host, r.month, r.list, r.n_active, r.blocked) for r in got.collect()) == [("own", "own", "own", 0, False)] + [("own", "own", "own", 1, True)] * 2
    assert [r[2] for r in rows(filter_captures(captures, entries.limit(0)))] == [0, 0, 0]
    assert filter_captures(captures.limit(0), entries).collect() == []
    assert rows(filter_captures(captures.where("url IS NULL"), entries)) == [(None, None, 0, None, None, False)]


def test_no_python_and_no_nested_loop(spark):
    plan = op5_url_lists(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)
