from datetime import datetime, timedelta

import pytest
import stillwater as sw
from pyspark.sql import functions as F

from conftest import at

HOUR = timedelta(hours=1)


def rows(spark, parts, **columns):
    data = [(s, p, at(i, HOUR), float(i), f) for s, p, first, last, f in parts for i in range(first, last)]
    return spark.createDataFrame(data, "site string, parameter string, dt_round timestamp, mean double, auto_flag string")


@pytest.fixture()
def both(spark):
    history = rows(spark, [("a", "DO", 0, 48, "old"), ("gone", "DO", 0, 10, "old")]).withColumns(
        {"historical": F.lit(True), "sonde_moved": F.lit(True)})
    incoming = rows(spark, [("a", "DO", 36, 60, None), ("new", "DO", 0, 5, None)]).drop("auto_flag").withColumn("flag", F.lit(None).cast("string"))
    return incoming, history


def test_merge_before_flagging(both):
    incoming, history = both
    out = sw.merge_preflag(incoming, history, "24 hours")
    a = {r["dt_round"]: r for r in out.where("site = 'a'").collect()}
    assert sorted(a) == [at(i, HOUR) for i in range(23, 60)]
    assert all((r["flag"], r["historical"]) == (("old", True) if t <= at(47, HOUR) else (None, False)) for t, r in a.items())
    assert out.where("site = 'new' AND NOT historical").count() == 5 and out.where("site = 'gone'").count() == 0
    assert "sonde_moved" not in out.columns


def test_archive_write_back_is_idempotent(both):
    incoming, history = both
    flagged = sw.merge_preflag(incoming, history, "24 hours").withColumn("auto_flag", F.lit("again"))
    once = sw.merge_archive(flagged, history, "24 hours")
    key = ["site", "parameter", "dt_round", "auto_flag", "historical"]
    assert once.groupBy("site", "parameter", "dt_round").count().where("count > 1").count() == 0
    got = {r["dt_round"]: r["auto_flag"] for r in once.where("site = 'a'").collect()}
    assert sorted(got) == [at(i, HOUR) for i in range(60)]
    assert all(v == ("old" if t < at(23, HOUR) else "again") for t, v in got.items())
    assert once.where("site = 'gone' AND auto_flag = 'old'").count() == 10 and once.where("site = 'new'").count() == 5
    assert once.where("NOT historical").count() == 0
    assert sorted(map(str, sw.merge_archive(flagged, history, "24 hours").select(key).collect())) == sorted(map(str, once.select(key).collect()))
    changed = {(r["site"], r["changed_rows"]) for r in sw.overlap_changes(flagged, history, "24 hours").collect()}
    assert changed == {("a", 25)}


def test_archive_keeps_rows_without_key(spark):
    history = rows(spark, [("a", "DO", 0, 48, "old"), (None, "DO", 0, 3, "old"), ("a", None, 0, 4, "old")]).unionByName(
        rows(spark, [("b", "DO", 0, 2, "old")]).withColumn("dt_round", F.lit(None).cast("timestamp")))
    flagged = rows(spark, [("a", "DO", 40, 50, "new"), ("b", "DO", 0, 1, "new")])
    out = sw.merge_archive(flagged, history, "12 hours")  # a history without the column "historical"
    assert out.where("site IS NULL").count() == 3 and out.where("parameter IS NULL").count() == 4
    assert out.where("site = 'b' AND dt_round IS NULL").count() == 2 and out.where("site = 'b'").count() == 3


def test_late_reading_replaces_its_stamp(spark):
    history = rows(spark, [("a", "DO", 0, 48, "old")]).withColumn("historical", F.lit(True))
    flagged = rows(spark, [("a", "DO", 5, 6, "late"), ("a", "DO", 40, 50, "new")])
    out = sw.merge_archive(flagged, history, "12 hours").where("site = 'a'")
    assert out.groupBy("dt_round").count().where("count > 1").count() == 0
    got = {r["dt_round"]: r["auto_flag"] for r in out.collect()}
    assert got[at(5, HOUR)] == "late" and got[at(4, HOUR)] == got[at(6, HOUR)] == "old" and got[at(45, HOUR)] == "new"
    assert sorted(got) == [at(i, HOUR) for i in [*range(35), *range(40, 50)]]


def test_merge_checks_its_input(both):
    incoming, history = both
    for merge in (sw.merge_preflag, sw.merge_archive):
        with pytest.raises(ValueError, match="period"):
            merge(incoming, history, None)
        with pytest.raises(ValueError, match="no data"):
            merge(None, None, "1 day")
        with pytest.raises(ValueError, match="incoming"):
            merge(None, history, "1 day")
        with pytest.warns(UserWarning, match="historical"):
            out = merge(incoming, None, "1 day")
        assert {r["historical"] for r in out.collect()} == {merge is sw.merge_archive}


def test_recent(spark):
    df = rows(spark, [("a", "DO", 0, 24 * 60, None)])
    assert sw.recent(df).count() == 45 * 24 + 1 and sw.recent(df, days=1).count() == 25


def test_old_years_are_not_read(spark, tmp_path):
    long = rows(spark, [("a", "DO", 0, 24 * 800, None), ("b", "DO", 24 * 700, 24 * 790, None)])
    sw.write_snapshot(long, str(tmp_path), "S", datetime(2024, 1, 1))
    archive = sw.read_latest(spark, str(tmp_path), "S")
    want = rows(spark, [("a", "DO", 24 * 755 - 1, 24 * 800, None), ("b", "DO", 24 * 755 - 1, 24 * 790, None)])
    for got, expected in ((sw.recent(archive), want), (sw.trailing_history(archive, "45 days"), None)):
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert any("year" in part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:])
        if expected is not None:
            key = ["site", "dt_round"]
            assert sorted(map(str, got.select(key).collect())) == sorted(map(str, expected.select(key).collect()))
        else:
            assert {(r["site"], r["n"]) for r in got.groupBy("site").agg(F.count("*").alias("n")).collect()} == {("a", 45 * 24 + 1), ("b", 45 * 24 + 1)}


NOW = datetime(2024, 6, 9, 12)


def track(spark, rows):
    return spark.createDataFrame([(n, "DO", f"{n}-DO", c, last, off, again) for n, c, last, off, again in rows], sw.schema.TRACKER)


def test_tracker(spark):
    tracker = track(spark, [
        ("ok", 5, datetime(2024, 1, 1), True, False), ("edge", 54, NOW - timedelta(days=1), False, False),
        ("limit", 55, NOW - timedelta(days=7), False, False), ("fresh", 3, NOW - timedelta(days=7) + timedelta(seconds=1), False, False),
        ("never", 0, None, False, True)])
    received = spark.createDataFrame([("ok", "DO", 1.0), ("ok", "DO", 2.0), ("unknown", "DO", 1.0)], "site string, parameter string, mean double")
    got = {r["site"]: (r["failure_count"], r["last_success"], r["auto_disabled"], r["try_again"])
           for r in sw.tracker_update(tracker, received, NOW).collect()}
    assert got == {
        "ok": (0, NOW, False, False), "edge": (55, NOW - timedelta(days=1), False, False),
        "limit": (56, NOW - timedelta(days=7), True, True), "fresh": (4, NOW - timedelta(days=7) + timedelta(seconds=1), False, False),
        "never": (1, None, False, True)}


def starts(spark, history, tracker, now):
    out = sw.session_dates(spark, history, tracker, now).collect()
    assert {r["site"] for r in out} == set(sw.schema.DEFAULT_SITES) and len({r["start_dt"] for r in out}) == 1
    assert {r["end_dt"] for r in out} == {now}
    return out[0]["start_dt"]


def test_session_without_history(spark):
    assert starts(spark, None, None, NOW) == datetime(2024, 3, 1, 7)  # midnight in winter time


def test_session_start(spark):
    def hist(temperature, do):
        return rows(spark, [("a", "Temperature", 0, temperature, None), ("a", "DO", 0, do, None), ("b", "Temperature", 0, 50, None)])

    def tracker(off, again):
        return spark.createDataFrame([("a", "Temperature", "a-Temperature", 0, NOW, False, False), ("a", "DO", "a-DO", 0, NOW, off, again),
                                      ("b", "Temperature", "b-Temperature", 0, NOW, False, False)], sw.schema.TRACKER)
    weekday, sunday = datetime(2024, 6, 10, 12), datetime(2024, 6, 9, 6, 30)  # Sunday 00:30 in Denver summer time
    assert starts(spark, hist(10, 10), tracker(False, False), weekday) == at(9, HOUR)
    # DO reaches further than Temperature: its site starts later
    assert starts(spark, hist(10, 20), tracker(False, False), weekday) == at(19, HOUR)
    assert starts(spark, hist(10, 20), tracker(True, True), weekday) == at(9, HOUR)
    assert starts(spark, hist(10, 20), tracker(True, True), sunday) == at(19, HOUR)
    assert starts(spark, hist(10, 20), tracker(True, False), sunday) == at(9, HOUR)


def test_retention(spark):
    snaps = [(d, k, f"{d}{k}{i}", at(i)) for d in "xy" for k in ("main", "archive", "tracker", "else") for i in range(12)]
    got = sw.retention(spark.createDataFrame(snaps, "dataset string, kind string, snapshot string, ts timestamp"))
    assert got.count() == len(snaps)
    kept = {(r["dataset"], r["kind"], r["snapshot"]) for r in got.where("keep").collect()}
    assert kept == {(d, k, f"{d}{k}{i}") for d in "xy" for k, n in (("main", 1), ("archive", 3), ("tracker", 10)) for i in range(12 - n, 12)}
