"""Cutting series into chunks must never show in the results."""
import random

import pytest
import stillwater as sw
from pyspark.sql import functions as F
from stillwater.plans import layout as chunks
from stillwater.plans.scan import running

from conftest import at


@pytest.fixture(scope="module")
def long_series(spark):
    r = random.Random(3)
    level, rows = 5.0, []
    for i in range(1900):
        level = 5.0 if i % 400 == 0 else level + r.gauss(0.02, 0.05)
        mean = None if r.random() < 0.05 else round(level, 3)
        flag = "site visit" if i % 523 == 0 else None
        rows.append(("bellvue", "Turbidity" if i % 2 else "DO", at(i // 2 * 4), mean, flag))
    return spark.createDataFrame(rows, "site string, parameter string, dt_round timestamp, mean double, flag string")


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("run", [
    lambda df, lay: sw.summary_statistics(df, lay),
    lambda df, lay: sw.do_noise_flags(sw.summary_statistics(df, lay), lay),
    lambda df, lay: sw.drift_flag(df, lay),
    lambda df, lay: sw.interpolate_gaps(df, lay),
    lambda df, lay: sw.low_pass(df, lay),
    lambda df, lay: sw.suspect_flag(df.withColumn("auto_flag", F.when(F.col("mean") > 6, "slope violation")), lay),
], ids=["statistics", "do", "drift", "gaps", "smooth", "suspect"])
def test_chunk_size_and_numbering_do_not_matter(long_series, run, monkeypatch):
    monkeypatch.setattr(chunks, "HALO_SHARE", 1)
    layouts = [sw.Layout("1 hour", gap_free=g, slots=s) for g, s in ((True, 100000), (True, 16), (False, 16))]
    first, *others = [rows_of(run(long_series, lay)) for lay in layouts]
    assert len(first) == 1900
    assert all(o == first for o in others)


def test_rows_frames_cross_gaps(spark, series, column):
    df = series([1, 2, 3, 4, 5, 6, 7, 8]).where("minute(dt_round) <> 30")
    want = column(df, "mean")[1:] + [None]
    for slots in (2, 4096):
        assert column(sw.summary_statistics(df, sw.Layout(slots=slots)), "front1") == want


def test_no_fan_out(long_series):
    lay = sw.Layout("1 hour", gap_free=True, slots=16)
    assert sw.field_flags(long_series.withColumns({
        "last_site_visit": F.lit(None).cast("timestamp"), "sonde_employed": F.lit(0)}), lay).count() == 1900


def test_running(spark):
    rows = [("k", i, i // 7, i if i % 5 == 0 else None) for i in range(100)] + [("l", 3, 0, None)]
    df = spark.createDataFrame(rows, "k string, t int, b int, v int")
    got = running(df, ("k",), "t", "b", sums={"n": F.lit(1)}, lasts={"seen": F.col("v")}, following="next")
    out = {r["t"]: r for r in got.where("k = 'k'").collect()}
    assert all(out[i]["n"] == i + 1 and out[i]["seen"] == i // 5 * 5 for i in range(100))
    assert all(out[i]["next"] == (i + 1 if i < 99 else None) for i in range(100))
    lone = got.where("k = 'l'").first()
    assert (lone["n"], lone["seen"], lone["next"]) == (1, None, None)
