"""The fused run against the operators one by one, and across executor-style reruns."""
import random
from datetime import timedelta

import pytest
import stillwater as sw
from pyspark.sql import functions as F
from stillwater.plans.pipeline import flag_network, flag_site_evidence

from conftest import at

HOUR = timedelta(hours=1)
SPEC = {"Temperature": (-5, 30), "DO": (0, 20), "Turbidity": (0, 40), "Depth": (-1, 5)}
SITES, N = ("bellvue", "salyer"), 420


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    r = random.Random(11)
    rows = []
    for s in SITES:
        for p, base, wobble in (("Temperature", 4, 3), ("DO", 8, 2), ("Turbidity", 12, 2), ("Depth", 1, 0.7), ("Specific Conductivity", 200, 90)):
            level = 0.0
            for i in range(N):
                level = 0.0 if i % 130 == 0 else level + 0.2
                if r.random() < 0.07 or 200 <= i < 212:
                    continue
                v = round(base + r.gauss(0, wobble / 3) + (level if p == "Turbidity" else 0), 2)
                if p == "DO" and 250 <= i < 290:
                    v = 3.0
                if p == "Depth" and 330 <= i < 336:
                    v = -0.2
                if p == "Temperature" and 60 <= i < 66:
                    v = -0.5
                rows.append((s, "1", "sonde", at(i, HOUR), p, v, "u"))
    raw = spark.createDataFrame(rows, sw.schema.RAW_READING)
    notes = spark.createDataFrame([(s, at(i, HOUR), at(i, HOUR), e, i % 2 == 0) for s, i, e in (
        ("bellvue", 3, 0), ("bellvue", 150, 1), ("bellvue", 170, 0), ("salyer", 1, 0), ("salyer", 300, None))],
        "site string, dt_round timestamp, last_site_visit timestamp, sonde_employed int, sonde_moved boolean")
    malfunctions = spark.createDataFrame([
        (at(10, HOUR), at(30, HOUR), "bellvue", "DO", "biofilm"), (at(400, HOUR), None, "salyer", None, "cable"),
        (at(100, HOUR), at(101, HOUR), "salyer", "pH", "buried")], "start_dt timestamp, end_dt timestamp, site string, parameter string, notes string")
    limits = spark.createDataFrame([("winter_baseflow", s, p, lo, hi, -k, k) for s in SITES for p, lo, hi, k in (
        ("Temperature", 1.0, 7.0, 0.03), ("DO", 5.0, 10.0, 0.02), ("Turbidity", 8.0, 30.0, 0.08), ("Depth", 0.2, 2.0, 0.01))],
        "season string, site string, parameter string, t_mean01 double, t_mean99 double, t_slope_behind_01 double, t_slope_behind_99 double")
    edges = sw.network_edges(sw.normal_networks(sw.literal_table(
        spark, [{"network_name": "n", "network": "bellvue, salyer", "network_order": 0}], sw.schema.NETWORKS)))
    path = str(tmp_path_factory.mktemp("world"))
    sw.prepare_series(raw, "1 hour").write.parquet(path + "/padded")
    return {"raw": raw, "notes": notes, "malfunctions": malfunctions, "thresholds": limits, "spec": SPEC, "edges": edges,
            "padded": spark.read.parquet(path + "/padded")}


COLUMNS = ["site", "parameter", "dt_round", "mean", "auto_flag", "mal_flag", "sonde_employed", "sonde_moved", "last_site_visit",
           "front1", "rollmed", "season", "mean_filled", "smoothed_mean"]


def frozen(df):
    return sorted(map(str, df.withColumns({c: F.round(c, 9) for c in ("smoothed_mean", "mean_filled", "mean")}).select(COLUMNS).collect()))


def inputs(world, *names):
    return {n: world[n] for n in names}


@pytest.fixture(scope="module")
def one_by_one(world):
    lay = sw.Layout("1 hour")
    bounds = sw.time_bounds(world["padded"])
    df = sw.attach_field_notes(sw.number_rows(world["padded"], lay), world["notes"], lay, bounds)
    df = sw.summary_statistics(df, lay)
    df = sw.missing_flag(sw.field_flags(df, lay))
    df = sw.drift_flag(sw.repeat_flag(sw.do_noise_flags(df, lay)), lay)
    df = sw.seasonal_flag(sw.spec_flag(df, world["spec"]), world["thresholds"])
    df = sw.unsubmerged_flag(sw.spread_burial(sw.reconcile_slope(sw.frozen_flag(df), lay)))
    df = sw.malfunction_flag(df, world["malfunctions"], lay, bounds)
    df = sw.tidy_flags(sw.network_check(df, world["edges"], lay))
    df = sw.drop_lone_suspect(sw.suspect_flag(df, lay), lay)
    return frozen(sw.low_pass(sw.interpolate_gaps(df, lay), lay, "mean_filled"))


def test_fused_run_equals_the_operators(world, one_by_one):
    fused = sw.run_pipeline(world["raw"], interval="1 hour", **inputs(world, "notes", "malfunctions", "thresholds", "spec", "edges"))
    assert frozen(fused) == one_by_one
    text = "".join(one_by_one)
    for label in ("drift", "Possible burial", "frozen", "site visit window", "slope violation", "suspect data", "sonde not employed",
                  "reported sensor biofouling", "reported sensor malfunction", "sonde unsubmerged", "missing data"):
        assert label in text, label


def test_numbered_rows_give_the_same(world, one_by_one):
    lay = sw.Layout("1 hour", gap_free=False, slots=64)
    df = flag_site_evidence(world["padded"], None, lay, **inputs(world, "notes", "malfunctions", "thresholds", "spec"))
    assert frozen(flag_network(df, lay, edges=world["edges"])) == one_by_one


def test_run_with_history(world, spark, tmp_path):
    args = {**inputs(world, "notes", "malfunctions", "thresholds", "spec", "edges"), "interval": "1 hour"}
    old = sw.curated(sw.run_pipeline(world["raw"].where(F.col("timestamp") < F.lit(at(300, HOUR))), **args))
    old.write.parquet(str(tmp_path / "old"))
    old = spark.read.parquet(str(tmp_path / "old"))
    new = sw.run_pipeline(world["raw"].where(F.col("timestamp") >= F.lit(at(310, HOUR))), history=old, period="3 days", **args)
    new.write.parquet(str(tmp_path / "new"))
    new = spark.read.parquet(str(tmp_path / "new"))
    rows = {(r["site"], r["parameter"], r["dt_round"]): r for r in new.collect()}
    stamps = sorted(t for s, p, t in rows if (s, p) == ("bellvue", "DO"))
    assert at(299 - 72, HOUR) in stamps and at(299 - 74, HOUR) not in stamps and at(305, HOUR) not in stamps
    assert {r["historical"] for r in rows.values()} == {True, False}
    # frames are counted in rows, so the row before the gap is the neighbour of the row after it
    first = min(t for t in stamps if t > at(305, HOUR))
    last = max(t for t in stamps if t < at(305, HOUR))
    assert rows[("bellvue", "DO", first)]["back1"] == rows[("bellvue", "DO", last)]["mean"]
    archive = sw.merge_archive(sw.curated(new), old, "3 days")
    assert archive.groupBy("site", "parameter", "dt_round").count().where("count > 1").count() == 0


def test_only_raw_is_needed(world):
    out = sw.curated(sw.run_pipeline(world["raw"], interval="1 hour"))
    assert out.columns[:5] == ["dt_round", "dt_join", "site", "parameter", "mean"]
    assert out.count() == world["padded"].count() and out.where("auto_flag = 'missing data'").count() > 0


def test_no_window_is_bound_to_a_whole_series(world):
    """Every exchange that precedes a window carries the chunk, the stamp or the bucket in its key."""
    fused = sw.run_pipeline(world["raw"], interval="1 hour", **inputs(world, "notes", "malfunctions", "thresholds", "spec", "edges"))
    plan = fused._jdf.queryExecution().optimizedPlan().toString()
    series_only = [line for line in plan.splitlines() if "Window [" in line and "_chunk" not in line]
    # what is left scans the small tables of notes, malfunctions and networks
    assert all("_bucket" in line or "_first" in line or "_order" in line or "_c_" in line for line in series_only), series_only
