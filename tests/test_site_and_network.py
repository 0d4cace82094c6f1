import random
from datetime import datetime, timedelta

import pytest
import stillwater as sw
from pyspark.sql import functions as F
from stillwater.schema import NETWORK_IGNORED

from conftest import at


def table(spark, rows):
    return spark.createDataFrame([(s, p, at(i), m, f) for s, p, i, m, f in rows],
                                 "site string, parameter string, dt_round timestamp, mean double, flag string")


def flags(df, name="flag"):
    return {(r["site"], r["parameter"], round((r["dt_round"] - at(0)) / (at(1) - at(0)))): r[name] for r in df.collect()}


def test_frozen_and_unsubmerged_concern_all_parameters(spark):
    df = table(spark, [("a", "Temperature", 0, 0.0, None), ("a", "DO", 0, 8.0, "x"), ("b", "DO", 0, 8.0, None),
                       ("a", "Depth", 1, 0.0, None), ("a", "DO", 1, 8.0, None),
                       ("a", "Specific Conductivity", 2, 10.0, None), ("a", "DO", 2, 8.0, None)])
    got = flags(sw.frozen_flag(df))
    assert got[("a", "DO", 0)] == "x;frozen" and got[("b", "DO", 0)] is None and got[("a", "DO", 1)] is None
    hit = {m: {k for k, v in flags(sw.unsubmerged_flag(df, m)).items() if v and "unsubmerged" in v} for m in ("depth", "sc", "depth_sc")}
    assert hit["depth"] == {("a", "Depth", 1), ("a", "DO", 1)}
    assert hit["sc"] == {("a", "Specific Conductivity", 2), ("a", "DO", 2)} and hit["depth_sc"] == hit["depth"] | hit["sc"]
    with pytest.raises(ValueError):
        sw.unsubmerged_flag(df, "wet")


def test_burial_spreads_from_do_only(spark):
    df = table(spark, [("a", "DO", 0, 1.0, "DO interference;Possible burial"), ("a", "pH", 0, 7.0, None),
                       ("a", "pH", 1, 7.0, None), ("a", "Depth", 1, 7.0, "Possible burial")])
    got = flags(sw.spread_burial(df))
    assert got[("a", "pH", 0)] == "Possible burial" and got[("a", "pH", 1)] is None
    assert got[("a", "DO", 0)] == "DO interference;Possible burial"


def test_slope_reconciliation(spark):
    sv = "slope violation"
    rows = [("a", "pH", i, 7.0, sv) for i in range(6)] + [("a", "Depth", i, 1.0, sv if i == 2 else None) for i in range(6)]
    rows += [("a", "Temperature", i, 1.0, f"{sv};x" if i == 5 else None) for i in range(6)]
    got = flags(sw.reconcile_slope(table(spark, rows)))
    assert [got[("a", "pH", i)] for i in range(6)] == [sv, None, None, None, None, None]
    assert got[("a", "Depth", 2)] is None and got[("a", "Temperature", 5)] == ";x"


RECORDS = [
    # site, start, end, parameter, notes (in steps of the grid)
    ("a", 10, 20, "Turbidity", "biofilm and gunk"), ("a", 15, 15, "Turbidity", "cable"), ("a", 30, None, "pH", "broken"),
    ("a", 40, 42, None, "hit by a log"), ("a", 50, 52, "DO", "BURIED in sediment, biofilm"), ("a", 55, 56, "DO", "not submerged"),
    ("a", 60, 61, "Depth", "improper level calibration"), ("b", 0, 99, "Turbidity", None), ("a", 11, 12, "Turbidity", "grime"),
]


def malfunction_labels(parameter, i, site="a"):
    out = set()
    for s, start, end, p, notes in RECORDS:
        text = (notes or "").lower()
        buried = any(w in text for w in ("buried", "burial", "bury", "sediment", "roots"))
        wet = "not submerged" in text
        mine = p is None or p == parameter or buried or wet or (parameter == "ORP" and p == "pH")
        if s != site or not mine or not (start <= i <= (end if end is not None else 10 ** 9)):
            continue
        fouled = any(w in text for w in ("grime", "gunk", "drift", "biofoul", "biofilm"))
        depth = "improper level calibration" in text
        out |= {"reported sonde burial"} if buried else set()
        out |= {"reported sensor biofouling"} if fouled else set()
        out |= {"reported depth calibration malfunction"} if depth else set()
        out |= {"reported sonde unsubmerged"} if wet else set()
        out |= set() if buried or fouled or depth or wet else {"reported sensor malfunction"}
    return out


@pytest.mark.parametrize("slots", [8, 4096])
def test_malfunctions_against_brute_force(spark, slots):
    params = ("Turbidity", "pH", "ORP", "Depth")
    df = table(spark, [("a", p, i, 1.0, None) for p in params for i in range(70)] + [("b", "Turbidity", 5, 1.0, None)])
    records = spark.createDataFrame([(at(s), None if e is None else at(e), site, p, n) for site, s, e, p, n in RECORDS],
                                    "start_dt timestamp, end_dt timestamp, site string, parameter string, notes string")
    got = flags(sw.malfunction_flag(df, records, sw.Layout(slots=slots)), "mal_flag")
    for p in params:
        for i in range(70):
            assert set((got[("a", p, i)] or "").split(";\n")) - {""} == malfunction_labels(p, i), (p, i)
    assert got[("b", "Turbidity", 5)] == "reported sensor malfunction"


def test_malfunction_keeps_flags_of_other_rows(spark):
    df = table(spark, [("a", "DO", i, 1.0, None) for i in range(5)]).withColumn(
        "mal_flag", F.when(F.col("dt_round") == F.lit(at(0)), "old"))
    records = spark.createDataFrame([(at(0), at(1), "a", "DO", "x")],
                                    "start_dt timestamp, end_dt timestamp, site string, parameter string, notes string")
    got = flags(sw.malfunction_flag(df, records), "mal_flag")
    assert [got[("a", "DO", i)] for i in range(5)] == ["old;\nreported sensor malfunction", "reported sensor malfunction", None, None, None]


def networks(spark, rows):
    return sw.normal_networks(spark.createDataFrame([(n, s, i) for i, (n, s) in enumerate(rows)],
                                                    "network_name string, network string, network_order int"))


def test_edges_prefer_the_own_network(spark):
    got = {r["site"]: (r["up"], r["down"]) for r in sw.network_edges(networks(spark, [
        ("clp", "joei, riverbend , cottonwood"), ("spring", "riverbend, spring, cottonwood"), ("riverbend", "x, riverbend"),
        ("sfm", "sfm"), ("m", "mtn_campus, Tamasag")])).collect()}
    assert got == {"joei": (None, "riverbend"), "riverbend": ("x", None), "cottonwood": ("riverbend", None),
                   "spring": ("riverbend", "cottonwood"), "x": (None, "riverbend"),
                   "mtncampus": (None, "bellvue"), "bellvue": ("mtncampus", None)}


@pytest.mark.parametrize("gap_free", [True, False])
def test_network_against_brute_force(spark, gap_free):
    r = random.Random(1)
    sites, pool = ("a", "b", "c", "lone"), [None] * 6 + ["slope violation", "drift", "outside of seasonal range", "missing data"]
    n = 60
    truth = {(s, p, i): r.choice(pool) if p == "DO" or i % 3 else None for s in sites for p in ("DO", "pH") for i in range(n)}
    df = table(spark, [(s, p, i, 1.0, f) for (s, p, i), f in truth.items()])
    edges = sw.network_edges(networks(spark, [("n", "a, b, c"), ("one", "lone")]))
    got = flags(sw.network_check(df, edges, sw.Layout(gap_free=gap_free, slots=20)), "auto_flag")
    near = {"a": "b", "b": "ac", "c": "b", "lone": ""}

    def telling(f):
        return f is not None and not any(x in f for x in NETWORK_IGNORED)
    for (s, p, i), f in truth.items():
        full = i >= 8 and i + 8 < n
        heard = full and any(telling(truth[(t, p, j)]) for t in near[s] for j in range(i - 8, i + 9))
        assert got[(s, p, i)] == (None if telling(f) and heard else f), (s, p, i)
    kept = flags(sw.network_check(df, edges, sw.Layout(slots=20), exempt_parameters=("DO",)), "auto_flag")
    assert all(kept[k] == f for k, f in truth.items() if k[1] == "DO")


def test_tidy(spark):
    given = [None, "", ";", "b; a;;", "x;frozen", "drift;site visit", "b;\nA", "sv window;drift", "site visit window",
             "reported sonde not employed;x"]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(given)], "i int, auto_flag string")
    assert [r["auto_flag"] for r in sw.tidy_flags(df).orderBy("i").collect()] == [
        None, None, None, "a;b", "frozen", "site visit", "A;b", "site visit window", "site visit", "sonde not employed"]


def suspects(series, column, auto, means=None):
    df = series(means or [1.0] * len(auto), auto_flag=auto, types={"auto_flag": "string"})
    return column(sw.suspect_flag(df), "auto_flag")


def test_suspect_among_flagged(series, column):
    auto = ["slope violation"] * 4 + [None] * 12
    got = suspects(series, column, auto)
    want = list(auto)
    for i in range(16):
        for first, last in ((i - 7, i), (i - 3, i + 4)):
            if auto[i] is None and first >= 0 and last < 16 and sum(a is not None for a in auto[first:last + 1]) >= 4:
                want[i] = "suspect data"
    assert got == want and "suspect data" in got
    assert suspects(series, column, ["missing data"] * 4 + [None] * 12)[4:] == [None] * 12
    assert suspects(series, column, ["suspect data"] * 4 + [None] * 12)[4:] == [None] * 12


def test_single_value_among_missing(series, column):
    means = [None] * 7 + [5.0] + [None] * 8
    assert [i for i, f in enumerate(suspects(series, column, [None] * 16, means)) if f] == [7]


def test_lone_suspect(series, column):
    auto = [None, "suspect data", None, "suspect data", "suspect data", None, "drift", "suspect data"]
    df = series([1.0] * 8, auto_flag=auto)
    assert column(sw.drop_lone_suspect(df), "auto_flag") == [None, None, None, *auto[3:]]


def test_final_and_dashboard_columns(series):
    df = series([10.0], parameter="Temperature", auto_flag=[""], smoothed_mean=[1.0], site="cottonwood")
    out = sw.final_projection(df).first()
    assert len(out) == 14 and out["auto_flag"] is None and out["dt_join"] == "2024-03-01 00:00:00"
    shown = sw.dashboard_columns(df).first()
    assert (shown["site_dashboard"], shown["mean_dashboard"]) == ("Cottonwood Hollow", 50.0)
    turbid = sw.dashboard_columns(series([10.0], smoothed_mean=[1.5])).first()
    assert turbid["mean_dashboard"] == 1.5
