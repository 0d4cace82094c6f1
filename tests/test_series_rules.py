from datetime import timedelta

import pytest
import stillwater as sw
from pyspark.sql import functions as F

from conftest import at


def test_add_flag(spark):
    rows = [(None, True), ("a", True), ("drift", True), ("drift;a", None), (None, False)]
    df = spark.createDataFrame(rows, "flag string, c boolean")
    assert [r[0] for r in sw.add_flag(df, F.col("c"), "drift").select("flag").collect()] == [
        "drift", "a;drift", "drift", "drift;a", None]


def test_fold_equals_one_by_one(spark):
    df = spark.createDataFrame([(f, a, b) for f in (None, "x", "one", "two") for a in (True, False, None) for b in (True, False)],
                               "flag string, a boolean, b boolean")
    rules = [("one", F.col("a")), ("two", F.col("b"))]
    single = df
    for label, c in rules:
        single = sw.add_flag(single, c, label)
    assert sw.fold_flags(df, rules).collect() == single.collect()


def test_missing_and_repeat(series, column):
    df = sw.summary_statistics(series([1, 1, None, 2, 3]))
    assert column(sw.missing_flag(df), "flag") == [None, None, "missing data", None, None]
    assert column(sw.repeat_flag(df), "flag") == ["repeated value"] * 2 + [None] * 3


def test_spec_only_touches_listed_parameters(series, column):
    df = series([-1, 5, 11, None]).unionByName(series([99], parameter="pH"))
    for spec in ({"Turbidity": (0, 10)}, df.sparkSession.createDataFrame([("Turbidity", 0.0, 10.0)], sw.schema.SENSOR_SPEC)):
        out = sw.spec_flag(df, spec)
        label = "outside of sensor specification range"
        assert column(out.where("parameter = 'Turbidity'"), "flag") == [label, None, label, None]
        assert column(out.where("parameter = 'pH'"), "flag") == [None] and "spec_min" not in out.columns


def visits(series, n, *at_rows, flag=None):
    seen, last = [], None
    for i in range(n):
        last = at(i) if i in at_rows else last
        seen.append(last)
    return series([1.0] * n, last_site_visit=seen, sonde_employed=[0] * n, flag=flag or [None] * n,
                  types={"last_site_visit": "timestamp", "flag": "string"})


def test_visit_window(series, column):
    got = column(sw.field_flags(visits(series, 20, 10)), "flag")
    want = [None] * 20
    want[9] = want[11] = want[12] = want[13] = want[14] = "sv window"
    want[10] = "site visit"
    assert got == want


def test_history_label_does_not_start_a_visit(series, column):
    flags = [None] * 20
    flags[5] = "site visit window"
    flags[15] = "site visit"
    got = column(sw.field_flags(visits(series, 20, flag=flags)), "flag")
    assert got[4] is None and got[6] is None
    assert got[14] == "sv window" and got[16:20] == ["sv window"] * 4


def test_not_employed(series, column):
    df = visits(series, 3).withColumn("sonde_employed", F.lit(1))
    assert column(sw.field_flags(df), "flag") == ["sonde not employed"] * 3


def test_do_dip_and_low(series, column):
    df = sw.summary_statistics(series([8, 7.4, 8, 4.9, 5, 9], parameter="DO"))
    flags = column(sw.do_noise_flags(df), "flag")
    assert flags == [None, "DO interference", None, "DO interference", "DO interference", None]
    other = sw.summary_statistics(series([8, 7.4, 8, 4.9]))
    assert column(sw.do_noise_flags(other), "flag") == [None] * 4


@pytest.mark.parametrize("hits", [23, 24])
def test_burial_needs_24_of_96(series, column, hits):
    low = [4.0 if 12 <= i < 12 + hits else 9.0 for i in range(120)]
    flags = column(sw.do_noise_flags(sw.summary_statistics(series(low, parameter="DO"))), "flag")
    buried = {i for i, f in enumerate(flags) if f and "Possible burial" in f}
    want = set()
    for i in range(120):
        for first, last in ((i - 95, i), (i - 47, i + 48)):
            if first >= 0 and last < 120 and sum(v == 4.0 for v in low[first:last + 1]) >= 24:
                want.add(i)
    assert buried == want and bool(want) == (hits == 24)


def brute_drift(values, visit_rows, step_minutes):
    import numpy as np
    group, groups = 0, []
    for i in range(len(values)):
        group += i in visit_rows
        groups.append(group)

    def frame(i, back, ahead):
        return [j for j in range(len(values)) if groups[j] == groups[i]
                and -back <= (j - i) * step_minutes <= ahead]

    def fit(i, back, ahead):
        rows = frame(i, back, ahead)
        known = [(j, values[j]) for j in rows if values[j] is not None]
        if len(rows) < 10 or len(known) < np.ceil(0.9 * len(rows)):
            return 0.0
        x, y = map(np.array, zip(*known))
        if np.ptp(y) == 0:
            return 0.0
        slope = np.polyfit(x, y, 1)[0]
        return 0.0 if slope <= 0 else np.corrcoef(x, y)[0, 1] ** 2

    best = [max(fit(i, 1440, 0), fit(i, 720, 720), fit(i, 4320, 0), fit(i, 2160, 2160)) for i in range(len(values))]
    return [sum(best[j] for j in frame(i, 1440, 0)) / len(frame(i, 1440, 0)) >= 0.5 for i in range(len(values))]


def test_drift_against_brute_force(series, column):
    import random
    r = random.Random(5)
    values = [round(3 + 0.02 * (i % 90) + r.gauss(0, 0.3), 2) if r.random() > 0.04 else None for i in range(260)]
    values[100:140] = [900.0 + r.random() for _ in range(40)]  # a plateau next to small values
    values[150:200] = [4.0] * 50
    flags = ["site visit" if i in (60, 140) else None for i in range(260)]
    df = series(values, step=timedelta(hours=1), flag=flags, types={"flag": "string"})
    got = ["drift" in (f or "") for f in column(sw.drift_flag(df, sw.Layout("1 hour")), "flag")]
    assert got == brute_drift(values, {60, 140}, 60)
    assert any(got) and not all(got)


def test_drift_leaves_other_parameters(series, column):
    rising = [float(i) for i in range(60)]
    lay = sw.Layout("1 hour")
    assert any(column(sw.drift_flag(series(rising, step=timedelta(hours=1)), lay), "flag"))
    assert not any(column(sw.drift_flag(series(rising, step=timedelta(hours=1), parameter="DO"), lay), "flag"))
    falling = series(rising[::-1], step=timedelta(hours=1))
    assert not any(column(sw.drift_flag(falling, lay), "flag"))


def test_seasonal(series, column):
    df = sw.summary_statistics(series([1, 5, 5.1, 30]))
    table = df.sparkSession.createDataFrame([("winter_baseflow", "bellvue", "Turbidity", 2.0, 20.0, -0.5, 1.0, 0.1)],
                                            "season string, site string, parameter string, t_mean01 double, t_mean99 double, "
                                            "t_slope_behind_01 double, t_slope_behind_99 double, t_sd_0199 double")
    out = sw.seasonal_flag(df, table)
    assert column(out, "flag") == ["outside of seasonal range", None, "slope violation",
                                   "outside of seasonal range;slope violation"]
    assert not [c for c in out.columns if c.startswith("t_")]
    assert column(sw.seasonal_flag(df, table.where("false")), "flag") == [None] * 4


def test_depth_shift(series, column):
    df = series([1, 2, 3], sonde_moved=[True, False, None])
    assert column(sw.depth_shift(df), "depth_change") == ["sonde moved", None, None]
    shifts = df.sparkSession.createDataFrame([("bellvue", at(1), "sonde moved"), ("bellvue", at(2), "other")],
                                             "site string, dt_round timestamp, type string")
    assert column(sw.depth_shift(df, shifts), "depth_change") == [None, "sonde moved", None]
