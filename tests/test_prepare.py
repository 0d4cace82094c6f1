from datetime import datetime, timedelta

import pytest
import stillwater as sw
from pyspark.sql import functions as F
from stillwater.functions.timegrid import seconds

RAW = "site string, id string, name string, timestamp timestamp, parameter string, value double, units string"


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_periods():
    assert seconds("15 minutes") == 900 and seconds("1 hour") == 3600 and seconds("7 days") == 604800
    assert seconds("3 weeks") == 3 * 604800 and seconds(60) == 60
    with pytest.raises(ValueError):
        seconds("soon")


def test_round_half_up(spark):
    times = [datetime(2024, 1, 1, 0, 7, 29), datetime(2024, 1, 1, 0, 7, 30), datetime(2024, 1, 1, 23, 55)]
    got = spark.createDataFrame([(t,) for t in times], "t timestamp").select(sw.round_time(F.col("t"), "15 minutes")).collect()
    assert [r[0] for r in got] == [datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 15), datetime(2024, 1, 2)]


def test_interval_summary(spark):
    t = datetime(2024, 1, 1, 1, 1)
    rows = [
        ("Bellvue", "1", "sonde", t, "DO", 8.0, "mg"), ("Bellvue", "2", "sonde", t, "DO", 8.0, "mg"),  # sent twice
        ("Bellvue", "1", None, t + timedelta(minutes=2), "DO", 10.0, "mg"),
        ("Bellvue", "1", "sonde", t + timedelta(minutes=3), "DO", None, "mg"),
        ("Bellvue", "1", "My VuLink", t, "DO", 99.0, "mg"), ("Bellvue", "1", "VIRRIDY x", t, "DO", 99.0, "mg"),
        ("Bellvue", "1", "sonde", t, "fdom fluorescence", 99.0, "mg"),
        ("Bellvue", "1", "sonde", t, "pH", None, "u"),
    ]
    got = {r["parameter"]: r for r in sw.interval_summary(raw(spark, rows)).collect()}
    assert set(got) == {"DO", "pH"}
    assert (got["DO"]["site"], got["DO"]["mean"], got["DO"]["spread"], got["DO"]["n_obs"]) == ("bellvue", 9.0, 2.0, 3)
    assert got["pH"]["mean"] is None and got["pH"]["spread"] is None and got["pH"]["n_obs"] == 1


def test_pad_is_regular_and_keeps_rows(spark):
    t = datetime(2024, 1, 1)
    rows = [("a", "1", "s", t + timedelta(minutes=m), "DO", float(m), "mg") for m in (0, 15, 75, 600)]
    rows += [("b", "1", "s", t, "pH", 7.0, "u")]
    df = sw.prepare_series(raw(spark, rows))
    assert df.where("site = 'b'").count() == 1
    a = df.where("site = 'a'").orderBy("dt_round").collect()
    assert [r["dt_round"] for r in a] == [t + timedelta(minutes=15 * i) for i in range(41)]
    assert [i for i, r in enumerate(a) if r["mean"] is not None] == [0, 1, 5, 40]
    assert all(r["parameter"] == "DO" for r in a) and "_marker" not in df.columns
    assert sw.spacing_report(df).where("irregular").count() == 0


def test_site_names(spark):
    names = ["Tamasag", "LEGACY weir", "river bluffs", "Legacy Lincoln", "elsewhere", None]
    got = sw.standardize_site_names(spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, site string"))
    assert [r["site"] for r in got.orderBy("i").collect()] == [
        "bellvue", "salyer weir", "riverbluffs", "salyer lincoln", "elsewhere", None]


def test_turbidity_cap_keeps_raw(series, column):
    df = sw.standardize_turbidity(series([5, 1000, 2500, None]))
    assert column(df, "mean") == [5.0, 1000.0, 1000.0, None] and column(df, "raw") == [5.0, 1000.0, 2500.0, None]
    assert column(sw.standardize_turbidity(series([2500], parameter="DO")), "mean") == [2500.0]


def test_mask_omitted(series, column):
    df = series([1, 2, 3], approval_status=["OMIT", "OK", None])
    assert column(sw.mask_omitted(df), "mean") == [None, 2.0, None]


def test_statistics(series, column):
    df = sw.summary_statistics(series([1, 2, 4, 8, 16, 32, 64, None, 5]))
    assert column(df, "front1")[:2] == [2.0, 4.0] and column(df, "back1")[:2] == [None, 1.0]
    assert column(df, "rollmed") == [None] * 6 + [8.0, None, None]
    assert column(df, "rollavg")[6] == pytest.approx(127 / 7)
    assert column(df, "slope_ahead")[0] == pytest.approx(1 / 15) and column(df, "slope_behind")[1] == pytest.approx(1 / 15)
    assert column(df, "season")[0] == "winter_baseflow" and column(df, "y_m")[0] == "2024 - 3"


def test_statistics_keep_known_values_and_take_seasons(series, column):
    df = series([1, 2, 3], front1=[9.0, None, None], types={"front1": "double"})
    out = sw.summary_statistics(df, seasons={"dry": (3,), "wet": (4,)})
    assert column(out, "front1") == [9.0, 3.0, None] and set(column(out, "season")) == {"dry"}


@pytest.mark.parametrize("units", [("C", "F"), ("F", "C")])
def test_two_units_in_a_series_are_an_error(spark, units):
    data = [("a", "1", "sonde", datetime(2024, 3, 1) + timedelta(minutes=15 * i), "DO", float(i), units[i % 2]) for i in range(4)]
    readings = raw(spark, data)
    assert sw.interval_summary(readings).count() == 4
    for run in (sw.prepare_series, sw.run_pipeline):
        with pytest.raises(Exception, match="two units in series a DO C F"):
            run(readings).collect()
    assert sw.prepare_series(readings.where(f"units = '{units[0]}'")).count() == 3
