from datetime import datetime

import stillwater as sw
from pyspark.sql import functions as F

from conftest import at

OTHER = "Other (please specify)"


def survey(spark, rows):
    names = ("site", "site_other", "start_dt", "visit_type", "visit_type_other", "which_sensor_malfunction",
             "other_which_sensor_malfunction", "sensor_change", "sn_removed", "sn_deployed", "photos_downloaded",
             "photos_downloaded_other", "malfunction_end_dt", "visit_comments")
    schema = ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def test_times_in_every_style(spark):
    given = {
        "2024-05-06": datetime(2024, 5, 6), "2024-05-06 07:08:09": datetime(2024, 5, 6, 7, 8, 9),
        "2024-05-06T07:08:09Z": datetime(2024, 5, 6, 7, 8, 9), "20240506 07:08:09": datetime(2024, 5, 6, 7, 8, 9),
        "05/06/24 07:08": datetime(2024, 5, 6, 7, 8), "5/6/2024 7:08": datetime(2024, 5, 6, 7, 8),
        "050624 07:08": datetime(2024, 5, 6, 7, 8), "05062024 07:08": datetime(2024, 5, 6, 7, 8),
        "May 6, 24 07:08": datetime(2024, 5, 6, 7, 8), "May 6, 2024 07:08": datetime(2024, 5, 6, 7, 8),
        "soon": None, "": None,
    }
    df = spark.createDataFrame([(k,) for k in given], "t string")
    assert {r["t"]: r["p"] for r in df.select("t", sw.parse_any(F.col("t")).alias("p")).collect()} == given


def test_clean_notes(spark):
    rows = sw.clean_notes(survey(spark, [
        {"site": OTHER, "site_other": "River Bluffs", "start_dt": "2024-03-01 10:07:30", "visit_type": "???",
         "photos_downloaded": OTHER, "photos_downloaded_other": "later", "sn_removed": "12"},
        {"site": "udall", "start_dt": "2024-03-02 10:00", "visit_type": OTHER, "visit_type_other": "Sensor install",
         "which_sensor_malfunction": f"RDO, {OTHER}", "other_which_sensor_malfunction": "ORP", "photos_downloaded": "yes"},
    ])).orderBy("start_dt").collect()
    a, b = rows
    assert (a["site"], a["visit_type"], a["photos_downloaded"], a["sensor_pulled"]) == (
        "riverbluffs", "Sensor Calibration or Check", "later", "12")
    assert a["dt_round"] == datetime(2024, 3, 1, 10, 15)
    assert (b["visit_type"], b["which_sensor_malfunction"], b["photos_downloaded"]) == ("Sensor install", "RDO, ORP", "yes")
    assert "site_other" not in a.asDict()


def test_sensor_notes(spark):
    base = {"site": "udall", "start_dt": "2024-03-01 10:00"}
    notes = sw.clean_notes(survey(spark, [
        {**base, "visit_type": "Sensor Swap", "sensor_change": "Pulled", "sn_removed": "1", "visit_comments": "a"},
        {**base, "visit_type": "sensor check", "sensor_change": "Swapped", "sn_removed": "1", "visit_comments": "b"},
        {**base, "visit_type": "Sensor Swap", "sensor_change": "Deployed", "sn_deployed": "9", "visit_comments": "c"},
        {**base, "visit_type": "Sensor Swap", "visit_comments": "d"},
        {**base, "visit_type": "Sensor malfunction", "visit_comments": "e"},
        {**base, "visit_type": "Grab", "visit_comments": "f"}, {**base, "visit_comments": "g"}]))
    got = {r["visit_comments"]: (r["sonde_employed"], r["sensor_swapped_notes"]) for r in sw.sensor_notes(notes).collect()}
    assert got == {"a": (1, "SN Removed: 1"), "b": (None, "SN Removed: 1 SN Deployed: NA"), "c": (0, "9"), "d": (None, None)}


def test_malfunction_notes(spark):
    base = {"site": "river bluffs", "start_dt": "2024-03-01 10:00", "visit_type": "Sensor malfunction"}
    notes = sw.clean_notes(survey(spark, [
        {**base, "which_sensor_malfunction": "Chlorophyll a, RDO, Modem", "malfunction_end_dt": "2024-03-05"},
        {**base}, {**base, "which_sensor_malfunction": "Conductivity"}, {**base, "visit_type": "Sensor Swap"}]))
    rows = sw.malfunction_notes(notes).collect()
    assert sorted(str(r["parameter"]) for r in rows) == ["Chl-a Fluorescence", "DO", "None", "Specific Conductivity"]
    assert {r["site"] for r in rows} == {"riverbluffs"} and rows[0]["end_dt"] == datetime(2024, 3, 5)


def test_cleaning_notes(spark):
    df = spark.createDataFrame([(1,)], "x int").selectExpr(
        "'a' AS site", "current_timestamp() AS start_dt", "current_timestamp() AS dt_round", "current_date() AS date",
        "true AS sensors_cleaned", "1.0 AS do_pre_clean", "2.0 AS ph_post_clean", "3 AS other")
    assert sw.cleaning_notes(df).columns == ["start_dt", "dt_round", "date", "site", "sensors_cleaned", "ph_post_clean", "do_pre_clean"]


def status_notes(spark, rows):
    return spark.createDataFrame([(s, at(i), e, m, c, at(i)) for s, i, e, m, c in rows],
                                 "site string, dt_round timestamp, sonde_employed int, sonde_moved boolean, "
                                 "visit_comments string, last_site_visit timestamp")


def test_status_is_carried_forward(spark, series, column):
    df = series([1.0] * 30, site="riverbluffs").where("minute(dt_round) <> 45 OR hour(dt_round) <> 2")  # row 11 has no reading
    notes = status_notes(spark, [("River Bluffs", 5, 0, True, "in"), ("river bluffs", 11, 1, None, "out"),
                                 ("riverbend", 2, 1, True, "elsewhere"), ("river bluffs", 20, None, None, "look")])
    for slots in (4, 4096):
        out = sw.attach_field_notes(df, notes, sw.Layout(slots=slots))
        assert column(out, "sonde_employed") == [1] * 5 + [0] * 6 + [1] * 18
        assert column(out, "last_site_visit") == [None] * 5 + [at(5)] * 6 + [at(11)] * 8 + [at(20)] * 10
        assert [i for i, m in enumerate(column(out, "sonde_moved")) if m] == [5]
        assert [c for c in column(out, "visit_comments") if c] == ["in", "look"]


def test_two_notes_at_one_stamp_keep_one_row(spark, series, column):
    notes = status_notes(spark, [("bellvue", 2, 1, False, "a"), ("bellvue", 2, None, True, "b")])
    out = sw.attach_field_notes(series([1.0] * 4), notes)
    assert out.count() == 4 and column(out, "sonde_moved")[2] is True and column(out, "sonde_employed") == [1, 1, 1, 1]


def test_long_silence_keeps_the_state(spark, series, column):
    notes = status_notes(spark, [("bellvue", -30000, 0, None, "long ago")])
    assert column(sw.attach_field_notes(series([1.0] * 3), notes, sw.Layout(slots=16)), "sonde_employed") == [0, 0, 0]
