import json
import os
from datetime import datetime, timedelta

import pytest
import stillwater as sw
from pyspark.sql import functions as F

from conftest import at

NOW = datetime(2024, 3, 9, 1, 2, 3)


def readings(spark, site="bellvue", n=40, start=0, parameter="Turbidity"):
    data = [(site, "1", "sonde", at(start) + timedelta(minutes=5 * i), parameter, float(i % 7), "u") for i in range(n)]
    return spark.createDataFrame(data, sw.schema.RAW_READING)


def test_pages_names_and_locations(spark, tmp_path):
    page = {"locationId": "7", "parameters": [
        {"parameterId": "1", "unitId": "1", "customParameter": False, "readings": [{"timestamp": 1704067200, "value": 7.1}, {"timestamp": 1704067260, "value": 7.2}]},
        {"parameterId": "2", "unitId": "1", "customParameter": True, "readings": [{"timestamp": 1704067200, "value": 1.0}]},
        {"parameterId": "3", "unitId": "9", "customParameter": True, "readings": []}]}
    (tmp_path / "page.json").write_text(json.dumps(page))
    (tmp_path / "names.json").write_text(json.dumps({"parameters": {"1": "Temperature"}, "units": {"1": "C"}}))
    (tmp_path / "loc.json").write_text("\n".join(json.dumps({"id": i, "name": n, "description": "d", "gps": {"latitude": g, "longitude": 1.0}})
                                               for i, n, g in (("7", "Bellvue Sonde", 1.0), ("7", "Bellvue Sonde", 2.0), ("8", "Elsewhere", 1.0))))
    flat = sw.flatten_pages(sw.read_pages(spark, str(tmp_path / "page.json")))
    assert flat.count() == 3 and {r["parameterId"] for r in flat.collect()} == {"1", "2"}
    named = sw.reading_names(flat, sw.read_names(spark, str(tmp_path / "names.json")))
    assert {(r["parameter"], r["units"], r["timestamp"]) for r in named.collect()} == {
        ("Temperature", "C", datetime(2024, 1, 1)), ("Temperature", "C", datetime(2024, 1, 1, 0, 1))}
    sites = spark.createDataFrame([("BELLVUE",), ("nowhere",)], "site string")
    matched = sw.match_locations(sites, sw.read_locations(spark, str(tmp_path / "loc.json")))
    assert [(r["site"], r["id"]) for r in matched.collect()] == [("bellvue", "7")]
    out = sw.located_readings(named.withColumnRenamed("locationId", "id"), matched)
    assert out.columns == sw.schema.RAW_READING.names and {r["site"] for r in out.collect()} == {"bellvue"}


def test_locations_by_their_pieces(spark):
    """Short sites, sites inside sites, names of 200 letters, repeated pieces: as by comparing every pair."""
    sites = ["a", "ab", "Abc", "abcd", "bcd", "xyz", "river bluffs", "zz", "é", "", None, "abab"]
    names = ["ABCD sonde", "a", "", None, "river bluffs at abc", "q" * 150 + "xyz" + "q" * 47, "zzz", "éa", "ababab", "RIVER  BLUFFS"]
    locations = spark.createDataFrame([(str(i), n, 1.0) for i, n in enumerate(names)], "id string, name string, gps double")
    got = sw.match_locations(spark.createDataFrame([(s,) for s in sites], "site string"), locations).select("site", "id").collect()
    want = [(s.lower(), str(i)) for s in sites if s for i, n in enumerate(names) if n and s.lower() in n.lower()]
    assert sorted(map(tuple, got)) == sorted(want)


def test_ordered_tables(spark, tmp_path):
    path, order = str(tmp_path / "t"), [F.col("v").desc_nulls_last(), F.asc("id")]
    df = spark.range(5000).withColumn("v", F.when(F.col("id") % 10 != 0, F.pmod(F.col("id") * 7919, F.lit(1000)))).repartition(7)
    sw.write_ordered(df, path, order, parts=6)
    want = [r.id for r in df.orderBy(*order).collect()]
    assert [r.id for r in sw.with_position(spark, path, order).orderBy("position").collect()] == want
    assert [r.position for r in sw.with_position(spark, path, order).orderBy("position").select("position").limit(3).collect()] == [0, 1, 2]
    few = sw.read_first(spark, path, 20, order)
    assert [r.id for r in few.collect()] == want[:20] and len(few.inputFiles()) < len(spark.read.parquet(path).inputFiles())
    assert sw.read_first(spark, path, 10 ** 6, order).count() == 5000
    assert sw.read_first(spark, path, 0, order).count() == 0


def test_network_files(spark, tmp_path):
    csv, yml = tmp_path / "order.v1.csv", tmp_path / "order.yml"
    csv.write_text('network_name,network\nclp,"Tamasag, salyer"\nmtn_campus,mtn_campus\n')
    yml.write_text("network:\n  clp:\n    Tamasag, salyer\n  mtn_campus:\n    mtn_campus\n")
    want = [("clp", ["bellvue", "salyer"]), ("mtncampus", ["mtncampus"])]
    for path in (csv, yml):
        got = sw.load_networks(spark, str(path)).orderBy("network_order").collect()
        assert [(r["network_name"], r["network"]) for r in got] == want
    with pytest.raises(FileNotFoundError):
        sw.load_networks(spark, str(tmp_path / "none.csv"))
    with pytest.raises(FileNotFoundError):
        sw.load_networks(spark, str(tmp_path / "none.yml"))
    with pytest.raises(ValueError):
        sw.load_networks(spark, str(tmp_path / "order.txt"))
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
    (tmp_path / "bad.yml").write_text("sites: 1\n")
    for bad in ("bad.csv", "bad.yml"):
        with pytest.raises(ValueError):
            sw.load_networks(spark, str(tmp_path / bad))


def test_config_files(spark, tmp_path):
    (tmp_path / "t.csv").write_text("season,site,parameter,t_mean01,t_mean99,t_slope_behind_01,t_slope_behind_99,t_sd_0199\n"
                                    "monsoon,Legacy,pH,6.5,9,-0.1,0.1,NA\n")
    row = sw.read_thresholds(spark, str(tmp_path / "t.csv")).first()
    assert (row["site"], row["t_mean99"], row["t_sd_0199"]) == ("salyer", 9.0, None)
    (tmp_path / "spec.yml").write_text("pH:\n  min: 0\n  max: 14\n")
    assert sw.read_sensor_spec(spark, str(tmp_path / "spec.yml")).first() == ("pH", 0.0, 14.0)
    (tmp_path / "notes.csv").write_text("site,start_dt,sonde_moved,do_pre_clean\nudall,2024-03-01,TRUE,1.5\n")
    note = sw.read_field_notes(spark, str(tmp_path / "notes.csv")).first()
    assert note["sonde_moved"] is True and note["do_pre_clean"] == 1.5


def test_raw_pulls(spark, tmp_path):
    path = str(tmp_path / "raw")
    for again in range(2):  # the same pull twice is one pull
        sw.write_raw(readings(spark), path, NOW)
    sw.write_raw(readings(spark, "salyer", 3), path, NOW + timedelta(hours=3))
    back = sw.read_raw(spark, path)
    assert back.count() == 43 and {r["site"] for r in back.select("site").distinct().collect()} == {"bellvue", "salyer"}


def test_snapshots(spark, tmp_path, series):
    path = str(tmp_path / "curated")
    for hours, value in ((0, 1.0), (5, 2.0), (3, 3.0)):
        sw.write_snapshot(series([value] * 3), path, "SondeFlags", NOW + timedelta(hours=hours))
    assert {r["mean"] for r in sw.read_latest(spark, path, "SondeFlags").collect()} == {2.0}
    assert {r["mean"] for r in sw.read_latest(spark, path, before=NOW + timedelta(hours=5)).collect()} == {3.0}
    with pytest.raises(FileNotFoundError):
        sw.read_latest(spark, path, "Other")
    sw.write_series_csv(series([1.0, None]), str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 2


def test_archive_append(spark, tmp_path):
    src, dest = str(tmp_path / "in"), str(tmp_path / "archive")
    readings(spark).coalesce(1).write.parquet(src)
    first = sw.archive_append(spark, src, dest)
    assert [r["complete"] for r in first.collect()] == [True] and spark.read.parquet(dest).count() == 40
    readings(spark, n=10).coalesce(1).write.mode("append").parquet(src)
    report = sw.archive_append(spark, src, dest).collect()
    assert all(r["complete"] for r in report) and len(report) == 2 and spark.read.parquet(dest).count() == 50
    report = sw.archive_append(spark, src, dest, clear=True)
    assert not list((tmp_path / "in").glob("*.parquet")) and spark.read.parquet(dest).count() == 50
    assert len(report.collect()) == 2 and all(r["complete"] for r in report.collect())  # also when the files are gone


def test_archive_append_goes_by_content(spark, tmp_path):
    """Another file of the same name, a file written anew, and files that changed while they were copied."""
    src, dest = tmp_path / "in", str(tmp_path / "archive")
    for folder, n in (("a", 3), ("b", 3), ("c x", 5)):
        readings(spark, folder, n=n).coalesce(1).write.parquet(str(src / f"pull={folder}"))
        part, = (src / f"pull={folder}").glob("*.parquet")
        part.rename(part.with_name("readings.parquet"))
        (part.with_name(f".{part.name}.crc")).unlink()
        if folder != "c x":
            report = sw.archive_append(spark, str(src), dest)
            assert all(r.complete for r in report.collect())
    assert {r.site: r["count"] for r in spark.read.parquet(dest).groupBy("site").count().collect()} == {"a": 3, "b": 3}
    readings(spark, "a", n=9).coalesce(1).write.parquet(str(tmp_path / "new"))
    anew, = (tmp_path / "new").glob("*.parquet")
    (src / "pull=a" / "readings.parquet").write_bytes(anew.read_bytes())
    report = sw.archive_append(spark, str(src), dest, clear=True)
    assert sorted((r.source_file, r.source_rows, r.archived_rows) for r in report.collect()) == [("readings.parquet", n, n) for n in (3, 5, 9)]
    assert not list(src.rglob("*.parquet"))
    assert {r.site: r["count"] for r in spark.read.parquet(dest).groupBy("site").count().collect()} == {"a": 12, "b": 3, "c x": 5}


def test_archive_append_dies_and_goes_on(spark, tmp_path, monkeypatch):
    from stillwater.sources import writers
    src, dest = str(tmp_path / "in"), str(tmp_path / "archive")
    readings(spark).repartition(2).write.parquet(src)
    original, calls = writers._manifest, []

    def die(*a):
        calls.append(a)
        if len(calls) == 2:  # the rows are written, the manifest is not
            raise OSError("lost")
        return original(*a)
    with monkeypatch.context() as m:
        m.setattr(writers, "_manifest", die)
        with pytest.raises(OSError):
            sw.archive_append(spark, src, dest, clear=True)
    assert len(list((tmp_path / "in").glob("*.parquet"))) == 2
    report = sw.archive_append(spark, src, dest, clear=True)
    assert all(r.complete for r in report.collect()) and spark.read.parquet(dest).count() == 40


def test_archive_append_keeps_a_file_that_changes_meanwhile(spark, tmp_path, monkeypatch):
    from stillwater.sources import writers
    src, dest = tmp_path / "in", str(tmp_path / "archive")
    readings(spark).coalesce(1).write.parquet(str(src))
    original = writers._remove_files

    def late(spark_, report):
        file, = src.glob("*.parquet")
        os.utime(file, (1, 1))
        original(spark_, report)
    monkeypatch.setattr(writers, "_remove_files", late)
    sw.archive_append(spark, str(src), dest, clear=True)
    assert len(list(src.glob("*.parquet"))) == 1


def test_archive_append_leaves_files_that_land_meanwhile(spark, tmp_path, monkeypatch):
    from stillwater.sources import writers
    src, dest = tmp_path / "in", str(tmp_path / "archive")
    readings(spark).coalesce(1).write.parquet(str(src))
    copy = writers.new_to_archive

    def slow(source, archive):
        readings(spark, "salyer", n=5).coalesce(1).write.mode("append").parquet(str(src))
        return copy(source, archive)
    monkeypatch.setattr(writers, "new_to_archive", slow)
    sw.archive_append(spark, str(src), dest, clear=True)
    assert spark.read.parquet(str(src)).count() == 5 and spark.read.parquet(dest).count() == 40


def test_stream_summary_equals_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    df = readings(spark, n=200).unionByName(readings(spark, n=30)).unionByName(readings(spark, "salyer", 200, parameter="DO"))
    df.repartition(3).write.parquet(src)
    stream = sw.stream_interval_summary(sw.read_raw_stream(spark, src, files_per_trigger=1), "15 minutes", "1 day")
    stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(
        str(tmp_path / "out")).awaitTermination()
    late = readings(spark, n=1, start=96 * 10).coalesce(1)  # moves the watermark past everything
    late.write.mode("append").parquet(src)
    stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(
        str(tmp_path / "out")).awaitTermination()
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    want = sw.interval_summary(df).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_stream_pipeline_builds_the_archive(spark, tmp_path):
    src, archive = str(tmp_path / "in"), str(tmp_path / "archive")
    for first, n in ((0, 120), (30, 120)):
        readings(spark, n=n, start=first).coalesce(1).write.mode("append").parquet(src)
        sw.stream_pipeline(sw.read_raw_stream(spark, src), archive, str(tmp_path / "c"), "1 day").trigger(
            availableNow=True).start().awaitTermination()
    latest = sw.read_latest(spark, archive, "curated")
    stamps = sorted(r["dt_round"] for r in latest.collect())
    assert stamps == [at(i) for i in range(71)] and latest.where("NOT historical").count() == 0


def run_stream(spark, src, archive, checkpoint):
    sw.stream_pipeline(sw.read_raw_stream(spark, src), archive, checkpoint, "1 day").trigger(availableNow=True).start().awaitTermination()
    return sorted(r["dt_round"] for r in sw.read_latest(spark, archive, "curated").collect())


def test_stream_goes_on_with_a_new_checkpoint(spark, tmp_path):
    archive = str(tmp_path / "archive")
    readings(spark, n=90).coalesce(1).write.parquet(str(tmp_path / "one"))
    readings(spark, n=30, start=30).coalesce(1).write.parquet(str(tmp_path / "two"))
    assert run_stream(spark, str(tmp_path / "one"), archive, str(tmp_path / "c1")) == [at(i) for i in range(31)]
    assert run_stream(spark, str(tmp_path / "two"), archive, str(tmp_path / "c2")) == [at(i) for i in range(41)]
    assert len(list((tmp_path / "archive").glob("curated*"))) == 2


def test_replayed_batch_writes_nothing(spark, tmp_path):
    process = sw.archive_batch(str(tmp_path), "1 day", clock=lambda batch: NOW)
    for batch in (0, 0, 1, 0):
        process(readings(spark, n=30, start=10 * batch), batch)
    stamps = sorted(p.name for p in tmp_path.glob("curated*"))
    assert len(stamps) == 2 and stamps[0].startswith("curated20240309-T010203Z") and stamps[1].startswith("curated20240309-T010204Z")
    assert sorted(r["dt_round"] for r in sw.read_latest(spark, str(tmp_path), "curated").collect()) == [at(i) for i in range(21)]


def test_unfinished_snapshot_is_not_read(spark, tmp_path, series):
    sw.write_snapshot(series([1.0]), str(tmp_path), "S", NOW)
    (tmp_path / "S20250101-T000000Z.parquet" / "_temporary").mkdir(parents=True)
    assert sw.read_latest(spark, str(tmp_path), "S").count() == 1


def test_late_and_open_windows_are_accounted_for(spark, tmp_path):
    src = str(tmp_path / "in")
    readings(spark, n=200, start=96).coalesce(1).write.parquet(src)
    stream = sw.stream_interval_summary(sw.read_raw_stream(spark, src, files_per_trigger=1), "15 minutes", "1 hour")

    def run():
        q = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
        q.awaitTermination()
        return q
    q = run()
    assert sw.late_rows(q) == 0
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "out")).unionByName(sw.open_windows(readings(spark, n=200, start=96), q).select(*stream.columns))
    want = sw.interval_summary(readings(spark, n=200, start=96)).select(*stream.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    readings(spark, "salyer", n=7).coalesce(1).write.mode("append").parquet(src)
    assert sw.late_rows(run()) == 7
