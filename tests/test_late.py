"""A stream's summary with its late rows equals the batch summary, in any order of arrival."""
import random
from datetime import timedelta

import pytest
import stillwater as sw
from pyspark.sql import functions as F
from stillwater.streaming import late

from conftest import at


def readings(spark, rows):
    return spark.createDataFrame([(s, "1", "sonde", at(0) + timedelta(minutes=m), p, v, "u") for s, p, m, v in rows], sw.schema.RAW_READING)


def arrivals(seed, n=900, batches=6):
    """Readings of three days, most in order, some up to two days late, some sent twice."""
    draw = random.Random(seed)
    out = [[] for _ in range(batches)]
    for i in range(n):
        minute = draw.randrange(3 * 1440)
        b = min(batches - 1, max(0, minute * batches // (3 * 1440) + (draw.choice([1, 2, 4]) if draw.random() < 0.2 else 0)))
        row = (draw.choice(["bellvue", "salyer"]), draw.choice(["DO", "pH"]), minute, draw.choice([None, float("nan"), draw.random(), 1.0]))
        out[b].append(row)
        if draw.random() < 0.1:
            out[min(batches - 1, b + draw.randint(0, 3))].append(row)
    return out


def text(df):
    return sorted(map(str, df.select("site", "parameter", "units", "dt_round", F.round("mean", 9).alias("mean"), F.round("spread", 9).alias("spread"), "n_obs").collect()))


@pytest.mark.parametrize("lateness", ["1 hour", "1 day"])
def test_closed_and_late_equal_the_batch(spark, tmp_path, lateness):
    root, sent, handed = str(tmp_path / "s"), arrivals(3), []
    process = sw.summary_batch(root, "15 minutes", lateness, on_late=lambda df, n: handed.extend((n, r.timestamp) for r in df.collect()))
    for n, rows in enumerate(sent):
        process(readings(spark, rows), n)
        if n == 2:
            process(readings(spark, rows), n)  # replayed
    end = ("bellvue", "pH", 30 * 1440, 1.0)  # moves the watermark past everything
    process(readings(spark, [end]), len(sent))
    every = readings(spark, [r for rows in sent for r in rows])
    assert text(sw.closed_summary(spark, root)) == text(sw.interval_summary(every))
    assert text(sw.open_summary(spark, root)) == text(sw.interval_summary(readings(spark, [end])))
    kept = sw.late_readings(spark, root)
    assert len(handed) > 20 and {(r.batch, r.timestamp) for r in kept.collect()} == set(handed)


def test_windows_close_as_the_watermark_passes(spark, tmp_path):
    root = str(tmp_path)
    process = sw.summary_batch(root, "15 minutes", "1 hour")
    process(readings(spark, [("a", "DO", m, 1.0) for m in range(0, 120, 5)]), 0)
    closed = sw.closed_summary(spark, root)
    assert closed.agg(F.max("dt_round")).first()[0] == at(3) and closed.count() == 4  # 01:55 less an hour, and half a step
    assert sw.open_summary(spark, root).count() == 5
    process(readings(spark, [("a", "DO", 2, 5.0)]), 1)
    first = sw.closed_summary(spark, root).where(F.col("dt_round") == at(0)).first()
    assert (first["n_obs"], first["spread"]) == (3, 4.0) and late.read_mark(spark, root)["late"] == 1
    process(readings(spark, []), 2)
    assert sw.closed_summary(spark, root).count() == 4


def test_a_batch_that_dies_is_replayed(spark, tmp_path, monkeypatch):
    sent = arrivals(5, 300, 3)
    process = sw.summary_batch(str(tmp_path), "15 minutes", "1 hour")
    process(readings(spark, sent[0]), 0)
    for step in ("interval_summary", "_put"):
        with monkeypatch.context() as m:
            def die(*a):
                raise OSError("lost")
            m.setattr(late, step, die)
            with pytest.raises(OSError):
                process(readings(spark, sent[1]), 1)
    for n in (1, 2):
        process(readings(spark, sent[n]), n)
    process(readings(spark, [("x", "DO", 30 * 1440, 1.0)]), 3)
    assert text(sw.closed_summary(spark, str(tmp_path))) == text(sw.interval_summary(readings(spark, [r for rows in sent for r in rows])))
    assert sw.forget_rows(spark, str(tmp_path), before=2 ** 40)
    process(readings(spark, [("x", "DO", 30 * 1440 + 1, 2.0)]), 4)
    assert sw.closed_summary(spark, str(tmp_path)).count() > 0


def test_stream_of_files(spark, tmp_path):
    src, root, sent = str(tmp_path / "in"), str(tmp_path / "s"), arrivals(9, 400, 3)
    for rows in [*sent, [("bellvue", "pH", 30 * 1440, 1.0)]]:
        readings(spark, rows).coalesce(1).write.mode("append").parquet(src)
        sw.stream_summary(sw.read_raw_stream(spark, src), root, str(tmp_path / "c"), lateness="2 hours").trigger(availableNow=True).start().awaitTermination()
    assert text(sw.closed_summary(spark, root)) == text(sw.interval_summary(readings(spark, [r for rows in sent for r in rows])))
    assert sw.late_readings(spark, root).count() > 0
