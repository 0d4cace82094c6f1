"""The committed archive: what is touched, what is not, replays, other writers, runs that die."""
import hashlib
import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
import stillwater as sw
from pyspark.sql import functions as F
from stillwater.plans import incremental
from stillwater.sources import archive

from conftest import at

NOW = datetime(2024, 6, 9, 12)
HOUR = timedelta(hours=1)


def raw(spark, site, first, last, parameter="Turbidity", seed=0, value=None):
    draw = random.Random(f"{site}{parameter}{seed}")
    data = [(site, "1", "sonde", at(i, HOUR), parameter, value if value is not None else draw.uniform(5, 9), "u") for i in range(first, last)]
    return spark.createDataFrame(data, sw.schema.RAW_READING)


def run(spark, root, readings, **how):
    return sw.incremental_run(spark, str(root), readings, "3 days", now=NOW, interval="1 hour", **how)


def digests(root):
    return {str(p.relative_to(root)): hashlib.sha256(p.read_bytes()).hexdigest() for p in Path(root, "data").rglob("*.parquet")}


def content(df):
    return sorted(map(str, df.select("site", "parameter", "dt_round", F.round("mean", 9), "auto_flag", "mal_flag", "historical", "n_obs").collect()))


@pytest.fixture()
def year(spark, tmp_path):
    """Two sites over three months, one of them with two parameters."""
    root = tmp_path / "archive"
    run(spark, root, raw(spark, "bellvue", 0, 24 * 75).unionByName(raw(spark, "salyer", 0, 24 * 75)).unionByName(raw(spark, "salyer", 0, 400, "DO")))
    return root


def test_only_touched_months_are_written(spark, year):
    before, live = digests(year), set(sw.read_archive(spark, str(year)).inputFiles())
    run(spark, year, raw(spark, "salyer", 24 * 75 - 10, 24 * 75 + 30, seed=1))
    after = digests(year)
    assert all(after[f] == h for f, h in before.items())  # nothing that was written is changed
    now_live = set(sw.read_archive(spark, str(year)).inputFiles())
    kept = live & now_live
    assert all("site=salyer/year=2024/month=5" in f for f in live - now_live) and all("month=5" in f for f in now_live - live)
    assert len(kept) >= 5 and any("site=salyer/year=2024/month=3" in f for f in kept)


def test_equals_the_whole_archive_rewritten(spark, year):
    """Every batch gives what ``run_pipeline`` and ``merge_archive`` give on the whole history: overlaps, late rows, new series."""
    old = sw.read_archive(spark, str(year))
    for n, batch in enumerate((
            raw(spark, "salyer", 24 * 75 - 20, 24 * 75 + 20, seed=2),
            raw(spark, "bellvue", 24 * 40, 24 * 40 + 5, seed=3).unionByName(raw(spark, "udall x:%", 10, 90)),
            raw(spark, "salyer", 390, 420, "DO", seed=4))):
        flagged = sw.curated(sw.run_pipeline(batch, history=old, period="3 days", interval="1 hour"))
        want = content(sw.merge_archive(flagged, old, "3 days"))
        commit = run(spark, year, batch, source="s", batch=n)
        got = sw.read_archive(spark, str(year))
        assert content(got) == want and commit.number == n + 2
        old = got


def test_replays_and_reads_of_older_commits(spark, year):
    first = archive.read_commit(spark, str(year))
    was = content(sw.read_archive(spark, str(year), commit=first))
    one = run(spark, year, raw(spark, "salyer", 24 * 75, 24 * 76), source="q", batch=7)
    files = digests(year)
    assert run(spark, year, raw(spark, "salyer", 24 * 75, 24 * 76), source="q", batch=7) == one
    assert run(spark, year, raw(spark, "salyer", 24 * 75, 24 * 76), source="q", batch=6) == one
    assert digests(year) == files and archive.commit_numbers(spark, str(year)) == [1, 2]
    assert content(sw.read_archive(spark, str(year), commit=first)) == was


def test_two_writers(spark, year, monkeypatch):
    """Other series: both commits stand. The same series: the later one flags again and loses nothing."""
    original, others = archive._publish, [raw(spark, "bellvue", 24 * 75, 24 * 75 + 8, seed=5), raw(spark, "salyer", 24 * 75, 24 * 75 + 6, seed=6)]
    began = []

    def late(spark_, root, commit):
        if others and commit.batches.get("slow") is not None:
            began.append(commit.number)
            run(spark_, year, others.pop(0), source="fast", batch=len(began))
        return original(spark_, root, commit)
    monkeypatch.setattr(archive, "_publish", late)
    commit = run(spark, year, raw(spark, "salyer", 24 * 75 + 6, 24 * 75 + 12, seed=7), source="slow", batch=0)
    assert began == [2, 3] and commit.number == 4 and commit.batches == {"fast": 2, "slow": 0}
    stamps = {s: [r.dt_round for r in sw.read_archive(spark, str(year)).where((F.col("site") == s) & (F.col("parameter") == "Turbidity")).select("dt_round").orderBy("dt_round").collect()]
              for s in ("salyer", "bellvue")}
    assert stamps["salyer"] == [at(i, HOUR) for i in range(24 * 75 + 12)] and stamps["bellvue"] == [at(i, HOUR) for i in range(24 * 75 + 8)]


def test_a_direct_write_with_an_old_base_is_refused(spark, year):
    base = archive.read_commit(spark, str(year))
    flagged = sw.read_archive(spark, str(year), (F.col("site") == "salyer") & (F.col("month") == 5))
    run(spark, year, raw(spark, "salyer", 24 * 75, 24 * 75 + 2))
    with pytest.raises(sw.Conflict):
        archive.write_back(spark, str(year), flagged, "3 days", base=base)


STEPS = [(incremental, "merged_rows"), (incremental, "curated"), (incremental, "tracker_update"), (archive, "_write_rows"), (archive, "merge_archive"),
         (archive, "_publish")]


def test_a_run_that_dies_is_run_again(spark, tmp_path, monkeypatch):
    """In whatever step: the archive stays as it was, and the next run does all of it once."""
    tracker = spark.createDataFrame([("bellvue", "Turbidity", "bellvue-Turbidity", 5, None, False, False), ("gone", "DO", "gone-DO", 55, None, False, False)],
                                    sw.schema.TRACKER)
    root, plain = str(tmp_path / "a"), str(tmp_path / "b")
    for path in (root, plain):
        run(spark, path, raw(spark, "bellvue", 0, 200), tracker=tracker, source="q", batch=0)
    more = raw(spark, "bellvue", 190, 230, seed=1)
    before = content(sw.read_archive(spark, root))
    for where, step in STEPS:
        with monkeypatch.context() as m:
            def die(*a, **k):
                raise OSError("lost")
            m.setattr(where, step, die)
            with pytest.raises(OSError, match="lost"):
                run(spark, root, more, source="q", batch=1)
        assert archive.commit_numbers(spark, root) == [1]
    assert content(sw.read_archive(spark, root)) == before
    for path in (root, plain):
        run(spark, path, more, source="q", batch=1)
    for name in ("tracker", "recent"):
        a, b = (sorted(map(str, archive.commit_table(spark, p, name).collect())) for p in (root, plain))
        assert a == b
    rows = {r.site: (r.failure_count, r.auto_disabled) for r in archive.commit_table(spark, root, "tracker").collect()}
    assert rows == {"bellvue": (0, False), "gone": (57, True)}
    assert content(sw.read_archive(spark, root)) == content(sw.read_archive(spark, plain))
    assert sw.next_session(spark, root, NOW).columns == ["site", "start_dt", "end_dt"]


def test_the_plan_reads_little(spark, year):
    base = archive.read_commit(spark, str(year))
    batch = raw(spark, "salyer", 24 * 75 - 10, 24 * 75 + 30, seed=1)
    path = str(year) + "-raw"
    batch.write.parquet(path)
    readings = sw.read_raw(spark, path)
    touched = spark.createDataFrame([("salyer", "Turbidity")], "site string, parameter string")
    rows = incremental.merged_rows(readings, str(year), "3 days", touched, base, "1 hour")
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    files = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert sum(path in line for line in files) <= 2
    history = [line for line in files if "/archive/data" in line]
    assert 1 <= len(history) <= 2 and all("site=salyer/year=2024/month=5" in line for line in history)
    assert all("month=3" not in line and "bellvue" not in line for line in history)


def test_unused_folders_go(spark, year):
    for i in range(3):
        run(spark, year, raw(spark, "salyer", 24 * 75 + i, 24 * 75 + i + 1), source="q", batch=i)
    want = content(sw.read_archive(spark, str(year)))
    assert not archive.clear_unused(spark, str(year), keep=1)  # all of it is young
    gone = archive.clear_unused(spark, str(year), keep=1, older_than_seconds=0)
    assert sum("/data/" in g for g in gone) == 3 and content(sw.read_archive(spark, str(year))) == want
    assert not archive.clear_unused(spark, str(year), keep=1, older_than_seconds=0)
    run(spark, year, raw(spark, "salyer", 24 * 75 + 3, 24 * 75 + 4), source="q", batch=3)
    assert sw.read_archive(spark, str(year)).count() == len(want) + 1


def test_rows_without_key_stay(spark, year):
    odd = sw.read_archive(spark, str(year)).limit(3).withColumns({"dt_round": F.lit(None).cast("timestamp"), "mean": F.lit(1.5)})
    nobody = sw.read_archive(spark, str(year)).limit(2).withColumns({"site": F.lit(None).cast("string"), "mean": F.lit(2.5)})
    base = archive.read_commit(spark, str(year))
    one = archive.write_back(spark, str(year), odd.unionByName(nobody), "3 days", base=base)
    archive.write_back(spark, str(year), nobody, "3 days", base=one)
    run(spark, year, raw(spark, "salyer", 24 * 75, 24 * 75 + 4))
    got = sw.read_archive(spark, str(year))
    assert got.where("dt_round IS NULL").count() == 3 and got.where("site IS NULL").count() == 4


def test_nothing_to_do(spark, tmp_path):
    assert run(spark, tmp_path / "none", raw(spark, "a", 0, 0)) is None
    with pytest.raises(FileNotFoundError):
        sw.read_archive(spark, str(tmp_path / "none"))


def test_stream_into_the_archive(spark, tmp_path):
    src, root = str(tmp_path / "in"), str(tmp_path / "archive")
    for first, n in ((0, 40), (30, 60)):
        raw(spark, "bellvue", first, n).coalesce(1).write.mode("append").parquet(src)
        sw.stream_to_archive(sw.read_raw_stream(spark, src), root, str(tmp_path / "c"), "1 day", interval="1 hour").trigger(
            availableNow=True).start().awaitTermination()
    assert [r.dt_round for r in sw.read_archive(spark, root).orderBy("dt_round").collect()] == [at(i, HOUR) for i in range(60)]
    assert archive.commit_numbers(spark, root) == [1, 2]
