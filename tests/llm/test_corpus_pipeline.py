import corpus_pipeline
from stillwater.llm.common import stored
from stillwater.llm.queries import QUERIES

from .conftest import documents, prose

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_take_effect_in_turn(spark, tmp_path, odd_rows):
    passage = prose(60, 900, 5000)
    clean = [(100 + i, prose(120, 1000 + i, 5000)) for i in range(40)]
    near = clean[0][1].split()
    near[50] = "changed"
    toxic = [(300 + i, prose(60, 2000 + i, 5000) + " rotter scoundrel zlubber " * 3) for i in range(40)]
    rows = [*odd_rows, *clean, (200, " ".join(near)), (201, prose(50, 11, 5000) + " " + passage), (202, passage + " " + prose(50, 12, 5000)),
            (203, prose(50, 13, 5000) + " " + prose(30, 77, 5000)), *toxic]
    documents(spark, rows).select(*COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i >= 300)) for i, _ in [*clean, *toxic]], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, prose(30, 77, 5000))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, str(tmp_path)), name)
        seen[name] = docs.collect()
        if name != "packing":
            assert docs.columns == COLUMNS
    ids = {n: {r.doc_id for r in v} for n, v in seen.items()}
    assert ids["toxicity"] == {i for i, _ in rows if i is None or i < 300}
    assert ids["near_duplicates"] == ids["toxicity"] - {200, 8}
    left = {r.doc_id: r.text for r in seen["repeats"]}
    assert passage[5:-5] not in left[201] and passage[5:-5] not in left[202] and all(left[i] == t for i, t in clean[:40] if i != 100)
    assert ids["benchmark"] == ids["repeats"] - {203}
    assert {r.doc_id for r in seen["packing"]} == ids["benchmark"]
    fused = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "piece", "length", "ids_crc32").collect()
    assert len(fused) == len(seen["packing"])


def test_stages_keep_columns_named_like_their_own(spark, tmp_path):
    extra = ["tox_score", "tox_spans", "_had", "_key", "_text_key", "_spans", "_kept", "_place", "_dirty", "_row"]
    rows = [(i, prose(60, i, 5000) + (" rotter zlubber" * 5 if i > 5 else "")) for i in range(10)] + [(None, None), (3, "")]
    documents(spark, rows).selectExpr(*COLUMNS, *[f"'{c}' AS {c}" for c in extra]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i > 5)) for i in range(10)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, prose(60, 2, 5000))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == [*COLUMNS, *extra]
        assert all(r[c] == c for r in docs.collect() for c in extra)
    assert {0, 1, 4, 5} <= {r.doc_id for r in docs.collect()} and 2 not in {r.doc_id for r in docs.collect()}


def test_one_query_per_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeats", "benchmark", "packing"]
