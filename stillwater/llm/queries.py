"""One query per operator, over the whole of its tables."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, decontaminate, divergence, lm_score, near_duplicates, nearest, packing, repeats, simhash, token_store, toxicity, url_filters, warc
from .common import fold, table, work_dir
from .tokens import default_vocabulary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_best_fit_packing(spark, d):
    return packing.pack_documents(table(spark, d, "documents"), default_vocabulary())


@query
def op2_toxicity_crf(spark, d):
    scores = toxicity.score_documents(spark, table(spark, d, "documents"), table(spark, d, "labels"))
    return scores.select("doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted", "n_spans")


@query
def op3_min_max_hashing(spark, d):
    return near_duplicates.components(table(spark, d, "documents"), shingle=2)


@query
def op4_url_rules(spark, d):
    return url_filters.judge(table(spark, d, "pages"), table(spark, d, "labels"))


@query
def op5_multi_index_hashing(spark, d):
    return nearest.search(spark, table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op6_suffix_sort(spark, d):
    told = repeats.removal_report(table(spark, d, "documents"), 400, words=51)
    return told.withColumn("has_repeat", F.col("n_removed") > 0).withColumn("has_passage", F.col("n_in_passages") > 0)


@query
def op7_spaced_seeds(spark, d):
    return decontaminate.decontaminate(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query
def op8_warc(spark, d):
    folder = work_dir(spark, "warc")
    return warc.read_warc(spark, folder, warc.write_warc(table(spark, d, "pages"), folder))


@query
def op9_token_ids_orc(spark, d):
    path = work_dir(spark, "token-ids")
    token_store.write_token_ids(table(spark, d, "documents"), path, default_vocabulary())
    return token_store.summary(spark, path)


@query
def op10_context_mixing(spark, d):
    return lm_score.score_documents(spark, table(spark, d, "documents"))


@query
def op11_source_divergence(spark, d):
    return divergence.audit(table(spark, d, "documents"))


ORACLE["op11_source_divergence"] = divergence.SQL


@query
def op12_debruijn_collocations(spark, d):
    return collocations.collocations(table(spark, d, "documents"))


ORACLE["op12_debruijn_collocations"] = collocations.SQL


@query
def op13_golay_simhash(spark, d):
    return simhash.components(table(spark, d, "documents"))
