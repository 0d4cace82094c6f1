"""How far the sources of a language differ from it and from each other in the words they use.

Counting stays in Arrow: texts are lower-cased and split by compute functions, words are dictionary-encoded, and hash
aggregations give, per batch, the occurrences of a word and the documents that hold it. A task merges these partial
tables and hands them on when they pass a bound in bytes; Spark adds them up. What is kept is cut into columnar shards
of a language's words: a shard holds the counts of its words in every source as one matrix and gives the sums of
absolute differences for every two sources and its candidates for each source's most overused words.

Probabilities are smoothed and scaled whole numbers, ``1 + floor(10^9 * (count + 5) / (N + 5 * V))``, so results do not
depend on the order of work.

Defined results: missing ``text``, ``lang`` and ``source`` count as ''; a text without words still makes its group occur;
repeated rows count as often as they occur; a language without frequent words has pairs of value 0 and no words; a source
that is alone in its language has no pairs; an empty table gives no rows; other columns are left out. A matrix holds a
word's counts in all sources of a language, so memory grows with the number of those (8 bytes each).
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.joins import join_per_group
from .common import slices, stored

SCALE_STEPS = 3  # of a factor of 1000 each
SMOOTH = 5
NOT_WORDS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"  # all ASCII characters but letters
PART = "lang string, source string, term string, n bigint, docs bigint"
_KEYS = ["lang", "source", "term"]


def _text(batch: pa.RecordBatch, name: str) -> pa.Array:
    return pc.fill_null(batch.column(name), "")


def _count(b: pa.RecordBatch) -> pa.Table:
    """Occurrences and documents of each term in each group; the row without term gives the group's documents."""
    lists = pc.split_pattern_regex(pc.ascii_lower(_text(b, "text")), pattern=NOT_WORDS)
    row, term = pc.list_parent_indices(lists), pc.list_flatten(lists)
    real = pc.not_equal(term, "")
    row, term = pc.cast(row.filter(real), pa.int64()), term.filter(real).dictionary_encode()
    lang, source = (_text(b, c).dictionary_encode() for c in ("lang", "source"))
    group = pc.add(pc.multiply(pc.cast(lang.indices, pa.int64()), len(source.dictionary)), pc.cast(source.indices, pa.int64()))
    by_row = pa.table({"row": row, "term": term.indices}).group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
    words = pa.table({"group": group.take(by_row["row"].combine_chunks()), "term": by_row["term"], "n": by_row["count_all"]}).group_by(
        ["group", "term"], use_threads=False).aggregate([("n", "sum"), ([], "count_all")])
    groups = pa.table({"group": group}).group_by(["group"], use_threads=False).aggregate([([], "count_all")])
    code = np.concatenate([words["group"].to_numpy(), groups["group"].to_numpy()])
    none = pa.nulls(groups.num_rows, pa.string())
    return pa.table({
        "lang": lang.dictionary.take(pa.array(code // len(source.dictionary))),
        "source": source.dictionary.take(pa.array(code % len(source.dictionary))),
        "term": pa.chunked_array([term.dictionary.take(words["term"].combine_chunks()), none]),
        "n": pa.chunked_array([words["n_sum"].combine_chunks().cast(pa.int64()), pa.nulls(groups.num_rows, pa.int64()).fill_null(0)]),
        "docs": pa.chunked_array([words["count_all"].combine_chunks().cast(pa.int64()), groups["count_all"].combine_chunks().cast(pa.int64())]),
    })


def _merge(tables: list[pa.Table]) -> pa.Table:
    t = pa.concat_tables(tables).group_by(_KEYS, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return t.select([*_KEYS, "n_sum", "docs_sum"]).rename_columns([*_KEYS, "n", "docs"])


def term_counts(docs: DataFrame, most_bytes: int = 32 << 20) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and documents that hold the term; without term: the group's documents."""
    def count(batches):
        kept, fresh = None, []
        for batch in batches:
            for b in slices(batch, "text", 4096, 4 << 20):
                fresh.append(_count(b))
                if sum(t.nbytes for t in fresh) > most_bytes // 2:
                    kept, fresh = _merge([*([kept] if kept else []), *fresh]), []
                    if kept.nbytes > most_bytes:
                        yield from kept.to_batches(1 << 16)
                        kept = None
        if kept or fresh:
            yield from _merge([*([kept] if kept else []), *fresh]).to_batches(1 << 16)

    columns = docs.select(*[F.col(c).cast("string").alias(c) for c in ("text", "lang", "source")])
    return columns.mapInArrow(count, PART).groupBy(*_KEYS).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def scaled(count: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """``1 + floor(10^9 * (count + 5) / (total + 5 * kept))`` by long division in steps of 1000: no number passes 64 bits."""
    rest, by = np.broadcast_arrays(count.astype(np.int64) + SMOOTH, total.astype(np.int64) + SMOOTH * kept)
    whole = np.zeros(rest.shape, np.int64)
    for _ in range(SCALE_STEPS):
        rest = rest * 1000
        whole = whole * 1000 + rest // by
        rest = rest % by
    return whole + 1


SHARD = "lang string, source string, part string, item string, value bigint"


def _shard(top: int):
    def compare(t: pa.Table) -> pa.Table:
        named = t.filter(pc.is_valid(t["term"]))
        groups = t.filter(pc.is_null(t["term"])).sort_by("source")
        source, lang, kept = groups["source"].combine_chunks(), groups["lang"][0], groups["kept"][0].as_py()
        term = named["term"].combine_chunks().dictionary_encode()
        column = pc.index_in(named["source"], source).combine_chunks().to_numpy(zero_copy_only=False)
        row = term.indices.to_numpy(zero_copy_only=False)
        counts = np.zeros((len(term.dictionary), len(source)), np.int64)
        counts[row, column] = named["n"].to_numpy()
        all_of = np.zeros(len(term.dictionary), np.int64)
        all_of[row] = named["of_lang"].to_numpy()
        if kept:
            p = scaled(counts, groups["size"].to_numpy()[None, :], kept)
            q = scaled(all_of, groups["lang_size"].to_numpy()[:1], kept)[:, None]
        else:
            p, q = counts, all_of[:, None]
        out = []
        for s in range(len(source) - 1):
            value = np.abs(p[:, s + 1:] - p[:, s:s + 1]).sum(0)
            out.append(pa.table({"source": pa.repeat(source[s], len(value)), "part": pa.repeat("pair", len(value)), "item": source[s + 1:],
                                 "value": pa.array(value)}))
        r, s = np.nonzero((counts > 0) & (p > q))
        over = pa.table({"at": pa.array(s), "item": term.dictionary.take(pa.array(r)), "value": pa.array((p - q)[r, s])}).sort_by(
            [("at", "ascending"), ("value", "descending"), ("item", "ascending")])
        at = over["at"].to_numpy()
        first = np.searchsorted(at, at)
        over = over.filter(pa.array(np.arange(len(at)) - first < top))
        out.append(pa.table({"source": source.take(over["at"].combine_chunks()), "part": pa.repeat("term", over.num_rows), "item": over["item"],
                             "value": over["value"]}))
        both = pa.concat_tables(out)
        return both.add_column(0, "lang", pa.repeat(lang, both.num_rows))
    return compare


def audit(docs: DataFrame, min_docs: int = 30, top: int = 50, cells: int = 1 << 16) -> DataFrame:
    """``lang, source, part, item, value, rank``: distances to the other sources (``pair``) and the most overused words (``term``).

    Words count in a language if at least ``min_docs`` of its documents hold them. A shard's matrix has some ``cells`` numbers.
    """
    counts = stored(term_counts(docs), "term-counts")
    groups = counts.where("term IS NULL").select("lang", "source")
    kept = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("of_lang")).where(
        F.col("docs") >= min_docs)
    rows = stored(counts.where("term IS NOT NULL").drop("docs").join(kept.drop("docs"), ["lang", "term"]), "kept-terms")
    size = rows.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    of_lang = rows.groupBy("lang").agg(F.count_distinct("term").alias("kept"), F.sum("n").alias("lang_size"))
    wide = groups.groupBy("lang").agg(F.count("*").alias("sources")).join(of_lang, "lang", "left").select(
        "lang", F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("lang_size", F.lit(0)).alias("lang_size"),
        (F.coalesce("kept", F.lit(0)) * F.col("sources") / cells + 1).cast("int").alias("shards"))
    heads = groups.join(size, ["lang", "source"], "left").join(wide, "lang").select(
        "lang", "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("of_lang"),
        F.coalesce("size", F.lit(0)).alias("size"), "kept", "lang_size", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    body = join_per_group(rows, wide.select("lang", "shards"), ("lang",), F.col("term")).select(
        "lang", "source", "term", "n", "of_lang", *[F.lit(0).cast("bigint").alias(c) for c in ("size", "kept", "lang_size")],
        F.pmod(F.xxhash64("term"), F.col("shards")).cast("int").alias("shard"))
    found = stored(heads.unionByName(body).groupBy("lang", "shard").applyInArrow(_shard(top), SHARD), "shards")
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.unionByName(pairs.select("lang", F.col("item").alias("source"), "part", F.col("source").alias("item"), "value"))
    best_first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = found.where("part = 'term'").withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(best_first)).unionByName(terms).select(
        "lang", "source", "part", "item", "value", "rank")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t,
                  coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
tok AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM tok GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM tok JOIN kept USING (lang, term) GROUP BY lang, source, term),
m AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN kept k ON g.lang = k.lang
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v)::HUGEINT AS p
      FROM m JOIN v USING (lang)),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v)::HUGEINT AS q
      FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term) JOIN v USING (lang)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
         GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, p - q AS value FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
