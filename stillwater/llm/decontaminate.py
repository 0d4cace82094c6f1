"""Benchmark decontamination by spaced seeds, in DataFrame operations alone.

A seed is the hash of five of the words in a short stretch; a fixed mask says which places count and which are
ignored, so a replaced word at an ignored place does no harm. The two long masks below were searched by trial so that any
stretch of 12 words with at most two replaced ones keeps a seed whole, as do 8 or 9 words with one. Items of other lengths
have seeds of shorter masks too, by which nothing is missed at a similarity of 0.8: of 10 or 11 words with two
replaced ones, or 3 to 7 with one, three neighbours stay whole, or of five words the first and the last two; one or two words
are their own seed. Documents are cut by the masks that the benchmark's lengths ask for.

Seeds of the benchmark meet seeds of the documents in a join. A hit names an item and a diagonal: the document's word
that would stand beside the item's first one. Around it the item is laid beside the document and words are compared;
a document is contaminated if some stretch of ``span`` item words (or the whole item, if shorter) has at least
``similarity`` of its words equal at their places. Inserted or dropped words only start another diagonal.

Words are split at ASCII blanks and lower-cased. The join's benchmark side is broadcast in blocks of at most
``block_seeds`` rows, whose number follows from a count: a larger benchmark makes more blocks. The documents' own
texts meet only their hits, one row per id and text.

Defined results: missing and blank texts and items hold no seed; an item matches whole, or by ``similarity`` of its words, so
items of fewer than five words match word for word; items without ``item_id`` count in ``n_items`` but are not
named; rows with the same ``doc_id``, or without one, are judged by their own texts; an empty benchmark leaves all clean;
other columns are left out.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import new_name

MASKS = ((0, 1, 2, 3, 5), (0, 1, 4, 6, 7))
SHORT_MASKS = (((0, 1, 2), (3, 4, 5, 6, 7, 10, 11)), ((0, 1, 3, 4), (5,)), ((0, 1), (2,)), ((0,), (1,)))  # and for which lengths of items


def row_key(docs: DataFrame, key: str = "doc_id") -> Column:
    """Stands for a row's id and text: rows that share it hold the same text."""
    return F.unhex(F.md5(F.concat(F.coalesce(docs[key].cast("string"), F.lit("")), F.lit("|"), F.coalesce(docs["text"], F.lit("")))))


def word_array(text: Column) -> Column:
    """Words of a text; none for a missing or blank one."""
    plain = F.trim(F.translate(F.lower(F.coalesce(text, F.lit(""))), "\t\n\x0b\x0c\r", "     "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " +"))


def seeds(words: Column, masks: list[tuple[int, ...]], lengths: list[tuple[int, ...] | None]) -> Column:
    """Per mask the seeds of an array of word hashes by place; for a mask with ``lengths`` only of arrays so long."""
    def of(mask: tuple[int, ...], only: tuple[int, ...] | None) -> Column:
        stretch = mask[-1] + 1
        at = F.sequence(F.lit(0), F.size(words) - stretch)
        seed = F.transform(at, lambda i: F.xxhash64(F.lit(str(mask)), *[F.get(words, i + k) for k in mask]))
        fits = (F.size(words) >= stretch) if only is None else F.size(words).isin(*only)
        return F.when(fits, seed).otherwise(F.array().cast("array<bigint>"))
    return F.array(*[of(mask, only) for mask, only in zip(masks, lengths)])


def _seed_rows(df: DataFrame, key: str, masks: list[tuple[int, ...]], lengths: list[tuple[int, ...] | None]) -> DataFrame:
    hashed = df.select(key, F.transform(word_array(F.col("text")), lambda w: F.xxhash64(w)).alias("_words"))
    by_mask = hashed.select(key, F.explode(seeds(F.col("_words"), masks, lengths)).alias("_seeds"))
    return by_mask.select(key, F.posexplode("_seeds").alias("_at", "_seed"))


def _joined(left: DataFrame, bench: DataFrame, block_seeds: int) -> DataFrame:
    """Document seeds with benchmark seeds; the latter broadcast in blocks of a checked size."""
    blocks = max(1, -(-bench.count() // block_seeds))
    parts = [left.join(F.broadcast(bench.where(F.pmod(F.xxhash64("_seed"), F.lit(blocks)) == b)), "_seed") for b in range(blocks)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _best_stretch(doc: Column, item: Column, diagonal: Column, span: int) -> Column:
    """Largest share of equal words among the item's stretches of ``span`` words, laid along the diagonal."""
    equal = F.transform(item, lambda w, i: F.when(
        (i + diagonal >= 0) & F.get(doc, i + diagonal).eqNullSafe(w), 1).otherwise(0))
    width = F.least(F.lit(span), F.size(item))
    shares = F.transform(F.sequence(F.lit(1), F.size(item) - width + 1),
                         lambda i: F.aggregate(F.slice(equal, i, width), F.lit(0), lambda a, x: a + x) / width)
    return F.array_max(shares)


def decontaminate(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, span: int = 12,
                  block_seeds: int = 100_000) -> DataFrame:
    """``doc_id, contaminated, n_items, best_overlap, item_ids`` per row of documents."""
    return _judged(docs, benchmark, similarity, span, block_seeds).drop("_row")


def _judged(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, span: int = 12, block_seeds: int = 100_000) -> DataFrame:
    """``decontaminate`` with ``_row``, the row's key."""
    texts = docs.select("doc_id", "text", row_key(docs).alias("_row"))
    named = benchmark.select("item_id", "text", row_key(benchmark, "item_id").alias("_item"))
    items = named.select("_item", "item_id", word_array(F.col("text")).alias("item")).where(F.size("item") > 0).dropDuplicates(["_item"])
    asked = items.agg(*[F.coalesce(F.bool_or(F.size("item").isin(*n)), F.lit(False)) for _, n in SHORT_MASKS]).first()
    short = [m for m, yes in zip(SHORT_MASKS, asked) if yes]
    masks = [*MASKS, *(m for m, _ in short)]
    bench = _seed_rows(named, "_item", masks, [*[None] * len(MASKS), *(n for _, n in short)]).select(
        "_item", F.col("_at").alias("_item_at"), "_seed").distinct()
    hits = (_joined(_seed_rows(texts, "_row", masks, [None] * len(masks)), bench, block_seeds)
            .select("_row", "_item", (F.col("_at") - F.col("_item_at")).alias("diagonal")).distinct()
            .join(items, "_item")
            .groupBy("_row").agg(F.collect_list(F.struct("_item", "item_id", "item", "diagonal")).alias("hits")))
    laid = texts.join(hits, "_row", "left")

    def verified(words: Column) -> Column:
        shares = F.transform("hits", lambda h: F.struct(
            h["_item"].alias("item"), h["item_id"].alias("item_id"), _best_stretch(words, h["item"], h["diagonal"], span).alias("share")))
        return F.filter(shares, lambda x: x["share"] >= similarity)

    # as a lambda's argument the words are split once, not once per use
    found = F.when(F.col("hits").isNotNull(), F.element_at(F.transform(F.array(word_array(F.col("text"))), verified), 1))
    kind = benchmark.schema["item_id"].dataType.simpleString()
    out = laid.select("_row", "doc_id", F.coalesce(found, F.array().cast(f"array<struct<item:binary,item_id:{kind},share:double>>")).alias("found"))
    # an id is one item, whatever its texts; without one the text is
    same = F.transform("found", lambda x: F.coalesce(x["item_id"].cast("string"), F.concat(F.lit("text "), F.hex(x["item"]))))
    return out.select(
        "_row", "doc_id", (F.size("found") > 0).alias("contaminated"),
        F.size(F.array_distinct(same)).alias("n_items"),
        F.coalesce(F.array_max("found.share"), F.lit(0.0)).alias("best_overlap"),
        F.array_sort(F.array_compact(F.array_distinct("found.item_id"))).alias("item_ids"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """All columns of the documents that hold no passage of the benchmark, judged row by row: another text of the same id stays."""
    dirty = _judged(docs, benchmark, **how).where("contaminated")
    name = new_name(docs, "_dirty")
    return docs.join(dirty.select(F.col("_row").alias(name)).distinct(), row_key(docs) == F.col(name), "left_anti")
