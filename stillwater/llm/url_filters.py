"""Association-rule filtering of URLs, in DataFrame operations and Spark's FP-growth alone.

A url's host and path give tokens. FP-growth mines, from the urls of labelled pages, which token combinations go with
the label "bad"; of those rules the ones with enough support and confidence are kept that no shorter kept rule makes
needless. Matching goes through an inverted index: every rule is filed under its rarest token, a url looks its tokens
up there, and a rule that is found must be contained whole. Listed rules (host and path) go first; the longest one
that fits decides, and the mined rules decide about the rest.

Pages are labelled by the row of ``labels`` with the same id: bad if toxic or of low quality. The number of mined rules
is bounded by the support, whatever the input's size: a token set in at least a share ``s`` of urls of ``t`` tokens.

Defined results: a missing url, or one without ``://``, has an empty host and path and no tokens: it is allowed. Rows
with the same id or url are judged alike, one by one. Without labelled pages nothing is mined. Other columns are left out.
"""
from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BAD = "label=bad"

# host and path, verdict
LISTED = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))


def _after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))


def split_url(df: DataFrame) -> DataFrame:
    """Adds ``host`` and ``path`` to a frame with ``url``."""
    rest = F.coalesce(_after_scheme(F.col("url")), F.lit(""))
    return (df.withColumn("_rest", rest)
            .withColumn("host", F.translate(F.regexp_extract("_rest", r"^([^/?#]*)", 1), UPPER, LOWER))
            .withColumn("path", F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1)).drop("_rest"))


def url_tokens(host: Column, path: Column) -> Column:
    """Different tokens of a url: every domain it lies in, its labels, and the path's segments; numbers become one token."""
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.concat(F.lit("domain="), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    names = F.transform(labels, lambda x: F.concat(F.lit("name="), x))
    segments = F.transform(F.filter(F.split(path, r"/"), lambda x: x != ""),
                           lambda x: F.concat(F.lit("path="), F.regexp_replace(F.translate(x, UPPER, LOWER), r"\d+", "#")))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(domains, names, segments)))


def listed_rule(host: Column, path: Column, listed=LISTED) -> tuple[Column, Column]:
    """The longest listed rule that fits, and its verdict; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(listed, key=lambda r: len(r[0])):  # later ones are longer and go first
        rule_host, slash, rule_path = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rule_path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def mine_rules(transactions: DataFrame, min_support: float, min_confidence: float, longest: int) -> DataFrame:
    """``tokens`` arrays (with BAD among those of bad urls) to rules: tokens that make BAD likely.

    Support is the share of all transactions that hold the tokens and BAD; confidence its part of those that hold the tokens.
    """
    sets = FPGrowth(itemsCol="tokens", minSupport=min_support, minConfidence=min_confidence).fit(
        transactions.select("tokens")).freqItemsets
    sets = sets.where(F.size("items") <= longest + 1)
    with_bad = sets.where(F.array_contains("items", BAD) & (F.size("items") > 1)).select(
        F.array_sort(F.array_remove("items", BAD)).alias("tokens"), F.col("freq").alias("both"))
    alone = sets.where(~F.array_contains("items", BAD)).select(F.array_sort("items").alias("tokens"), "freq")
    rules = with_bad.join(alone, "tokens").select("tokens", "freq", (F.col("both") / F.col("freq")).alias("confidence"))
    rules = rules.where(F.col("confidence") >= min_confidence)
    # a rule is needless beside a shorter one whose tokens it holds: that one matches wherever it does
    index = rules.select(F.col("tokens").alias("general"), F.explode("tokens").alias("token"))
    needless = (rules.select("tokens", F.explode("tokens").alias("token")).join(index, "token")
                .where((F.size("general") < F.size("tokens")) & (F.size(F.array_except("general", "tokens")) == 0))
                .select("tokens").distinct())
    return rules.join(needless, "tokens", "left_anti")


def filed_rules(rules: DataFrame, transactions: DataFrame) -> DataFrame:
    """The inverted index: each rule under its rarest token among the transactions (ties: the smaller token)."""
    counts = transactions.select(F.explode("tokens").alias("token")).groupBy("token").count()
    return (rules.select("tokens", "confidence", F.explode("tokens").alias("token")).join(counts, "token")
            .groupBy("tokens", "confidence").agg(F.min(F.struct("count", "token"))["token"].alias("token")))


def judge(pages: DataFrame, labels: DataFrame, listed=LISTED, min_support: float = 0.005, min_confidence: float = 0.5,
          longest: int = 3) -> DataFrame:
    """``page_id, url`` to ``page_id, host, path, rule, verdict`` and the number and confidence of mined rules that match."""
    plain = split_url(pages.select("page_id", "url"))
    tokens = url_tokens(F.col("host"), F.col("path"))
    known = labels.groupBy("doc_id").agg(F.max((F.coalesce(F.col("toxic") == 1, F.lit(False))
                                               | F.coalesce(F.col("quality") == 0, F.lit(False)))).alias("bad"))
    transactions = (plain.join(known, F.col("page_id") == F.col("doc_id")).select(
        F.when(F.col("bad"), F.array_append(tokens, BAD)).otherwise(tokens).alias("tokens")))
    index = filed_rules(mine_rules(transactions, min_support, min_confidence, longest), transactions)
    found = (plain.withColumn("tokens", tokens).groupBy("url").agg(F.first("tokens").alias("all_tokens"))
             .select("url", "all_tokens", F.explode("all_tokens").alias("token"))
             .join(index, "token").where(F.size(F.array_except("tokens", "all_tokens")) == 0)
             .groupBy("url").agg(F.count("*").alias("mined_rules"), F.max("confidence").alias("confidence")))
    rule, verdict = listed_rule(F.col("host"), F.col("path"), listed)
    return plain.join(found, "url", "left").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("mined_rules") > 0, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("mined_rules", F.lit(0)).alias("mined_rules"), "confidence")
