"""Toxic spans and document scores by a linear-chain conditional random field.

Labels are given per document; token labels are derived from them. Over the labelled training documents, words, word
beginnings and endings are counted by documents; a token of a toxic document is labelled toxic if one of its features
is far commoner in toxic than in other documents. On the tokens so labelled a two-state chain is trained by gradient
ascent on the conditional likelihood (forward-backward for the expected counts). A token's marginal probability of the
toxic state comes from the same recursions over the whole text; a document's score is a logistic function, fitted on
the training documents, of the expected number of toxic tokens and of the largest marginal.

The model is trained on a bounded sample: at most ``sample`` labelled documents of each class, those with the smallest
hash of their id, and at most ``sample_bytes`` of text, of which each class can have half. A text that does not fit is
passed over, those behind it are not; a class that has only larger texts gives the start of its smallest one. Of rows
with the same id one text is used. The model has a fixed number of weights and is trained in one task, so that the driver
holds nothing but it. Every text is scored whole, in one pass without a shuffle.

The recursions run as ratios of the two states' weights, a step of which is a fraction ``(a x + b) / (c x + d)``. Such
steps compose like 2x2 matrices, so a batch of texts is one long chain that is cut into equal lanes: first every
lane's product, then the lanes' starts one after the other, then all lanes together.

Defined results: a missing, empty or blank text has no tokens and gets the score of a document without toxic ones;
without labelled documents of both classes every score is 0; rows with the same id are scored one by one; a labelled id
with several label rows counts as toxic if one says so; other columns are kept by ``tag`` (its own start with
``tox_``).
"""
from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, fold, release_memory, slices, worker_cache, words

BUCKETS = 1 << 18


class Model(NamedTuple):
    weights: np.ndarray  # per feature bucket: evidence for the toxic state
    chain: np.ndarray  # log potentials [from][to], state 0 first
    calibration: np.ndarray  # constant, log of the expected toxic tokens, largest logit


def features(word: bytes) -> list[bytes]:
    """The word itself, its first four and five letters and its last three; marks at its ends do not count."""
    core = word.strip(b".,;:!?\"'()[]*#&%$|") or word
    return [b"w" + core, b"4" + core[:4], b"5" + core[:5], b"e" + core[-3:]]


def buckets(word: bytes) -> list[int]:
    return [xxhash.xxh3_64_intdigest(f) % BUCKETS for f in features(word)]


def _lanes(n: int) -> tuple[int, int]:
    steps = max(1, int(n ** 0.5))
    return -(-n // steps), steps


def ratio_scan(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """x[t] = (a x[t-1] + b) / (c x[t-1] + d) for all t, from x[-1] = 1; coefficients are not negative."""
    n = len(a)
    lanes, steps = _lanes(n)
    pad = lanes * steps - n
    a, b, c, d = (np.concatenate([v, np.full(pad, f)]).reshape(lanes, steps).T.copy()
                  for v, f in ((a, 1.0), (b, 0.0), (c, 0.0), (d, 1.0)))
    pa_, pb, pc, pd = np.ones(lanes), np.zeros(lanes), np.zeros(lanes), np.ones(lanes)
    for t in range(steps):
        pa_, pb, pc, pd = (a[t] * pa_ + b[t] * pc, a[t] * pb + b[t] * pd, c[t] * pa_ + d[t] * pc, c[t] * pb + d[t] * pd)
        top = pa_ + pb + pc + pd
        pa_, pb, pc, pd = pa_ / top, pb / top, pc / top, pd / top
    x, start = np.empty(lanes), 1.0
    for i, (p, q, r, s) in enumerate(zip(pa_.tolist(), pb.tolist(), pc.tolist(), pd.tolist())):
        x[i] = start
        start = (p * start + q) / (r * start + s)
    out = np.empty((steps, lanes))
    for t in range(steps):
        x = (a[t] * x + b[t]) / (c[t] * x + d[t])
        out[t] = x
    return out.T.reshape(-1)[:n]


def ratios(evidence: np.ndarray, first: np.ndarray, chain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward ratios (toxic over other) of many texts laid end to end; ``first`` marks their first tokens."""
    e, k = np.exp(np.clip(evidence, -30, 30)), np.exp(chain)
    forward = ratio_scan(*(np.where(first, f, v) for v, f in (
        (e * k[1, 1], 0.0), (e * k[0, 1], e), (np.full_like(e, k[1, 0]), 0.0), (np.full_like(e, k[0, 0]), 1.0))))
    # backward: y[t] = (k10 + k11 e[t+1] y[t+1]) / (k00 + k01 e[t+1] y[t+1]), 1 at a text's last token
    last, after = np.append(first[1:], True), np.append(e[1:], 1.0)
    backward = ratio_scan(*(np.where(last, f, v)[::-1] for v, f in (
        (k[1, 1] * after, 0.0), (np.full_like(e, k[1, 0]), 1.0), (k[0, 1] * after, 0.0), (np.full_like(e, k[0, 0]), 1.0))))[::-1]
    return forward, backward


def marginals(evidence: np.ndarray, first: np.ndarray, chain: np.ndarray) -> np.ndarray:
    if not len(evidence):
        return evidence
    forward, backward = ratios(evidence, first, chain)
    return 1 - 1 / (1 + forward * backward)


def token_labels(texts: list[list[bytes]], toxic: np.ndarray, least_docs: int = 3, times: float = 20.0) -> list[np.ndarray]:
    """1 for the tokens of toxic documents that have a feature ``times`` as common, by documents, as in the others."""
    seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for doc, bad in zip(texts, toxic.tolist()):
        seen[bad].update({f for w in set(doc) for f in features(w)})
    n = {0: 1 + int((toxic == 0).sum()), 1: 1 + int((toxic == 1).sum())}
    telling = {f for f, c in seen[1].items() if c >= least_docs and c / n[1] >= times * (seen[0][f] + 0.5) / n[0]}
    known = defaultdict(lambda: None)
    for w in {w for doc in texts for w in doc}:
        known[w] = float(any(f in telling for f in features(w)))
    return [np.array([known[w] if bad else 0.0 for w in doc]) for doc, bad in zip(texts, toxic.tolist())]


def train(texts: list[list[bytes]], toxic: np.ndarray, rounds: int = 40, rate: float = 0.5, ridge: float = 1e-4) -> Model:
    """Fit the chain to derived token labels, then the document score to the documents' labels."""
    labels = token_labels(texts, toxic)
    vocabulary: dict[bytes, int] = {}
    ids = np.array([vocabulary.setdefault(w, len(vocabulary)) for doc in texts for w in doc], np.int64)
    table = np.array([buckets(w) for w in vocabulary], np.int64).reshape(-1, 4)
    y = np.concatenate([np.empty(0), *labels])
    sizes = np.array([len(doc) for doc in texts])
    first = np.zeros(len(ids), bool)
    first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    weights, chain = np.zeros(BUCKETS), np.zeros((2, 2))
    total_w, total_c = np.full(BUCKETS, 1e-6), np.full((2, 2), 1e-6)
    inner = ~first[1:]
    observed = np.array([[((1 - y[:-1]) * (1 - y[1:]))[inner].sum(), ((1 - y[:-1]) * y[1:])[inner].sum()],
                         [(y[:-1] * (1 - y[1:]))[inner].sum(), (y[:-1] * y[1:])[inner].sum()]])
    for _ in range(rounds if len(ids) else 0):
        evidence = weights[table].sum(1)[ids]
        forward, backward = ratios(evidence, first, chain)
        m = 1 - 1 / (1 + forward * backward)
        slope_w = np.bincount(table.reshape(-1), np.repeat(np.bincount(ids, y - m, len(table)), 4), BUCKETS)
        e, k = np.exp(np.clip(evidence, -30, 30))[1:], np.exp(chain)
        pair = np.stack([np.full_like(e, k[0, 0]), k[0, 1] * e * backward[1:], k[1, 0] * forward[:-1], k[1, 1] * forward[:-1] * e * backward[1:]])
        pair = (pair / pair.sum(0))[:, inner].sum(1).reshape(2, 2)
        for value, total, slope in ((weights, total_w, slope_w - ridge * len(ids) * weights * (slope_w != 0)), (chain, total_c, observed - pair)):
            total += slope ** 2
            value += rate * slope / np.sqrt(total)
    per_doc = document_features(marginals(weights[table].sum(1)[ids], first, chain), sizes)
    return Model(weights, chain, _logistic(per_doc, toxic))


def document_features(m: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Constant, log of the expected number of toxic tokens, largest marginal as a logit; per document."""
    ends = np.cumsum(sizes)
    sums = np.append(0.0, np.cumsum(m))
    expected = np.maximum(sums[ends] - sums[ends - sizes], 0)
    top = np.zeros(len(sizes))
    some = sizes > 0
    if some.any():
        top[some] = np.maximum.reduceat(m, (ends - sizes)[some])
    top = np.clip(top, 1e-4, 1 - 1e-4)
    return np.stack([np.ones(len(sizes)), np.log(expected + 1e-2), np.log(top / (1 - top))], 1)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge * np.eye(len(b)), x.T @ (y - p) - ridge * b)
        b += np.clip(step, -2, 2)
    return b


class Scorer:
    """Scores texts; evidence of words seen is kept, up to ``keep`` words."""

    def __init__(self, model: Model, keep: int = 200_000):
        self.model, self.keep, self.known = model, keep, {}

    def _evidence(self, tokens: list[bytes]) -> np.ndarray:
        found = list(map(self.known.get, tokens))
        if None in found:
            new = list({w for w, e in zip(tokens, found) if e is None})
            if len(self.known) + len(new) > self.keep:
                self.known = {}
                new = list(set(tokens))
            sums = self.model.weights[np.array([buckets(w) for w in new])].sum(1)
            self.known.update(zip(new, sums.tolist()))
            found = list(map(self.known.__getitem__, tokens))
        return np.array(found, float)

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, list[list[dict]]]:
        """Score and toxic spans (byte offsets of words with a marginal of a half or more) of each text."""
        docs = [words(t) for t in texts]
        sizes = np.array([len(d) for d in docs], np.int64)
        first = np.zeros(int(sizes.sum()), bool)
        starts = np.cumsum(sizes) - sizes
        first[starts[sizes > 0]] = True
        m = marginals(self._evidence([w for d in docs for w in d]), first, self.model.chain)
        z = document_features(m, sizes) @ self.model.calibration
        spans = []
        for text, at, n in zip(texts, starts.tolist(), sizes.tolist()):
            own = m[at:at + n]
            hot = np.flatnonzero(own >= 0.5)
            if len(hot):
                places = [w.span() for w in WORD.finditer(text.encode())]
                spans.append([{"start": places[i][0], "stop": places[i][1], "marginal": float(own[i])} for i in hot.tolist()])
            else:
                spans.append([])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30))), spans


def _within(rows: list, most: int) -> list:
    """Rows whose sizes sum up to at most ``most``, in their order without those that do not fit; the first one always."""
    out, total = rows[:1], rows[0]["size"]
    for x in rows[1:]:
        if total + x["size"] <= most:
            out.append(x)
            total += x["size"]
    return out


def fit(docs: DataFrame, labels: DataFrame, held_out: tuple[int, int] = (5, 0), sample: int = 2000,
        sample_bytes: int = 6 << 20) -> Model | None:
    """Train on labelled documents outside the held-out fold ``crc32(id) mod n = r``; None if a class is missing."""
    n, r = held_out
    known = (labels.where((fold(F.col("doc_id"), n) != r) & F.col("toxic").isNotNull())
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    text = F.coalesce("text", F.lit(""))
    # one text per id, by hash; only narrow rows are joined with the labels
    sized = (docs.where("doc_id IS NOT NULL").select("doc_id", F.struct(F.xxhash64(text).alias("text"), F.octet_length(text).alias("size")).alias("own"))
             .groupBy("doc_id").agg(F.min("own").alias("own")).join(known, "doc_id")
             .select("doc_id", "toxic", F.xxhash64("doc_id").alias("h"), "own.text", "own.size"))
    share = sample_bytes // 2
    # texts larger than a class's share come last: one of them is used, cut, only where a class has no other
    order = (F.when(F.col("size") > share, F.col("size")).otherwise(0), "h", "doc_id")
    found = [sized.where(F.col("toxic") == c).orderBy(*order).limit(sample) for c in (0, 1)]
    schema = found[0].schema
    groups = sorted((g.collect() for g in found), key=lambda g: sum(x["size"] for x in g))  # at most 2 * sample narrow rows
    if not all(groups):
        return None
    chosen = _within(groups[0], share)
    chosen += _within(groups[1], max(share, sample_bytes - sum(x["size"] for x in chosen)))
    picked = F.broadcast(docs.sparkSession.createDataFrame(chosen, schema).select("doc_id", "toxic", "h", F.col("text").alias("_hash"), F.col("size").alias("_size")))
    cut = F.when(F.col("_size") > share, F.substring(text, 1, max(1, share // 4))).otherwise(text)
    rows = docs.select("doc_id", "text").join(picked, "doc_id").where(F.xxhash64(text) == F.col("_hash")).select("doc_id", "h", "toxic", cut.alias("text"))
    one = rows.dropDuplicates(["doc_id"]).repartition(1)  # of at most 2 * sample rows and sample_bytes; the driver gets the model alone
    parts = one.mapInArrow(_learned, "weights binary, chain binary, calibration binary").first()
    weights, chain, calibration = (np.frombuffer(p) for p in parts)
    return Model(weights, chain.reshape(2, 2), calibration)


def _learned(batches):
    """The model of all rows ``doc_id, h, toxic, text``, its arrays as bytes."""
    got = sorted((x for b in batches for x in b.to_pylist()), key=lambda x: (x["h"], x["doc_id"]))
    model = train([words(x["text"]) for x in got], np.array([x["toxic"] for x in got], int))
    got.clear()
    release_memory()
    yield pa.RecordBatch.from_arrays([pa.array([part.tobytes()], pa.binary()) for part in model], list(Model._fields))


def tag(spark: SparkSession, docs: DataFrame, model: Model | None, names: tuple[str, str] = ("tox_score", "tox_spans")) -> DataFrame:
    """All columns of ``docs`` (with ``text``), and two more: score and spans. Other ``names`` serve where ``docs`` has these."""
    if model is None:
        return docs.withColumns({names[0]: F.lit(0.0), names[1]: F.lit(None).cast(
            "array<struct<start:bigint,stop:bigint,marginal:double>>")})
    shared, run = spark.sparkContext.broadcast(model), uuid.uuid4().hex  # BUCKETS weights

    def score(batches):
        scorer = worker_cache(("toxicity", run), lambda: Scorer(shared.value))  # loaded once the last operator's memory is free
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("marginal", pa.float64())]))
        for batch in batches:
            for b in slices(batch, "text", 1000, 1 << 20):
                value, spans = scorer.score(b.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(value), pa.array(spans, kind)],
                                                 [*b.schema.names, *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    tags = f"`{names[0]}` double, `{names[1]}` array<struct<start:bigint,stop:bigint,marginal:double>>"
    return docs.mapInArrow(score, f"{schema}, {tags}" if schema else tags)


def score_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, score, predicted, n_spans`` per row of documents."""
    texts = docs.select("doc_id", "text")
    return tag(spark, texts, fit(docs, labels)).select(
        "doc_id", F.col("tox_score").alias("score"), (F.col("tox_score") >= 0.5).cast("int").alias("predicted"),
        F.greatest(F.size("tox_spans"), F.lit(0)).alias("n_spans"))
