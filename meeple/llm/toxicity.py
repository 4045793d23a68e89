"""Operator 2: toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents (positives) and documents drawn from the whole table
(unlabelled) train a sparse linear classifier. The risk of the negative class is
not observed; it is the unlabelled risk minus the class prior's share of the
positives' risk, and is held at zero or above (Kiryo et al., 2017).
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meeple.llm.common import crc_of_id, picked, slices, small_batches, smallest_hashes, stored, table, worker_state

POSITIVES = 4_000  # most confirmed toxic documents that the fit reads
UNLABELLED = 8_000  # most documents drawn as unlabelled
FEATURES = 2_000  # of the hashed features, those that positives have most above the unlabelled
LEAST_LIFT = 3.0  # times that a feature must be commoner among positives than among negatives
LEAST_Z = 4.0  # standard errors that it must be commoner than among the unlabelled
BUCKETS = 1 << 22
PREFIXES = (4, 5, 6)  # of words, besides whole words
HELD = 100_000  # words whose features a worker holds at once


@dataclass
class Model:
    bias: float = 0.0
    weights: dict[int, float] = field(default_factory=dict)


def word_features(word: str) -> tuple[int, ...]:
    """Hashed features of a lower-case word: itself and its longer prefixes."""
    parts = {"=" + word} | {word[:k] for k in PREFIXES if len(word) >= k}
    return tuple(zlib.crc32(p.encode("utf-8", "surrogatepass")) % BUCKETS for p in parts)


def _words(text: str | None) -> list[str]:
    return re.findall(r"[^\W\d_]+", (text or "").lower())


def levels(counts: dict[int, int], n: int) -> list[int]:
    """Binary features from the counts of hashed ones in n words: it occurs; it
    occurs twice; it makes up 1% of the words."""
    out = []
    for f, c in counts.items():
        out.append(4 * f)
        if c >= 2:
            out.append(4 * f + 1)
        if 100 * c >= n:
            out.append(4 * f + 2)
    return out


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = []
        for t in b.column("text").to_pylist():
            words = _words(t)
            counts: Counter[int] = Counter()
            for w, c in Counter(words).items():
                for f in word_features(w):
                    counts[f] += c
            found.append(sorted(levels(counts, len(words))))
        yield pa.RecordBatch.from_arrays(
            [b.column("pos"), b.column("unl"), pa.array(found, pa.list_(pa.int32()))],
            names=["pos", "unl", "features"])


def nnpu_fit(rows: np.ndarray, cols: np.ndarray, n: int, k: int, pos: np.ndarray, unl: np.ndarray,
             prior: float, steps: int = 600, rate: float = 0.1, l1: float = 3e-4) -> tuple[float, np.ndarray]:
    """Bias and weights of a logistic classifier over n documents with binary
    features, given as (row, column) pairs, by Adam on the non-negative risk with
    an L1 term, which leaves features that tell little at zero."""
    w, b = np.zeros(k), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    p_share, u_share = pos / max(pos.sum(), 1), unl / max(unl.sum(), 1)
    for t in range(1, steps + 1):
        f = b + np.bincount(rows, w[cols], minlength=n)
        s = 1 / (1 + np.exp(-np.clip(f, -30, 30)))
        as_neg = np.logaddexp(0, f)  # loss of calling a document negative wrongly
        negative = u_share @ as_neg - prior * (p_share @ as_neg)
        g_neg = (u_share - prior * p_share) * s
        g = prior * p_share * (s - 1) + g_neg if negative >= 0 else -g_neg
        grad = np.append(np.bincount(cols, g[rows], minlength=k) + l1 * np.sign(w), g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return b, np.where(np.abs(w) < 0.1, 0.0, w)


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES,
          unlabelled: int = UNLABELLED) -> Model:
    """Fit on docs(doc_id, text) and labels(doc_id, toxic) outside the held-out fold.

    Learning goes by distinct texts, so that copies of one text weigh as one. Both
    samples are the texts with the smallest hashes, at most ``positives`` and
    ``unlabelled`` of them. The class prior is the toxic share of the labelled
    texts. Without a positive the model is empty.
    """
    learn = crc_of_id() % 5 != 0
    marked = (picked(labels, "doc_id", "toxic").filter(learn & F.col("toxic").isNotNull())
              .groupBy("doc_id").agg(F.avg("toxic").alias("toxic"), F.max(F.col("toxic") == 1).alias("pos")))
    docs = picked(docs, "doc_id", "text")
    key = F.xxhash64(F.coalesce("text", F.lit("")))  # texts that share one count as one
    # one small row per distinct text, and a row that holds it (a positive one if there is one)
    texts = stored(docs.filter(learn).select("doc_id", key.alias("key")).distinct()
                   .join(marked, "doc_id", "left").groupBy("key")
                   .agg(F.coalesce(F.min(F.when(F.col("pos"), F.col("doc_id"))), F.min("doc_id")).alias("doc_id"),
                        F.avg("toxic").alias("toxic"), F.max("pos").alias("pos")), "toxicity-texts")
    known = texts.agg(F.avg("toxic").alias("prior")).first()
    prior = min(0.99, float(known.prior or 0.0))
    if prior <= 0:
        return Model()
    # two bounded tables of texts; only they are broadcast
    p_ids = (smallest_hashes(texts.filter("pos").select("doc_id", "key"), "key", positives)
             .withColumn("pos", F.lit(True)))
    u_ids = (smallest_hashes(texts.select("doc_id", "key"), "key", unlabelled)
             .withColumn("unl", F.lit(True)))
    ids = p_ids.join(u_ids, ["doc_id", "key"], "full").na.fill(False, ["pos", "unl"])
    held = docs.withColumn("key", key).join(F.broadcast(ids), ["doc_id", "key"])
    sample = stored(held.dropDuplicates(["key"]).select("pos", "unl", "text")  # rows may repeat
                    .mapInArrow(_featured, "pos boolean, unl boolean, features array<int>"), "toxicity-sample")

    sizes = sample.agg(F.sum(F.col("pos").cast("int")).alias("p"), F.sum(F.col("unl").cast("int")).alias("u")).first()
    if not sizes.p or not sizes.u:
        return Model()
    seen = (sample.select("pos", "unl", F.explode("features").alias("feature")).groupBy("feature")
            .agg(F.sum(F.col("pos").cast("int")).alias("p"), F.sum(F.col("unl").cast("int")).alias("u")))
    share_p, share_u = F.col("p") / F.lit(float(sizes.p)), F.col("u") / F.lit(float(sizes.u))
    floor = F.greatest(share_u, F.lit(0.5 / sizes.u))  # as if half a document had it
    z = (share_p - floor) / F.sqrt(floor / sizes.p)
    # the unlabelled hold the prior's share of positives: what is left is the negatives' share
    share_n = F.greatest((share_u - prior * share_p) / (1 - prior), F.lit(0.5 / sizes.u))
    best = [r.feature for r in seen.filter((share_p >= LEAST_LIFT * share_n) & (z >= LEAST_Z))
            .orderBy(F.desc(z), "feature").limit(FEATURES).select("feature").collect()]
    place = {f: i for i, f in enumerate(best)}
    chosen = F.array_intersect("features", F.array(*[F.lit(f) for f in best]).cast("array<int>"))
    fit_on = sample.select("pos", "unl", chosen.alias("features")).collect() if best else []
    if not fit_on:
        return Model()
    rows = np.repeat(np.arange(len(fit_on)), [len(r.features) for r in fit_on])
    cols = np.array([place[f] for r in fit_on for f in r.features], np.int64)
    pos, unl = (np.array([r[c] for r in fit_on], float) for c in ("pos", "unl"))
    bias, w = nnpu_fit(rows, cols, len(fit_on), len(best), pos, unl, prior)
    return Model(float(bias), {f: float(x) for f, x in zip(best, w, strict=True) if x})


def _scorer(model_of):
    """text, ... batches -> score per row, 0 for all if the model is empty."""
    def scores(texts: list[str | None]) -> list[float]:
        run, bias, weights = model_of.value
        if not weights:
            return [0.0] * len(texts)
        cache: dict[str, tuple[int, ...]] = worker_state(run, "words", dict)
        bases = {f // 4 for f in weights}
        out = []
        for t in texts:
            words, counts = _words(t), Counter()
            for w in words:
                known = cache.get(w)
                if known is None:
                    if len(cache) >= HELD:
                        cache.clear()
                    known = cache[w] = tuple(f for f in word_features(w) if f in bases)
                for f in known:
                    counts[f] += 1
            f = bias + sum(weights.get(h, 0.0) for h in sorted(levels(counts, len(words))))
            out.append(float(1 / (1 + np.exp(-max(-30.0, min(30.0, f))))))
        return out
    return scores


def with_score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with all its columns and a double column ``name`` (replaced if present)."""
    scores = _scorer(docs.sparkSession.sparkContext.broadcast(
        (uuid.uuid4().hex, model.bias, model.weights)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            arrays = [*b.columns, pa.array(scores(b.column("text").to_pylist()), pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*b.schema.names, name])
    small_batches(docs.sparkSession)
    docs = docs.drop(name)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{kinds}, `{name}` double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted.

    Null and empty texts have no features and get the model's bias as score (0
    if there is nothing to learn from). lang, source, labels and doc_id are no
    inputs of a score.
    """
    docs = picked(docs, "doc_id", "text")
    scored = with_score(docs, train(docs, labels))
    return scored.select("doc_id", (crc_of_id() % 5 == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
