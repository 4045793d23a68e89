"""Operator 5: quality rules by distribution divergence.

One pass over the texts makes a row of counts per document: the base counts, a
histogram of character classes and one of common words. From these rows each
language gets reference distributions, and a document is dropped if either of
its histograms is too far (Jensen-Shannon distance, base 2) from the nearest
language. Short documents are guarded: the bounds widen with 1/sqrt(words), and
below GUARD words the verdict is to keep.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meeple.llm.common import picked, stored, table

# fixed values: common function words of the four languages of the corpus
COMMON = {
    "en": "the of and to in is that it for on was with as by be are this at from or an not have",
    "de": "der die das und den von zu mit ist des im dem nicht ein eine für auf sich auch es wie",
    "fr": "le la les de des et un une en du que pour dans qui par au sur pas est il elle ou",
    "es": "el los las y que en uno una por con se del su para como más al lo sus pero este",
}
#: character classes, in order: a-z, A-Z, 0-9, white space, sentence marks,
#: other ASCII, bytes of other characters
CLASSES = 7
GUARD = 40  # words below which the distances decide nothing
LANGUAGES = 256  # references that documents are held against at once
SHARES = 10_000  # steps of a share in which its median is found
CHAR_BOUND = (0.07, 1.2)  # distance allowed: a + b / sqrt(words)
WORD_BOUND = (0.09, 2.7)


def _bins() -> dict[bytes, int]:
    bins: dict[bytes, int] = {}
    for w in dict.fromkeys(" ".join(COMMON.values()).split()):
        at = len(set(bins.values())) + 1
        for end in ("", ".", ","):
            bins[(w + end).encode()] = at
    return bins


WORD_BINS = len(set(_bins().values())) + 1
COUNTS = ("doc_id {id}, lang string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint,"
          " n_repeat_words bigint, chars array<bigint>, common array<int>")


def repeated_words(found: list[bytes], width: int = 5) -> int:
    """Words inside windows of ``width`` words that occur twice or more."""
    if len(found) <= width:
        return 0
    windows = list(zip(*[found[i:] for i in range(width)], strict=False))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    hit = np.flatnonzero(np.fromiter((seen[w] > 1 for w in windows), bool, len(windows)))
    covered = np.zeros(len(found) + 1, np.int64)
    np.add.at(covered, hit, 1)
    np.add.at(covered, hit + width, -1)
    return int((np.cumsum(covered) > 0).sum())


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bins = _bins()
    kinds = np.full(256, 5)
    kinds[97:123], kinds[65:91], kinds[48:58], kinds[128:] = 0, 1, 2, 6
    kinds[[32, 9, 10, 11, 12, 13]] = 3
    kinds[[ord(c) for c in ".,;:'\"-()!?"]] = 4
    symbols = [ord(c) for c in "#*$%&|<>"]
    for b in batches:
        out: list[list] = [[] for _ in range(7)]
        for data in b.column("data").to_pylist():
            found = data.split()
            a = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
            chars = np.bincount(kinds, weights=a, minlength=CLASSES).astype(np.int64)
            points = len(data) - int(a[128:192].sum())  # without UTF-8 continuation bytes
            lines = Counter(data.split(b"\n"))
            dup = sum(n - 1 for x, n in lines.items() if n > 1 and x.split())
            common = np.bincount(np.fromiter(map(bins.get, data.lower().split(), repeat(0)), np.int64,
                                             len(found)), minlength=WORD_BINS)
            for o, v in zip(out, (len(found), points - int(chars[3]), int(a[symbols].sum()), dup,
                                  repeated_words(found), chars, common.astype(np.int32)), strict=True):
                o.append(v)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("lang"), *[pa.array(o, pa.int64()) for o in out[:5]],
             pa.array(out[5], pa.list_(pa.int64())), pa.array(out[6], pa.list_(pa.int32()))],
            names=["doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                   "n_repeat_words", "chars", "common"])


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of each row of counts p to the distribution q."""
    p = p / np.maximum(p.sum(axis=1, keepdims=True), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=1)
    return np.sqrt(np.maximum(0.0, (left + right) / 2))


def _nearest(counts: np.ndarray, refs: list[np.ndarray]) -> np.ndarray:
    return np.min([js_distance(counts, q) for q in refs], axis=0)


def medians(fair: DataFrame) -> DataFrame:
    """(lang, at, share): per language the median share of each character class over
    its documents, exact in steps of 1 / SHARES: from counts of the steps, which don't
    depend on how rows are laid out."""
    total = F.aggregate("chars", F.lit(0).cast("bigint"), lambda a, x: a + x)
    steps = F.transform("chars", lambda c: F.floor(c * SHARES / total).cast("int"))
    counts = (fair.select("lang", F.posexplode(steps).alias("at", "step"))
              .groupBy("lang", "at", "step").agg(F.count(F.lit(1)).alias("n")))
    upto = Window.partitionBy("lang", "at").orderBy("step")
    whole = Window.partitionBy("lang", "at")
    middle = counts.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(whole))
    return (middle.filter(2 * F.col("upto") >= F.col("all")).groupBy("lang", "at")
            .agg((F.min("step") / SHARES).alias("share")))


def _distance(df: DataFrame, refs: DataFrame, column: str, out: str) -> DataFrame:
    """``df`` plus the distance of ``column`` to the nearest of refs(lang, at, value), 0
    without any. References go through in blocks of LANGUAGES, as many as there are."""
    by_lang = refs.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("values"))
    held: list[np.ndarray] = []
    parts = []
    for r in by_lang.orderBy("lang").toLocalIterator():
        q = np.array([v.value for v in r["values"]], float)
        if q.sum():
            held.append(q / q.sum())
        if len(held) == LANGUAGES:
            parts.append(held)
            held = []
    if held or not parts:
        parts.append(held)
    names = [f"_{out}{i}" for i in range(len(parts))]
    for name, part in zip(names, parts, strict=True):
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        df = df.mapInPandas(_distances(part, column, name), f"{kinds}, {name} double")
    nearest = F.col(names[0]) if len(names) == 1 else F.least(*names)
    return df.withColumn(out, nearest).drop(*names)


def _bound(bound: tuple[float, float], n: np.ndarray) -> np.ndarray:
    return bound[0] + bound[1] / np.sqrt(np.maximum(n, 1))


def _distances(refs: list[np.ndarray], column: str, out: str):
    def distances(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            counts = np.stack(f[column].to_numpy()).astype(float) if len(f) else np.zeros((0, 1))
            f[out] = _nearest(counts, refs) if refs and len(f) else 0.0
            yield f
    return distances


def quality(docs: DataFrame, guard: int = GUARD) -> DataFrame:
    """One row per row of docs(doc_id, text, lang): the base counts, base_failed, kept,
    char_distance and word_distance (null below the guard).

    Null text counts as no words, which fails the base. Null languages are scored
    like all others but make no reference. With no document to make a reference
    from, the method keeps all. Repeated rows give a row each.
    """
    docs = picked(docs, "doc_id", "text", "lang")
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data"))
    counts = stored(rows.mapInArrow(_counted, COUNTS.format(id=kind)), "quality-counts")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    counts = counts.withColumn("base_failed", failed)
    fair = counts.filter(~failed & (F.col("n_words") >= guard) & F.col("lang").isNotNull())

    # characters: the median share of each class over a language's documents, which
    # junk among them doesn't move
    char_refs = medians(fair).withColumnRenamed("share", "value")
    scored = _distance(counts, char_refs, "chars", "char_distance")

    # common words: all words of a language's documents whose characters are in bounds
    root = F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))
    in_bounds = F.col("char_distance") <= CHAR_BOUND[0] + CHAR_BOUND[1] / root
    word_refs = (scored.filter(~F.col("base_failed") & (F.col("n_words") >= guard) & in_bounds & F.col("lang").isNotNull())
                 .groupBy("lang").agg(*[F.sum(F.col("common")[i]).alias(f"w{i}") for i in range(WORD_BINS)])
                 .select("lang", F.posexplode(F.array(*[f"w{i}" for i in range(WORD_BINS)])).alias("at", "value")))
    out = _distance(scored, word_refs, "common", "word_distance")
    fits = in_bounds & (F.col("word_distance") <= WORD_BOUND[0] + WORD_BOUND[1] / root)
    long_enough = F.col("n_words") >= guard
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (~long_enough | fits)).alias("kept"),
        F.when(long_enough, F.col("char_distance")).alias("char_distance"),
        F.when(long_enough, F.col("word_distance")).alias("word_distance"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))
