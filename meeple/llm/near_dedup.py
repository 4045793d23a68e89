"""Operator 7: near duplicates by MinHash, odd sketches and exact confirmation.

1. Each text becomes its set of distinct word shingles. Texts with the same word
   sequence form one class; only its representative (smallest row number) goes on.
2. MinHash samples are cut into bands; representatives that agree in a band are
   candidates. Bands only say where to look: within a bucket every member is
   compared with one hub, then members that are still outside the bucket's largest
   component are compared with members of other components.
3. The samples are folded into an odd sketch, a bitmap of parities. The XOR of two
   sketches counts the samples that differ, so candidates far below the wanted
   similarity are turned away before their texts are read.
   A second odd sketch, of the whole set, bounds the symmetric difference from
   below: with more odd bits than a link may have differences, a pair is no link for
   certain.
4. What is left is confirmed on the full sets. Links give components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meeple.llm.common import let_go, picked, pin, slices, small_batches, stored, table, with_group_stats, words

SHINGLE, PERCENT = 4, 80
BANDS, ROWS = 32, 5  # a pair at 0.8 shares no band once in 300,000 times
SAMPLES = BANDS * ROWS
SKETCH = 512  # bits of the odd sketch of the samples
BODY = 1024  # bits of the odd sketch of the whole set
LARGE = 4096  # members of a part of a bucket: larger buckets are searched in several tasks
PARTNERS = 512  # pairs of one hub that are confirmed together
BROADCAST_IDS = 1_000_000  # ids (8 MB) up to which the texts are filtered by a broadcast
SLACK = 5.0  # standard deviations that the sketch filter leaves below the bound


def _constants(n: int, seed: int) -> np.ndarray:
    return np.random.RandomState(seed).randint(1, 1 << 62, n).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (the public splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(found: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; of the whole sequence if
    it is shorter than ``width``; empty without words."""
    from xxhash import xxh64_intdigest
    if not found:
        return np.zeros(0, np.uint64)
    h = np.array(list(map(xxh64_intdigest, found)), np.uint64)
    k = min(width, len(h))
    out = np.full(len(h) - k + 1, np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    for i in range(k):
        out = _mix(out + h[i:len(h) - k + 1 + i])
    return np.unique(out)


def _lowered(data: str | None) -> list[bytes]:
    return [w.lower() for w in words(data)]  # bytes.lower changes A-Z only


def samples(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """MinHash: for each of the hash functions the smallest value over the set."""
    least = np.full(len(a), np.uint64((1 << 64) - 1))
    for i in range(0, len(shingles), 1024):
        part = shingles[i:i + 1024, None] * a + b
        np.minimum(least, part.min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray, bands: int) -> np.ndarray:
    parts = least.reshape(bands, -1)
    key = np.arange(bands, dtype=np.uint64)
    for i in range(parts.shape[1]):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, i])
    return key.view(np.int64)


def odd_sketch(least: np.ndarray, bits: int) -> np.ndarray:
    """Bit j is the parity of the samples (function, value) that hash to j."""
    at = _mix(_mix(least) + np.arange(len(least), dtype=np.uint64)) % np.uint64(bits)
    odd = (np.bincount(at.astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def odd_body(shingles: np.ndarray, bits: int) -> np.ndarray:
    """Bit j is the parity of the shingles that hash to j: two sets differ in at least
    as many shingles as their bitmaps do in bits."""
    odd = (np.bincount((shingles % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def most_unlike_bits(percent: int, n_samples: int, bits: int, slack: float = SLACK) -> int:
    """Bits that may differ between sketches of sets at the wanted similarity: the
    expectation plus ``slack`` standard deviations of sampling and folding."""
    unlike = 1 - percent / 100
    m = 2 * n_samples * unlike
    left = (1 - 2 / bits) ** m
    sampling = 2 * math.sqrt(n_samples * unlike * (1 - unlike)) * left
    folding = 2 * math.sqrt(m * m / 2 / bits)  # each two that fall on one bit cost two
    return math.ceil(bits * (1 - left) / 2 + slack * math.hypot(sampling, folding))


SIGNED = ("row bigint, doc_id bigint, sequence binary, n_shingles bigint, keys array<bigint>,"
          " sketch array<bigint>, body array<bigint>")


def _signed(width: int, bands: int, rows: int, bits: int):
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        let_go()
        a, b_ = _constants(bands * rows, 1), _constants(bands * rows, 2)
        for b in slices(batches):
            out: dict[str, list] = {c: [] for c in ("sequence", "n_shingles", "keys", "sketch", "body")}
            for text in b.column("text").to_pylist():
                found = _lowered(text)
                s = shingle_set(found, width)
                out["sequence"].append(hashlib.sha256(b" ".join(found)).digest())
                out["n_shingles"].append(len(s))
                if len(s):
                    least = samples(_mix(s), a, b_)
                    out["keys"].append(band_keys(least, bands))
                    out["sketch"].append(odd_sketch(least, bits))
                    out["body"].append(odd_body(_mix(s), BODY))
                else:
                    for c in ("keys", "sketch", "body"):
                        out[c].append(None)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("doc_id"), pa.array(out["sequence"], pa.binary()),
                 pa.array(out["n_shingles"], pa.int64()), pa.array(out["keys"], longs),
                 pa.array(out["sketch"], longs), pa.array(out["body"], longs)],
                names=["row", "doc_id", "sequence", "n_shingles", "keys", "sketch", "body"])
    return signed


def _confirmed(width: int, percent: int):
    """Rows (a, part, b, text), sorted: the hub's text (null b) before those of its
    partners -> the pairs that are similar enough. One set is held, the hub's."""
    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        hub, mine = None, np.zeros(0, np.uint64)
        for b in slices(batches):
            out: tuple[list, list] = ([], [])
            for x, part, y, text in zip(*(b.column(c).to_pylist() for c in ("a", "part", "b", "text")), strict=True):
                found = shingle_set(_lowered(text), width)
                if y is None:
                    hub, mine = (x, part), found
                    continue
                if hub != (x, part):
                    raise RuntimeError(f"the text of document row {x} is missing")
                both = len(np.intersect1d(mine, found, assume_unique=True))
                if 100 * both >= percent * (len(mine) + len(found) - both):
                    out[0].append(x)
                    out[1].append(y)
            yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], names=["a", "b"])
    return confirmed


def _unlike(left: str, right: str, column: str, bits: int) -> Column:
    return sum((F.bit_count(F.col(f"{left}.{column}")[i].bitwiseXOR(F.col(f"{right}.{column}")[i]))
                for i in range(bits // 64)), F.lit(0))


def _close(left: str, right: str, percent: int, most_bits: int) -> Column:
    """Sizes and odd sketches of two candidates allow the wanted similarity. A link's
    sets differ in (1 - j) / (1 + j) of the sum of their sizes at most."""
    n, m = F.col(f"{left}.n_shingles"), F.col(f"{right}.n_shingles")
    return ((100 * F.least(n, m) >= percent * F.greatest(n, m))
            & (_unlike(left, right, "sketch", SKETCH) <= most_bits)
            & ((100 + percent) * _unlike(left, right, "body", BODY) <= (100 - percent) * (n + m)))


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in links(a, b): the smallest id it is connected to.

    Each round takes the smallest label among the neighbours, then that label's own
    label; it ends when nothing changes. Links stay a table, labels another.
    """
    edges = pin(links.union(links.select("b", "a")).toDF("id", "other").distinct())
    labels = pin(edges.groupBy("id").agg(F.min("other").alias("m"))
                 .select("id", F.least("id", "m").alias("component")))
    while True:
        near = (edges.join(labels.withColumnRenamed("id", "other"), "other")
                .groupBy("id").agg(F.min("component").alias("near")))
        better = (labels.join(near, "id")
                  .select("id", "component", F.least("component", "near").alias("new")))
        jump = labels.select(F.col("id").alias("new"), F.col("component").alias("far"))
        after = pin(better.join(jump, "new", "left").select(
            "id", F.least("new", F.coalesce("far", "new")).alias("component"),
            (F.least("new", F.coalesce("far", "new")) != F.col("component")).alias("moved")))
        labels = after.select("id", "component")
        if not after.filter("moved").limit(1).count():
            return labels


def _confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. A partner's text goes to the
    task of its pair; the hub's text goes there once for PARTNERS of its pairs."""
    ids = pin(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    texts = stored(texts.join(F.broadcast(ids) if few else ids, "id", "left_semi"), "near-dedup-texts")
    dealt = with_group_stats(pairs, ["a"], "b", {"m": (F.count(F.lit(1)), F.sum)})
    parts = F.ceil(F.col("m") / F.lit(PARTNERS))
    dealt = pin(dealt.select("a", F.pmod(F.xxhash64("b"), parts).alias("part"), "b"))
    hubs = (dealt.select("a", "part").distinct().join(texts.withColumnRenamed("id", "a"), "a")
            .select("a", "part", F.lit(None).cast("bigint").alias("b"), "text"))
    partners = dealt.join(texts.withColumnRenamed("id", "b"), "b").select("a", "part", "b", "text")
    return (hubs.union(partners).repartition("a", "part")
            .sortWithinPartitions("a", "part", F.asc_nulls_first("b"))
            .mapInArrow(_confirmed(width, percent), "a bigint, b bigint"))


def numbered(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text) written once: row numbers stay the same for all later reads."""
    docs = picked(docs, "doc_id", "text")
    return stored(docs.select(F.monotonically_increasing_id().alias("row"),
                              F.col("doc_id").cast("long").alias("doc_id"), "text"), "near-dedup-rows")


def row_groups(rows: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(row, doc_id, n_shingles, component_id, kept) of ``numbered`` rows; see near_groups."""
    small_batches(rows.sparkSession)
    signed = stored(rows.mapInArrow(_signed(width, BANDS, ROWS, SKETCH), SIGNED), "near-dedup-signed")

    # classes of one word sequence; the row with the smallest number stands for its class
    classes = pin(with_group_stats(signed.filter("n_shingles > 0").select("row", "doc_id", "sequence"),
                                   ["sequence"], "row", {"rep": (F.min("row"), F.min)}))
    reps = stored(signed.join(classes.filter("row = rep").select("row"), "row", "left_semi")
                  .select(F.col("row").alias("id"), "n_shingles", "keys", "sketch", "body"), "near-dedup-reps")
    light = reps.select("id", "n_shingles", "sketch", "body")
    texts = rows.select(F.col("row").alias("id"), "text")
    most_bits = most_unlike_bits(percent, SAMPLES, SKETCH)
    # rows that repeat a doc_id are one document: their classes are linked
    ids = (classes.filter("doc_id IS NOT NULL").groupBy("doc_id")
           .agg(F.min("rep").alias("a"), F.max("rep").alias("last")).filter("a != last"))
    one = (classes.join(ids, "doc_id").filter("rep != a").select("a", F.col("rep").alias("b")).distinct())

    # candidates 1: every member of a bucket with the bucket's smallest id
    bands = reps.select("id", F.explode("keys").alias("key"))
    members = stored(with_group_stats(bands, ["key"], "id", {
        "hub": (F.min("id"), F.min), "m": (F.count(F.lit(1)), F.sum)}).filter("m > 1"), "near-dedup-members")
    stars = members.filter("id != hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()

    def near(pairs: DataFrame) -> DataFrame:
        x = light.select(F.col("id").alias("a"), F.struct("n_shingles", "sketch", "body").alias("x"))
        y = light.select(F.col("id").alias("b"), F.struct("n_shingles", "sketch", "body").alias("y"))
        return (pairs.join(x, "a").join(y, "b").filter(_close("x", "y", percent, most_bits))
                .select("a", "b"))

    links = pin(_confirm(pin(near(stars)), texts, width, percent).union(one))
    found = components(links)

    # candidates 2: members of one bucket that are in different components still
    of = members.join(found, "id", "left").select(
        "id", "key", F.coalesce("component", "id").alias("component"))
    open_ = with_group_stats(of, ["key"], "id", {
        "low": (F.min("component"), F.min), "high": (F.max("component"), F.max),
        "m": (F.count(F.lit(1)), F.sum)}).filter("low != high")
    open_ = pin(open_.select("id", "key", "component", "m"))
    # every pair across components has a member outside the bucket's largest one:
    # only such members look for partners, so a huge component is never compared
    # with itself. A large bucket is cut into parts; they look in each of them
    within = open_.withColumn("parts", F.ceil(F.col("m") / F.lit(LARGE)))
    largest = (within.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
               .groupBy("key").agg(F.max(F.struct("n", "component"))["component"].alias("largest")))
    y = (within.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
         .join(light, "id").alias("y"))
    x = (within.join(largest, "key").filter("component != largest")
         .withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
         .join(light, "id").alias("x"))
    other = F.col("x.component") != F.col("y.component")
    once = (F.col("y.component") == F.col("x.largest")) | (F.col("x.id") < F.col("y.id"))
    same = (F.col("x.key") == F.col("y.key")) & (F.col("x.part") == F.col("y.part"))
    rest = (x.join(y, same & other & once & _close("x", "y", percent, most_bits))
            .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct())
    rest = pin(rest.join(stars, ["a", "b"], "left_anti"))
    if rest.limit(1).count():
        more = pin(_confirm(rest, texts, width, percent))
        if more.limit(1).count():
            found = components(links.union(more))

    # back to all rows: a component is named by its smallest doc_id, null ids last
    whole = classes.join(found.select(F.col("id").alias("rep"), "component"), "rep", "left").select(
        "row", "doc_id", F.coalesce("component", "rep").alias("component"))
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    named = with_group_stats(whole, ["component"], "row", {"first": (F.min(rank), F.min)}).select("row", "first")
    alone = F.col("first").isNull()
    stays = F.when(F.col("doc_id").isNotNull(), F.col("doc_id").eqNullSafe(F.col("first.doc_id"))).otherwise(
        F.col("row") == F.col("first.row"))
    return signed.select("row", "doc_id", "n_shingles").join(named, "row", "left").select(
        "row", "doc_id", "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        (alone | stays).alias("kept"))


def near_groups(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, n_shingles, component_id, kept.

    Null texts and texts without words have the empty set and are linked with
    nothing. doc_id is the key: rows with text that repeat it are one document, linked
    with whatever any of their texts is linked with, and all kept or none. Rows with a
    null doc_id are documents of their own; they are compared like all others, come
    after all ids, and of a component without any id one row is kept. Whole texts of
    any length are compared. An empty table gives no row.
    """
    return row_groups(numbered(docs), width, percent).drop("row")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))
