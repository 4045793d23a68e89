"""Operator 1: shards by jump consistent hashing, in native expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meeple.llm.common import picked, table, with_gapless_number

# fixed values: the multiplier of the published algorithm (Lamping and Veach,
# 2014), as 16-bit limbs from the lowest
MULTIPLIER = 2862933555777941757
LIMBS = [(MULTIPLIER >> s) & 0xFFFF for s in (0, 16, 32, 48)]
#: jumps unrolled at most; a key makes about ln(n) + 1 of them, and a key that
#: is not done by then raises instead of getting a wrong shard
MOST_JUMPS = 256


def jump_bucket(key: Column, n: int) -> Column:
    """Bucket 0..n-1 of a 64-bit key (bigint, read as unsigned; null: key 0).

    Only keys that land in the new last bucket move when ``n`` grows by one.
    The state holds the key as two 32-bit halves, so that the multiplication
    modulo 2^64 never overflows a bigint under ANSI rules.
    """
    if n < 1:
        raise ValueError("at least one shard")
    key = F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint"))
    low32 = F.lit(0xFFFFFFFF)

    def step(s: Column, _: Column) -> Column:
        h, lo = s["h"], s["l"]
        c0, c1, c2, c3 = (F.lit(c).cast("bigint") for c in LIMBS)
        l1 = lo * c1
        low = lo * c0 + F.shiftleft(l1.bitwiseAND(F.lit(0xFFFF)), 16) + 1
        high = (F.shiftright(low, 32) + F.shiftright(l1, 16) + lo * c2 + h * c0
                + F.shiftleft((lo * c3 + h * c1).bitwiseAND(F.lit(0xFFFF)), 16))
        h2, l2 = high.bitwiseAND(low32), low.bitwiseAND(low32)
        jump = F.floor((s["j"] + 1).cast("double")
                       * (F.lit(2147483648.0) / (F.shiftright(h2, 1) + 1).cast("double")))
        moved = F.struct(s["j"].alias("b"), jump.cast("bigint").alias("j"),
                         h2.alias("h"), l2.alias("l"))
        return F.when(s["j"] >= n, s).otherwise(moved)

    start = F.struct(F.lit(-1).cast("bigint").alias("b"), F.lit(0).cast("bigint").alias("j"),
                     F.shiftrightunsigned(key, 32).alias("h"),
                     key.bitwiseAND(low32).alias("l"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(min(n, MOST_JUMPS))), start, step,
        lambda s: F.when(s["j"] >= n, s["b"]).otherwise(
            F.raise_error(F.lit("jump hash: key not settled")).cast("bigint"))).cast("int")


def shard_key(df: DataFrame, keys: list[str]) -> Column:
    """The 64-bit key of a row: one integer column as it is, else a hash of all."""
    kinds = dict(df.dtypes)
    if len(keys) == 1 and kinds[keys[0]] in ("tinyint", "smallint", "int", "bigint"):
        return df[keys[0]].cast("bigint")
    return F.xxhash64(*[df[k] for k in keys])


def shard(df: DataFrame, keys: list[str], n_shards: int) -> Column:
    """General interface: the shard column of any table by its stable keys."""
    return jump_bucket(shard_key(df, keys), n_shards)


def shard_documents(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    """One row per document with its shard, its place there, and its shard among
    ``n_shards + 1``.

    Null text counts as empty (size 1, crc 0), a null doc_id as key 0; repeated
    doc_ids share a shard and get slots of their own; an empty table gives no
    row. ``slot`` counts from 0 without gaps in each shard.
    """
    docs = picked(docs, "doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        shard(docs, ["doc_id"], n_shards).alias("shard"))
    rows = with_gapless_number(rows, ["shard"], "doc_id", ["doc_id", "text_crc32", "size"], "slot")
    return rows.select("doc_id", "size", "text_crc32", "law", "shard", "slot",
                       shard(rows, ["doc_id"], n_shards + 1).alias("grown_shard"))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
