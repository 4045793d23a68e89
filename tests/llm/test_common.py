from collections import Counter

from pyspark.sql import functions as F

from meeple.llm import common


def test_heaviest_takes_whole_steps_from_the_top(spark):
    rows = [(i, n) for i, n in enumerate([1000, 900, 100, 100, 100, 7, 5, 5, 1, 1, 1, 1])]
    df = spark.createDataFrame(rows, "i int, n bigint")
    for most in (1, 2, 4, 5, 8, 100):
        got = sorted((r.n for r in common.heaviest(df, "n", most).collect()), reverse=True)
        assert len(got) <= most and got == sorted((n for _, n in rows), reverse=True)[:len(got)]
    assert common.heaviest(df, "n", 100).count() == len(rows)
    assert common.heaviest(df, "n", 0).count() == 0
    assert common.heaviest(df.limit(0), "n", 5).count() == 0


def test_smallest_hashes_is_a_stable_sample(spark):
    df = spark.range(10_000).withColumnRenamed("id", "k")
    a = {r.k for r in common.smallest_hashes(df, "k", 300).collect()}
    b = {r.k for r in common.smallest_hashes(df.repartition(13), "k", 300).collect()}
    assert a == b and len(a) == 300
    assert common.smallest_hashes(df, "k", 20_000).count() == 10_000
    assert common.smallest_hashes(df.limit(0), "k", 5).count() == 0


def test_group_stats_of_a_hot_group(spark):
    df = spark.range(3000).select(F.col("id").alias("v"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("k"), F.col("id") % 700)).alias("k"))
    out = common.with_group_stats(df, ["k"], "v", {"low": (F.min("v"), F.min), "n": (F.count(F.lit(1)), F.sum)}).collect()
    rows = [(r.k, r.v) for r in df.collect()]
    n, low = Counter(k for k, _ in rows), {}
    for k, v in rows:
        low[k] = min(low.get(k, v), v)
    assert sorted((r.k, r.v, r.low, r.n) for r in out) == sorted((k, v, low[k], n[k]) for k, v in rows)


def test_gapless_numbers(spark):
    df = spark.range(2000).select(F.col("id").alias("v"), F.when(F.col("id") < 1500, "hot").otherwise("b").alias("k"))
    for blocks in (1, 16):
        out = common.with_gapless_number(df, ["k"], "v", ["v"], "i", blocks).collect()
        for k, n in (("hot", 1500), ("b", 500)):
            assert sorted(r.i for r in out if r.k == k) == list(range(n))


def test_fresh_names(spark):
    df = spark.createDataFrame([(1, 2)], "_a int, __A int")
    assert common.fresh("_a", df) == "___a" and common.fresh("b", df) == "b"
