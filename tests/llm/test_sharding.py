import zlib

from llm_data import documents, empty, frame
from pyspark.sql import functions as F

from meeple.llm import sharding


def jump(key: int, n: int) -> int:
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int(float(b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_matches_the_loop(spark):
    keys = [0, 1, 2, -1, 7, 10**18, -(2**63), 2**63 - 1, *range(100, 400)]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    for n in (1, 2, 16, 17, 300, 1000):
        got = df.select("k", sharding.jump_bucket(F.col("k"), n).alias("s")).collect()
        assert all(r.s == jump(r.k, n) for r in got)


def test_contract(spark):
    out = sharding.shard_documents(frame(spark)).collect()
    rows = documents()
    assert len(out) == len(rows)
    want = sorted((d is None, d or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1,
                   jump(d or 0, 16), jump(d or 0, 17)) for d, t, *_ in rows)
    assert want == sorted((r.doc_id is None, r.doc_id or 0, r.text_crc32, r.size, r.shard, r.grown_shard) for r in out)
    assert all(r.grown_shard in (r.shard, 16) and r.law == "key" for r in out)
    for s in {r.shard for r in out}:
        slots = sorted(r.slot for r in out if r.shard == s)
        assert slots == list(range(len(slots)))


def test_balance_and_other_keys(spark):
    df = spark.range(20_000).withColumn("name", F.concat(F.lit("n"), "id"))
    for keys in (["id"], ["name"], ["id", "name"]):
        n = [r["count"] for r in df.groupBy(sharding.shard(df, keys, 16).alias("s")).count().collect()]
        assert len(n) == 16 and min(n) > 1000 and max(n) < 1500


def test_native_and_empty(spark):
    df = sharding.shard_documents(empty(spark))
    assert df.collect() == []
    plan = sharding.shard_documents(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
