"""Versioned tables, batches and incremental statistics."""

import glob
import os
import random

import pytest
from pyspark.sql import types as T

from meeple.operators import ratings
from meeple.plans import jobs
from meeple.sources import versioned
from meeple.sources.versioned import VersionedTable

SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("x", T.StringType())])
BATCH = "user_id int, id int, rating double, ts long, event_id long"


def rows(df):
    return sorted(map(tuple, df.collect()))


def size(path):
    return sum(os.path.getsize(f) for f in glob.glob(f"{path}/data/**/*.parquet", recursive=True))


def test_batches_versions_and_replay(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/t", SCHEMA, ["k"], 4)
    assert rows(t.read()) == []
    t.merge(spark.createDataFrame([(i, "a") for i in range(40)], SCHEMA), "one")
    t.merge(spark.createDataFrame([(3, "b"), (99, "new")], SCHEMA), "two")
    want = sorted([(i, "b" if i == 3 else "a") for i in range(40)] + [(99, "new")])
    assert rows(t.read()) == want
    t.merge(spark.createDataFrame([(3, "b"), (99, "new")], SCHEMA), "two")
    assert rows(t.read()) == want and t.version().number == 2
    assert rows(t.read(t.version(1))) == [(i, "a") for i in range(40)]
    assert rows(t.lookup(spark.createDataFrame([(3,), (7,), (1234,)], "k int"))) == [(3, "b"), (7, "a")]
    t.merge(spark.createDataFrame([], SCHEMA), "empty")
    assert rows(t.read()) == want and t.before("two").number == 1


def test_a_batch_writes_its_own_rows_and_buckets_are_compacted(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/t", SCHEMA, ["k"], 8)
    r = random.Random(1)
    state = {i: "".join(r.choices("abcdefgh", k=200)) for i in range(3000)}
    t.merge(spark.createDataFrame(list(state.items()), SCHEMA), "start")
    whole = size(t.path)
    for n in range(6):
        before = size(t.path)
        batch = {k: "".join(r.choices("ijklmnop", k=200)) for k in r.sample(range(3100), 30)}
        t.merge(spark.createDataFrame(list(batch.items()), SCHEMA), f"b{n}")
        state.update(batch)
        assert size(t.path) - before < whole / 5
        assert rows(t.read()) == sorted(state.items())
    big = {k: "z" for k in range(2500)}
    v = t.merge(spark.createDataFrame(list(big.items()), SCHEMA), "big")
    state.update(big)
    assert rows(t.read()) == sorted(state.items())
    assert all(len(f) == 1 and f[0][1] for f in v.folders.values())  # all written anew
    assert sum(n for f in v.folders.values() for _, _, n in f) == len(state)


def test_a_failing_job_leaves_the_version_before(spark, tmp_dir, monkeypatch):
    t = VersionedTable(spark, f"{tmp_dir}/t", SCHEMA, ["k"], 4)
    t.merge(spark.createDataFrame([(1, "a")], SCHEMA), "one")

    def broken(*a):
        raise RuntimeError("lost")
    monkeypatch.setattr(VersionedTable, "_commit", broken)
    with pytest.raises(RuntimeError):
        t.merge(spark.createDataFrame([(1, "b"), (2, "b")], SCHEMA), "two")
    assert rows(t.read()) == [(1, "a")] and t.version().number == 1
    monkeypatch.undo()
    t.merge(spark.createDataFrame([(1, "b"), (2, "b")], SCHEMA), "two")
    assert rows(t.read()) == [(1, "b"), (2, "b")]
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        t._commit(2, "other", {})


def random_batch(r, n, at):
    return [(r.randint(1, 20), r.randint(1, 8), r.choice([1.0, 2.5, 7.3, 10.0, None]), at + i, at + i) for i in range(n)]


def test_statistics_equal_a_recomputation(spark, tmp_dir, monkeypatch):
    r = random.Random(2)
    first = {(u, g): float(r.randint(1, 10)) for u in range(1, 15) for g in range(1, 6)}
    reviews, stats = jobs.start_rating_tables(
        spark, spark.createDataFrame([(u, g, x) for (u, g), x in first.items()], ratings.REVIEW_ROWS),
        f"{tmp_dir}/r", f"{tmp_dir}/s", 4)
    from meeple.session import checkpoint_dir
    checkpoint_dir(spark)
    state, submitted = dict(first), {}
    merge = VersionedTable.merge
    for n in range(4):
        batch = random_batch(r, 60, 1000 * n)
        df = spark.createDataFrame(batch, BATCH)
        if n == 2:  # the job is lost between the two tables, then runs again
            def lost(self, rows_, batch_id):
                if self.path.endswith("/s"):
                    raise RuntimeError("lost")
                return merge(self, rows_, batch_id)
            monkeypatch.setattr(VersionedTable, "merge", lost)
            with pytest.raises(RuntimeError):
                ratings.merge_ratings(reviews, stats, df, f"b{n}")
            monkeypatch.setattr(VersionedTable, "merge", merge)
        for _ in range(2 if n % 2 else 1):
            ratings.merge_ratings(reviews, stats, df, f"b{n}")
        for u, g, x, *_ in batch:
            state[u, g] = x
            submitted[g] = submitted.get(g, 0) + 1
        got = {x.id: x for x in ratings.averages(stats.read()).collect()}
        assert rows(reviews.read().filter("rating IS NOT NULL")) == sorted(
            (u, g, x) for (u, g), x in state.items() if x is not None)
        for g in got:
            values = [x for (_, b), x in state.items() if b == g and x is not None]
            assert got[g].n == len(values)
            assert got[g].average == pytest.approx(sum(values) / len(values), rel=1e-12)
            assert got[g].submitted == submitted.get(g, 0) + sum(k[1] == g for k in first)


def test_run_rating_batch(spark, tmp_dir):
    games = spark.createDataFrame([(1,), (2,)], "id int")
    jobs.start_rating_tables(spark, spark.createDataFrame([(1, 1, 5.0)], ratings.REVIEW_ROWS), f"{tmp_dir}/r", f"{tmp_dir}/s", 2)
    batch = spark.createDataFrame([(1, 1, "7", 1, 1), (2, 2, "8", 2, 2), (2, 9, "8", 3, 3), (2, 1, "x", 4, 4)],
                                  "user_id int, id int, rating string, ts long, event_id long")
    for _ in range(2):
        jobs.run_rating_batch(spark, f"{tmp_dir}/r", f"{tmp_dir}/s", games, batch, "b", f"{tmp_dir}/rejects", 2)
    t = VersionedTable(spark, f"{tmp_dir}/r", ratings.REVIEW_ROWS, ["user_id", "id"], 2)
    assert rows(t.read()) == [(1, 1, 7.0), (2, 2, 8.0)]
    assert spark.read.parquet(f"{tmp_dir}/rejects").count() == 2
    assert versioned.COMPACT < 1
