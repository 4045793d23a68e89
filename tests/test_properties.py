"""Property tests (small frames, few examples: each example is a Spark job)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from meeple.operators import etl, ratings

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
T0 = dt.datetime(2024, 1, 1)

keys = st.tuples(st.integers(0, 3), st.integers(0, 3))


@SETTINGS
@given(base=st.dictionaries(keys, st.integers(1, 10), max_size=8),
       batch=st.lists(st.tuples(keys, st.integers(1, 10)), max_size=10))
def test_upsert_is_idempotent_and_last_wins(spark, base, batch):
    b = spark.createDataFrame([(float(r), k[1], k[0]) for k, r in base.items()],
                              "rating double, id int, user_id int")
    n = spark.createDataFrame([(k[0], k[1], float(r), T0, i) for i, (k, r) in enumerate(batch)],
                              "user_id int, id int, rating double, ts timestamp, event_id long")
    once = ratings.upsert_ratings(b, n)
    twice = ratings.upsert_ratings(once, n)
    agg = ratings.upsert_ratings(b, n, base_unique=False)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, agg.select(*once.columns).collect()))
    got = {(r["user_id"], r["id"]): r["rating"] for r in once.collect()}
    assert got == {(r["user_id"], r["id"]): r["rating"] for r in twice.collect()}
    want = dict(base)
    for k, r in batch:
        want[k] = r
    assert got == {k: float(v) for k, v in want.items()}


@SETTINGS
@given(users=st.lists(st.sampled_from("abcdefghij"), min_size=1, max_size=30))
def test_dense_ids_follow_first_appearance(spark, users):
    df = spark.createDataFrame([(u, i) for i, u in enumerate(users)], "user string, pos long")
    got = {r["username"]: r["user_id"] for r in etl.dense_user_ids(df, "pos").collect()}
    order = list(dict.fromkeys(users))
    assert got == {u: i for i, u in enumerate(order)}


@SETTINGS
@given(a=st.sets(st.integers(0, 20), max_size=10), b=st.sets(st.integers(0, 20), max_size=10))
def test_completed_ids_unique_and_union(spark, a, b):
    first = spark.createDataFrame([(i, "x", ["c"]) for i in a], "id int, name string, category array<string>")
    second = spark.createDataFrame([(i, "y", 1.0) for i in b], "id int, name string, board_game_rank double")
    ids = [r["id"] for r in etl.complete_games(first, second).collect()]
    assert len(ids) == len(set(ids)) and set(ids) == a | b


@SETTINGS
@given(left=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.integers(0, 3))),
                     max_size=15),
       right=st.sets(st.tuples(st.integers(0, 4), st.integers(0, 3)), max_size=8),
       how=st.sampled_from(["left", "left_semi", "left_anti"]))
def test_spreading_nulls_equals_plain_join(spark, left, right, how):
    from meeple.operators.joins import join_spreading_nulls
    l_df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(left)], "rid int, a int, b int")
    r_df = spark.createDataFrame([(a, b, a * 10 + b) for a, b in right], "a int, b int, v int")
    plain = l_df.join(r_df, ["a", "b"], how)
    spread = join_spreading_nulls(l_df, r_df, ["a", "b"], how)
    assert spread.columns == plain.columns
    assert sorted(map(tuple, spread.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
