import datetime as dt

from meeple.operators import ratings

T0 = dt.datetime(2024, 1, 1)


import pytest


@pytest.mark.parametrize("base_unique", [True, False])
def test_upsert_last_write_wins_and_is_idempotent(spark, base_unique):
    base = spark.createDataFrame([(5.0, 1, 1), (3.0, 2, 1)], "rating double, id int, user_id int")
    batch = spark.createDataFrame([(1, 1, 7.0, T0, 1), (1, 1, 6.0, T0 + dt.timedelta(1), 2)],
                                  "user_id int, id int, rating double, ts timestamp, event_id long")
    once = ratings.upsert_ratings(base, batch, base_unique=base_unique)
    got = sorted((r["user_id"], r["id"], r["rating"]) for r in once.collect())
    assert got == [(1, 1, 6.0), (1, 2, 3.0)]
    twice = ratings.upsert_ratings(once, batch, base_unique=base_unique)
    assert sorted((r["user_id"], r["id"], r["rating"]) for r in twice.collect()) == got


def test_upsert_repairs_duplicate_base_keys_when_not_unique(spark):
    base = spark.createDataFrame([(5.0, 1, 1), (4.0, 1, 1)], "rating double, id int, user_id int")
    batch = spark.createDataFrame([], "user_id int, id int, rating double, ts timestamp, event_id long")
    assert ratings.upsert_ratings(base, batch, base_unique=False).count() == 1


def test_refresh_stats_parity_and_corrected(spark):
    games = spark.createDataFrame([(1, 5.0, 10.0), (2, 3.0, None)], "id int, average double, usersrated double")
    base = spark.createDataFrame([(4.0, 1, 9)], "rating double, id int, user_id int")
    batch = spark.createDataFrame([(1, 1, 8.0, T0, 1), (1, 1, 6.0, T0, 2)],
                                  "user_id int, id int, rating double, ts timestamp, event_id long")
    merged = ratings.upsert_ratings(base, batch)
    par = {r["id"]: r for r in ratings.refresh_game_stats(games, merged, batch).collect()}
    assert par[1]["usersrated"] == 12.0 and par[1]["average"] == 5.0  # mean(4, 6)
    assert par[2]["usersrated"] is None and par[2]["average"] == 3.0
    cor = {r["id"]: r for r in ratings.refresh_game_stats(games, merged, batch, base, "corrected").collect()}
    assert cor[1]["usersrated"] == 11.0


def test_refresh_null_start_counts_as_zero(spark):
    games = spark.createDataFrame([(2, None, None)], "id int, average double, usersrated double")
    batch = spark.createDataFrame([(1, 2, 8.0, T0, 1)], "user_id int, id int, rating double, ts timestamp, event_id long")
    merged = ratings.upsert_ratings(spark.createDataFrame([], "rating double, id int, user_id int"), batch)
    r = ratings.refresh_game_stats(games, merged, batch).first()
    assert r["usersrated"] == 1.0 and r["average"] == 8.0


def test_register_users(spark):
    existing = spark.createDataFrame([(4, "old", "a@x"), (7, "older", None)], "user_id int, username string, email string")
    batch = spark.createDataFrame([(10, "dup", "a@x"), (11, "new1", "b@x"), (12, "new2", "b@x"), (13, "c", "c@x")],
                                  "event_id long, username string, email string")
    out = sorted((r["user_id"], r["username"], r["email"]) for r in ratings.register_users(existing, batch).collect())
    assert out == [(8, "new1", "b@x"), (9, "c", "c@x")]


def test_split_known_games(spark):
    games = spark.createDataFrame([(1,)], "id int")
    batch = spark.createDataFrame([(1, 1, "7"), (1, 2, "8"), (1, 1, "oops")], "user_id int, id int, rating string")
    ok, bad = ratings.split_known_games(batch, games)
    assert [(r["id"], r["rating"]) for r in ok.collect()] == [(1, 7.0)]
    assert bad.count() == 2
