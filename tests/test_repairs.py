"""Dumps read by name, array text, numbers, load checks, streams that restart."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meeple import schemas
from meeple.functions import text
from meeple.operators import quality, ratings, recommend
from meeple.operators import events as evops
from meeple.plans import jobs
from meeple.sources import files
from meeple.streaming import daily


def test_reviews_with_newlines_lose_and_invent_nothing(spark, tmp_dir):
    path = f"{tmp_dir}/r.csv"
    with open(path, "w") as f:
        f.write(',language,comment,user,rating,ID,name\n'
                '0,en,"fine\nmallory,9,3",alice,8.0,1,A\n1,de,"a ""quote""\n",bob,7.5,2,B\n2,en,,carol,6.0,1,A\n'
                '3,en,x,NA,5.0,1,A\n4,en,x,dave,NaN,1,A\n')
    raw = files.read_csv(spark, path, schemas.RAW_REVIEWS, null_tokens=text.PANDAS_NULL_TOKENS)
    got = [(r["_row"], r["user"], r["rating"], r["ID"]) for r in raw.orderBy("_row").collect()]
    assert got == [("0", "alice", 8.0, 1), ("1", "bob", 7.5, 2), ("2", "carol", 6.0, 1), ("3", None, 5.0, 1),
                   ("4", "dave", None, 1)]
    assert raw.filter("user = 'bob'").first()["comment"] == 'a "quote"\n'


def test_wide_dump_by_name(spark, tmp_dir):
    path = f"{tmp_dir}/g.csv"
    names = ["Unnamed: 0", "type", *[f.name for f in schemas.RAW_GAMES_DETAILED.fields if f.name != "_row"][::-1], "extra"]
    row = {n: "1" for n in names} | {"id": "13", "primary": "Catan", "boardgamecategory": "['Economic']", "type": "t"}
    with open(path, "w") as f:
        f.write(",".join(names) + "\n" + ",".join(row[n] for n in names) + "\n")
    got = files.read_csv(spark, path, schemas.RAW_GAMES_DETAILED).first()
    assert (got["id"], got["primary"], got["boardgamecategory"]) == (13, "Catan", "['Economic']")
    with open(path, "w") as f:
        f.write("id,primary\n1,x\n")
    with pytest.raises(ValueError, match="not found"):
        files.read_csv(spark, path, schemas.RAW_GAMES_DETAILED)


def test_array_text_round_trip(spark, tmp_dir):
    hard = [["A, B", 'C"D', "{x}"], [], ["", " pad ", "null", None, "NULL", "a\\b", "\\"], ["plain", "two words"], None]
    kind = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("c", T.ArrayType(T.StringType()))])
    df = spark.createDataFrame(list(enumerate(hard)), kind)
    files.write_for_bulk_load(df, f"{tmp_dir}/b")
    back = files.load_positional(spark, f"{tmp_dir}/b", kind)
    assert [r["c"] for r in back.orderBy("id").collect()] == hard


def test_numbers(spark):
    texts = ["12", " -1.5e2 ", ".5", "5.", "12d", "7f", "NaN", "Infinity", "-inf", "0x10", "", "1e999", None, "1_000"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["n"] for r in df.select("i", text.to_number("t").alias("n")).orderBy("i").collect()]
    assert got == [12.0, -150.0, 0.5, 5.0] + [None] * 10


def test_bounds_and_nan_are_rejected(spark):
    games = spark.createDataFrame([(1,)], "id int")
    batch = spark.createDataFrame([(1, 1, 5.0), (2, 1, float("nan")), (3, 1, 999.0), (4, 2, 5.0), (5, None, 5.0)],
                                  "user_id int, id int, rating double")
    ok, bad = ratings.split_known_games(batch, games, bounds=(1, 10))
    assert [r.user_id for r in ok.collect()] == [1]
    assert sorted(r.user_id for r in bad.collect()) == [2, 3, 4, 5]


def test_first_user_of_an_empty_table(spark):
    users = spark.createDataFrame([], "user_id int, username string, email string")
    batch = spark.createDataFrame([(9, "a", "a@x"), (4, "b", "b@x")], "event_id int, username string, email string")
    got = ratings.register_users(users, batch).collect()
    assert sorted((r.user_id, r.username) for r in got) == [(1, "b"), (2, "a")]


def test_load_checks_repair(spark, tmp_dir):
    spark.createDataFrame([(1.0, 1, 1), (2.0, 1, 1), (3.0, 1, 2), (4.0, 9, 2)], "rating double, id int, user_id int") \
        .write.parquet(f"{tmp_dir}/reviews")
    spark.createDataFrame([(1, "g")], "id int, name string").write.parquet(f"{tmp_dir}/games")
    out = jobs.run_load_checks(spark, {n: f"{tmp_dir}/{n}" for n in ("reviews", "games")}, f"{tmp_dir}/out")
    assert out["violations"] == {"reviews(id,user_id) unique": 1, "reviews.id -> games.id": 1}
    fixed = spark.read.parquet(out["reviews"])
    assert sorted(map(tuple, fixed.collect())) == [(2.0, 1, 1), (3.0, 1, 2), (4.0, 9, 2)]
    assert fixed.columns == ["rating", "id", "user_id"]
    assert quality.duplicate_keys(fixed, ["id", "user_id"]).count() == 0
    # the merge job repairs by itself unless told that pairs are unique
    batch = spark.createDataFrame([(2, 1, "7", 1, 1)], "user_id int, id int, rating string, ts int, event_id int")
    games = spark.createDataFrame([(1, "g", None, None)], "id int, name string, average double, usersrated double")
    games.write.parquet(f"{tmp_dir}/games2")
    res = jobs.run_rating_merge(spark, f"{tmp_dir}/reviews", f"{tmp_dir}/games2", batch, f"{tmp_dir}/merged")
    assert quality.duplicate_keys(spark.read.parquet(res["reviews"]), ["id", "user_id"]).count() == 0


def test_same_lists_on_any_number_of_cores(spark):
    rows = [(u, i, float((u * 7 + i * 3) % 10 + 1)) for u in range(60) for i in range(25) if (u + i) % 3]
    params = recommend.AlsParams(min_reviews=5, max_iter=4, blocks=3)
    df = spark.createDataFrame(rows, "user_id int, id int, rating double")
    got = []
    for parts in (1, 7):  # other task counts, other row order
        data = df.repartition(parts)
        train, test = recommend.split(data, params)
        model = recommend.fit(train.orderBy("user_id", "id").coalesce(parts), params)
        assert len({r.user_id for r in train.collect()}) > 50
        got.append((round(recommend.rmse(model, test).first()["rmse"], 4),
                    sorted((r.user_id, r.pos, r.game_id) for r in recommend.candidates(model, 5).collect() if r.pos == 1)))
    assert got[0] == got[1]
    assert recommend.AlsParams().blocks == 10 and recommend.AlsParams().split_mode == "hash"


def _messages(spark, path, rows):
    spark.createDataFrame(rows, "key string, value string, timestamp timestamp").coalesce(1).write.mode("append").parquet(path)


def test_stream_restarts_on_its_checkpoint(spark, tmp_dir):
    import datetime as dt
    view = lambda g, day: ("1", json.dumps({"event": "game_viewed", "user_id": 1, "game_id": g}),
                           dt.datetime(2024, 1, day, 12))
    src, out, ck = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    _messages(spark, src, [view(1, 1), view(1, 1), view("2", 1), ("x", "not json", dt.datetime(2024, 1, 1))])

    def run():
        m = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
        main, dead = jobs.run_daily_stream(m, out, ck, available_now=True)
        main.awaitTermination()
        dead.awaitTermination()
        return main
    run()
    for day in (2, 3, 4, 5):
        _messages(spark, src, [view(1, day)] * day)
        last = run()
    # a row behind the watermark is dropped and counted
    _messages(spark, src, [view(1, 1), view(1, 6)])
    last = run()
    got = {(r.date, r.key): r.n for r in daily.read_counts(spark, f"{out}/daily_counts").collect()}
    assert got[("2024-01-01", "1")] == 2 and got[("2024-01-01", "2")] == 1
    assert got[("2024-01-02", "1")] == 2 and got[("2024-01-03", "1")] == 3
    assert daily.late_rows(last) >= 1
    assert [r.value for r in spark.read.parquet(f"{out}/dead_letters").collect()] == ["not json"]
    assert ("2024-01-06", "1") not in got
    daily.flush_open_days(spark.read.parquet(src), f"{out}/daily_counts", f"{out}/daily_reports")
    got = {(str(r.date), r.key): r.n for r in daily.read_counts(spark, f"{out}/daily_counts").collect()}
    assert got[("2024-01-06", "1")] == 1 and got[("2024-01-05", "1")] == 5 and got[("2024-01-01", "1")] == 2


def test_day_is_not_one_task(spark, tmp_dir):
    counts = spark.range(4000).select(F.lit("2024-01-01").alias("date"), F.lit("game_viewed").alias("kind"),
                                      F.col("id").cast("string").alias("key"), F.lit(1).cast("long").alias("n"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        daily.write_daily(counts, 0, f"{tmp_dir}/c", f"{tmp_dir}/r")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert daily.read_counts(spark, f"{tmp_dir}/c").count() == 4000
    assert daily.read_counts(spark, f"{tmp_dir}/c").select(F.input_file_name()).distinct().count() > 1
    assert evops.counts_summary(counts).first()["n_games"] == 4000
    assert daily.read_counts(spark, f"{tmp_dir}/nowhere").count() == 0
