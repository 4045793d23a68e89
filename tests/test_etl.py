import random


from meeple import schemas
from meeple.operators import etl
from meeple.operators.dense_ids import dense_ids
from meeple.sources import files


def test_clean_reviews_drops_after_comment_is_gone(spark):
    rows = [("a", 5.0, None, 1, "g", 1), ("b", None, "x", 2, "g", 2), (None, 4.0, "y", 3, "g", 3)]
    df = spark.createDataFrame(rows, "user string, rating double, comment string, ID int, name string, pos long")
    out = etl.clean_reviews(df).collect()
    assert [(r["user"], r["ID"]) for r in out] == [("a", 1)]
    assert "comment" not in etl.clean_reviews(df).columns


def test_dense_user_ids_first_appearance(spark):
    users = ["z", "b", "z", "a", "b", "q", "c"]
    df = spark.createDataFrame([(u, i) for i, u in enumerate(users)], "user string, pos long")
    got = {r["username"]: r["user_id"] for r in etl.dense_user_ids(df, "pos").collect()}
    assert got == {"z": 0, "b": 1, "a": 2, "q": 3, "c": 4}


def test_dense_ids_are_exactly_0_to_n_minus_1_in_order(spark):
    rnd = random.Random(3)
    vals = rnd.sample(range(10_000_000), 3000)
    df = spark.createDataFrame([(v,) for v in vals], "v long")
    out = dense_ids(df, "v", "rid", partitions=7).collect()
    by_v = sorted((r["v"], r["rid"]) for r in out)
    assert [rid for _, rid in by_v] == list(range(len(vals)))


def test_dense_ids_plan_has_no_single_partition_window_over_rows(spark):
    df = spark.range(1000).withColumnRenamed("id", "v")
    out = dense_ids(df, "v", "rid", partitions=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the only SinglePartition exchange is the one over the per-bucket counts
    assert plan.count("SinglePartition") <= 1


def test_complete_games_adds_missing_ids_only(spark):
    first = spark.createDataFrame(
        [(1, "one", ["x"]), (2, "two", ["y"])], "id int, name string, category array<string>")
    second = spark.createDataFrame([(2, "TWO", 9.0), (3, "three", 3.0)], "id int, name string, board_game_rank double")
    out = {r["id"]: r for r in etl.complete_games(first, second).collect()}
    assert sorted(out) == [1, 2, 3]
    assert out[2]["name"] == "two"
    assert out[3]["category"] == [] and out[3]["board_game_rank"] == 3.0


def test_clean_games_detailed(spark):
    raw = spark.createDataFrame(
        [("0", 5, "Catan", "['Economic', 'Negotiation']", "12"),
         ("1", 6, "Chess", None, "Not Ranked")],
        "_row string, id int, primary string, boardgamecategory string, `Board Game Rank` string")
    out = {r["id"]: r for r in etl.clean_games_detailed(raw).collect()}
    assert out[5]["name"] == "Catan" and out[5]["category"] == ["Economic", "Negotiation"]
    assert out[5]["board_game_rank"] == 12.0 and out[6]["board_game_rank"] is None
    assert out[6]["category"] == []
    got = [(f.name, f.dataType) for f in etl.clean_games_detailed(raw).schema.fields]
    assert got == [(f.name, f.dataType) for f in schemas.GAMES.fields]


def test_csv_roundtrip_with_quotes_and_arrays(spark, tmp_dir):
    games = spark.createDataFrame(
        [(1, 'He said "hi", then left', ["A", "B"]), (2, None, [])],
        "id int, name string, category array<string>")
    path = f"{tmp_dir}/games_csv"
    files.write_for_bulk_load(games, path)
    target = spark.createDataFrame([], "id int, name string, category array<string>").schema
    back = {r["id"]: r for r in files.load_positional(spark, path, target).collect()}
    assert back[1]["name"] == 'He said "hi", then left'
    assert back[1]["category"] == ["A", "B"] and back[2]["category"] == []


def test_read_csv_by_position_and_null_tokens(spark, tmp_dir):
    p = f"{tmp_dir}/r.csv"
    with open(p, "w") as fh:
        fh.write(",user,rating,comment,ID,name\n0,alice,7.5,\"nice, really\",12,Catan\n1,NA,6,,13,Go\n")
    df = files.read_csv(spark, p, schemas.RAW_REVIEWS, null_tokens=("", "NA"))
    rows = df.collect()
    assert rows[0]["user"] == "alice" and rows[0]["comment"] == "nice, really" and rows[0]["ID"] == 12
    assert rows[1]["user"] is None and rows[1]["comment"] is None
    assert etl.clean_reviews(df).count() == 1


def test_dense_ids_empty_and_single(spark):
    empty = spark.createDataFrame([], "v long")
    assert dense_ids(empty, "v", "rid").count() == 0
    one = spark.createDataFrame([(42,)], "v long")
    assert [r["rid"] for r in dense_ids(one, "v", "rid", start=7).collect()] == [7]


def test_positions_spread_a_hot_leading_value(spark):
    from meeple.operators.dense_ids import global_positions
    rows = [(5, i) for i in range(1000)] + [(i, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "v long, t long")
    out = global_positions(df, ["v", "t"], "pos", partitions=6)
    sizes = out.rdd.glom().map(len).collect()
    # a third of the rows share v = 5; the full key (v, t) still splits them
    assert sum(sizes) == 3000 and max(sizes) < 1000
    got = sorted((r["v"], r["t"], r["pos"]) for r in out.collect())
    assert [p for *_, p in got] == list(range(1, 3001))
