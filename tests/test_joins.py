from meeple.operators.joins import join_spreading_nulls


def test_left_join_keeps_null_keys_and_columns(spark):
    left = spark.createDataFrame([(1, None, 7), (2, 5, 7), (3, 5, None), (4, 6, 8)],
                                 "event_id int, user_id int, game_id int")
    right = spark.createDataFrame([(5, 7, 9.0), (6, 8, 1.0)], "user_id int, game_id int, rating double")
    out = join_spreading_nulls(left, right, ["user_id", "game_id"], "left")
    assert out.columns == left.join(right, ["user_id", "game_id"], "left").columns
    got = {r["event_id"]: (r["user_id"], r["rating"]) for r in out.collect()}
    assert got == {1: (None, None), 2: (5, 9.0), 3: (5, None), 4: (6, 1.0)}


def test_semi_and_anti(spark):
    left = spark.createDataFrame([(1, 10), (2, None), (3, 11)], "rid int, id int")
    right = spark.createDataFrame([(10,)], "id int")
    assert [r["rid"] for r in join_spreading_nulls(left, right, ["id"], "left_semi").collect()] == [1]
    assert sorted(r["rid"] for r in join_spreading_nulls(left, right, ["id"], "left_anti").collect()) == [2, 3]


def test_null_keys_spread_over_partitions(spark):
    # a shuffled join with partition sizes left as they are
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        # null for every row, but not a constant the optimizer could fold
        left = spark.range(4000).selectExpr("id AS event_id",
                                            "CASE WHEN id < 0 THEN CAST(id AS INT) END AS user_id")
        right = spark.createDataFrame([(1, 2.0)], "user_id int, rating double")
        plain = left.join(right, ["user_id"], "left").rdd.glom().map(len).collect()
        spread = join_spreading_nulls(left, right, ["user_id"], "left").rdd.glom().map(len).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert max(plain) == 4000
    assert sum(spread) == 4000 and max(spread) < 1500


def test_long_and_string_keys(spark):
    left = spark.createDataFrame([(1, None), (2, 5), (3, 7)], "rid int, k long")
    right = spark.createDataFrame([(5, "a")], "k long, v string")
    got = {r["rid"]: r["v"] for r in join_spreading_nulls(left, right, ["k"], "left").collect()}
    assert got == {1: None, 2: "a", 3: None}
