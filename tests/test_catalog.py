from meeple.operators import catalog


def _games(spark, rows):
    return spark.createDataFrame(rows, "id int, name string, board_game_rank double, average double, usersrated double")


def test_top_ranked_nulls_last(spark):
    g = _games(spark, [(1, "a", 2.0, None, None), (2, "b", None, None, None), (3, "c", 1.0, None, None)])
    got = [(r["pos"], r["id"]) for r in catalog.top_ranked(g, 1).orderBy("pos").collect()]
    assert got == [(1, 3), (2, 1), (3, 2)]


def test_top_rated_null_order(spark):
    g = _games(spark, [(1, "a", None, 7.0, None), (2, "b", None, None, None), (3, "c", None, 8.0, None)])
    parity = [r["id"] for r in catalog.top_rated(g, 1).orderBy("pos").collect()]
    last = [r["id"] for r in catalog.top_rated(g, 1, nulls="last").orderBy("pos").collect()]
    assert parity == [2, 3, 1] and last == [3, 1, 2]


def test_page_plans_as_take_ordered(spark):
    g = _games(spark, [(i, "g", float(i), None, None) for i in range(30)])
    rows = catalog.top_ranked(g, 2)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert [r["id"] for r in rows.orderBy("pos").collect()] == list(range(10, 20))


def test_page_info(spark):
    df = spark.range(25)
    r3 = catalog.page_info(df, 3).first()
    assert (r3["pages"], r3["has_next"], r3["has_prev"]) == (3, False, True)
    r0 = catalog.page_info(df, 0).first()
    assert (r0["page"], r0["has_next"], r0["has_prev"]) == (1, True, False)


def test_search_modes(spark):
    g = _games(spark, [(1, "Catan", None, None, None), (2, "Chess", None, None, None)])
    assert catalog.search(g, "").count() == 0
    assert catalog.search(g, "c_t").count() == 0
    assert [r["id"] for r in catalog.search(g, "c_t", wildcards=True).collect()] == [1]
    assert [r["id"] for r in catalog.search(g, "CAT").collect()] == [1]
    assert catalog.search(g, "a\\b", wildcards=True).count() == 0


def test_profile_ratings_pages_and_window_group_limit(spark):
    rows = [(1, i, float(i % 10)) for i in range(12)] + [(2, 100, None), (2, 101, 3.0)]
    r = spark.createDataFrame(rows, "user_id int, id int, rating double")
    g = spark.createDataFrame([(i, f"g{i}") for i in range(12)], "id int, name string")
    p2 = catalog.profile_ratings(r, g, 2)
    got = sorted((x["user_id"], x["pos"], x["id"]) for x in p2.collect())
    # user 1 ratings sorted desc: 9(9), 8(8), 7(7), 6(6), 5(5), 4(4), 3(3), 2(2), 1(1,11), 0(0,10)
    assert got == [(1, 6, 4), (1, 7, 3), (1, 8, 2), (1, 9, 1), (1, 10, 11)]
    p1 = catalog.profile_ratings(r, g, 1).filter("user_id = 2").orderBy("pos").collect()
    assert [(x["id"], x["name"]) for x in p1] == [(100, None), (101, None)]  # null rating first
    plan = p2._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_hydrate_keeps_order_and_flags(spark):
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id int")
    recs = spark.createDataFrame([(1, [30, 10, 20]), (3, [])], "user_id int, recommendation_list array<int>")
    games = spark.createDataFrame([(10, "ten"), (30, "thirty")], "id int, name string")
    out = catalog.hydrate_recommendations(users, recs, games).collect()
    u1 = sorted((r["pos"], r["id"], r["name"]) for r in out if r["user_id"] == 1)
    assert u1 == [(1, 30, "thirty"), (2, 10, "ten"), (3, 20, None)]
    others = {r["user_id"]: r for r in out if r["user_id"] != 1}
    assert others[2]["has_recommendations"] is False and others[2]["pos"] is None
    assert others[3]["has_recommendations"] is False


def test_with_own_rating(spark):
    pairs = spark.createDataFrame([(1, None, 7), (2, 5, 7), (3, 5, 8)], "event_id int, user_id int, game_id int")
    reviews = spark.createDataFrame([(5, 7, 9.0)], "user_id int, id int, rating double")
    got = {r["event_id"]: r["rating"] for r in catalog.with_own_rating(pairs, reviews).collect()}
    assert got == {1: None, 2: 9.0, 3: None}


def test_ranking_positions_and_deep_page(spark):
    rows = [(i, "g", None, float(i % 7) if i % 5 else None, None) for i in range(200)]
    g = _games(spark, rows)
    order = catalog.ordered_by("average", True, True)
    ranked = catalog.ranking(g.select("id", "average"), order)
    got = sorted((r["pos"], r["id"]) for r in ranked.collect())
    key = lambda r: (r[3] is not None, -(r[3] or 0), r[0])
    want = [(i + 1, r[0]) for i, r in enumerate(sorted(rows, key=key))]
    assert got == want
    page = catalog.page_of_ranking(ranked, 7).orderBy("pos").collect()
    direct = catalog.top_rated(g, 7).orderBy("pos").collect()
    assert [r["id"] for r in page] == [r["id"] for r in direct]
