"""F4 for many texts: equal to one search after another."""

from meeple.operators import catalog, search

NAMES = ["Ring of Fire", "ring", "Catan", "Ärger", "STRASSE 100%", "a_b", "x\\y", "", None, "aa", "Ri", "R", "日本 ゲーム",
         "The The The"]


def tables(spark, texts):
    games = spark.createDataFrame(list(enumerate(NAMES)), "id int, name string")
    return games, spark.createDataFrame([(t,) for t in texts], "text string")


def one_by_one(games, texts, wildcards):
    return sorted((t, r.id) for t in {t for t in texts if t} for r in catalog.search(games, t, wildcards).collect())


def test_equals_single_searches(spark):
    texts = ["ring", "RING", "r", "ri", "the", "The The", "an", "ärg", "100%", "a_b", "_", "%", "\\", "zzz", "zz", "z", "", None,
             "ring of fire and more", "日本", " ", "aa", "ring"]
    games, asked = tables(spark, texts)
    got = sorted((r.text, r.id) for r in search.search_many(games, asked).collect())
    assert got == one_by_one(games, texts, False)


def test_wildcards(spark):
    texts = ["r_ng", "%", "_", "__", "r%e", "100%", "a_b", "x\\y", "%%", "_ing", "t%the", "zz%", "", "____________", "R"]
    games, asked = tables(spark, texts)
    got = sorted((r.text, r.id) for r in search.search_many(games, asked, wildcards=True).collect())
    assert got == one_by_one(games, texts, True)


def test_no_nested_loop(spark):
    games, asked = tables(spark, ["ring"])
    plan = search.search_many(games, asked)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_only_texts_are_broadcast(spark, tmp_dir, monkeypatch):
    """A small file of names is many postings: neither they nor the games go to all tasks."""
    path = f"{tmp_dir}/games"
    spark.range(500).selectExpr("CAST(id AS INT) AS id", "'a name' AS name").coalesce(1).write.parquet(path)
    games = spark.read.parquet(path)
    asked = spark.createDataFrame([("name",), ("a n",)], "text string")
    for few, broadcasts in ((100_000, 1), (0, 0)):
        monkeypatch.setattr(search, "FEW_TEXTS", few, raising=False)
        out = search.search_many(games, asked)
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        assert plan.count("BroadcastExchange") == broadcasts
        assert out.count() == 1000
