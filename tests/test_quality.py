from meeple.operators import quality


def test_duplicates_ignore_null_keys(spark):
    u = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "user_id int, email string")
    assert [(r["email"], r["n"]) for r in quality.duplicate_keys(u, ["email"]).collect()] == [("a", 2)]
    assert quality.duplicate_keys(u, ["user_id"]).count() == 0


def test_orphans(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, 11), (4, None)], "rid int, id int")
    parent = spark.createDataFrame([(10,)], "id int")
    got = [(r["id"], r["n"]) for r in quality.orphan_counts(child, "id", parent, "id").collect()]
    assert got == [(11, 2)]
