"""Plan properties the scale design relies on."""

from meeple.operators import quality, ratings, recommend
from meeple.plans import catalogue

from conftest import SF_SMALL


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _before_first_exchange(plan: str) -> str:
    # the tree string lists the root first; text after the last Exchange line
    # is the map side of the deepest shuffle
    return plan.split("Exchange")[-1]


def test_upsert_combines_map_side(spark):
    base = spark.range(2000).selectExpr("1.0 AS rating", "CAST(id % 3 AS INT) AS id", "1 AS user_id")
    batch = spark.range(2000).selectExpr("1 AS user_id", "0 AS id", "2.0 AS rating",
                                         "TIMESTAMP'2024-01-01 00:00:00' AS ts", "id AS event_id")
    plan = _plan(ratings.upsert_ratings(base, batch))
    assert "partial_max_by" in plan
    # the base table is only scanned and anti-joined against the batch keys
    assert "LeftAnti" in plan


def test_duplicate_and_popularity_counts_combine_map_side(spark):
    df = spark.range(5000).selectExpr("CAST(id % 2 AS INT) AS id", "1.0 AS rating", "1 AS user_id")
    assert "partial_count" in _plan(quality.duplicate_keys(df, ["user_id", "id"]))
    assert "partial_count" in _plan(recommend.popular_games(df, 10))


def test_search_reads_two_columns_with_pushed_filter(spark):
    df = catalogue.search_games(spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in plan
    assert "PushedFilters: [IsNotNull(p_name)" in plan


def test_profile_page_limits_before_shuffle(spark):
    plan = _plan(catalogue.profile_ratings(spark, SF_SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_ranking_has_no_single_partition_over_rows(spark):
    df = catalogue.rated_ranking(spark, SF_SMALL)
    plan = _plan(df)
    # checkpointed rows are joined to a broadcast table of partition offsets
    assert "BroadcastHashJoin" in plan
    final = plan.split("== Initial Plan ==")[0]
    # the only single-partition exchange carries the per-partition counts
    assert final.count("SinglePartition") <= 1
