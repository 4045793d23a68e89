"""End-to-end jobs on CSV dumps made from the sf0.001 fixtures."""

from pyspark.sql import functions as F

from meeple import schemas
from meeple.operators import recommend
from meeple.plans import catalogue, jobs
from meeple.plans import fixtures as fx

from conftest import SF_SMALL


def _dump(df, schema, path):
    cols = [(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast("string").alias(f.name)
            for f in schema.fields]
    df.select(*cols).coalesce(1).write.option("header", "true").option("escape", '"').csv(path)


def test_etl_job_matches_catalogue_queries(spark, tmp_dir):
    det = catalogue._raw_detailed(spark, SF_SMALL).withColumn("_row", F.col("id"))
    lst = catalogue._raw_list(spark, SF_SMALL).withColumn("_row", F.col("ID"))
    rev = (catalogue._raw_reviews(spark, SF_SMALL).withColumn("_row", F.col("pos"))
           .withColumn("name", F.lit("game")).orderBy("pos"))
    _dump(det, schemas.RAW_GAMES_DETAILED, f"{tmp_dir}/det")
    _dump(lst, schemas.RAW_GAMES_LIST, f"{tmp_dir}/lst")
    _dump(rev, schemas.RAW_REVIEWS, f"{tmp_dir}/rev")
    out = jobs.run_etl(spark, f"{tmp_dir}/det", f"{tmp_dir}/lst", f"{tmp_dir}/rev", f"{tmp_dir}/out",
                       reviews_buckets=4, reviews_table="etl_test_reviews")

    users = {(r["user_id"], r["username"]) for r in spark.read.parquet(out.users).collect()}
    want = {(r["user_id"], r["username"]) for r in catalogue.users_dense_ids(spark, SF_SMALL).collect()}
    assert users == want
    games = spark.read.parquet(out.games)
    got = sorted((r["id"], r["name"], r["board_game_rank"], tuple(r["category"])) for r in games.collect())
    exp = sorted((r["id"], r["name"], r["board_game_rank"],
                  tuple(r["category_text"].split("|")) if r["category_text"] else ())
                 for r in catalogue.games_completed(spark, SF_SMALL).collect())
    assert got == exp
    reviews = spark.table("etl_test_reviews")
    assert reviews.count() == catalogue.reviews_dense(spark, SF_SMALL).count()
    per_user = reviews.groupBy("user_id").count()
    per_user.collect()
    assert "Exchange" not in per_user._jdf.queryExecution().executedPlan().toString()


def test_rating_merge_job(spark, tmp_dir):
    fx.reviews(spark, SF_SMALL).write.parquet(f"{tmp_dir}/reviews")
    fx.games(spark, SF_SMALL).write.parquet(f"{tmp_dir}/games")
    batch = fx.rating_batch(spark, SF_SMALL)
    out = jobs.run_rating_merge(spark, f"{tmp_dir}/reviews", f"{tmp_dir}/games", batch, f"{tmp_dir}/v2")
    merged = {(r["user_id"], r["id"]): r["rating"] for r in spark.read.parquet(out["reviews"]).collect()}
    want = {(r["user_id"], r["id"]): r["rating"] for r in catalogue.reviews_upserted(spark, SF_SMALL).collect()}
    assert merged == want
    g = {r["id"]: (r["average"], r["usersrated"]) for r in spark.read.parquet(out["games"]).collect()}
    w = {r["id"]: (r["average"], r["usersrated"]) for r in catalogue.game_stats_refreshed(spark, SF_SMALL).collect()}
    assert g == w


def test_recommendation_job_long_form(spark, tmp_dir):
    params = recommend.AlsParams(min_reviews=25, max_iter=3)
    res = jobs.run_recommendations(spark, fx.reviews(spark, SF_SMALL), params,
                                   parquet_path=f"{tmp_dir}/recs", long_form=True)
    long = spark.read.parquet(f"{tmp_dir}/recs")
    assert long.columns == ["user_id", "pos", "game_id"]
    assert res["users"] > 0 and res["rmse"] > 0
    assert long.groupBy("user_id").agg(F.max("pos").alias("m")).filter("m > 5").count() == 0


def test_daily_stream_job_equals_batch(spark, tmp_dir):
    from meeple.streaming import daily
    stream = daily.event_file_stream(spark, SF_SMALL)
    msgs = fx.event_messages(stream)
    q, dead = jobs.run_daily_stream(msgs, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", available_now=True,
                              watermark="0 seconds")
    q.awaitTermination()
    got = {(str(r["date"]), r["kind"], r["key"], r["n"]) for r in spark.read.parquet(f"{tmp_dir}/out/daily_counts").collect()}
    from meeple.operators import events as evops
    batch = evops.daily_counts(evops.parse_messages(catalogue._messages(spark, SF_SMALL)))
    last_day = max(r["date"] for r in batch.collect())
    want = {(r["date"], r["kind"], r["key"], r["n"]) for r in batch.collect() if r["date"] < last_day}
    assert got == want
    docs = spark.read.text(f"{tmp_dir}/out/daily_reports").count()
    assert docs == len({d for d, *_ in want})


def test_load_tables_reads_back_and_unloads(spark):
    loaded = fx.load_tables(spark, SF_SMALL)
    try:
        assert fx.reviews(spark, SF_SMALL).count() == fx._reviews(spark, SF_SMALL).count()
        plan_src = fx.reviews(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "lineitem" not in plan_src
    finally:
        fx.unload_tables(spark, SF_SMALL)
    names = [ref for kind, ref in loaded.values() if kind == "table"]
    assert names and not any(spark.catalog.tableExists(n) for n in names)
    assert "lineitem" in fx.reviews(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
