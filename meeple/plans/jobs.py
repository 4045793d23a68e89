"""End-to-end jobs: what a deployment schedules.

* ``run_etl``            raw CSV dumps -> games, users, reviews tables (Parquet)
* ``run_recommendations`` reviews -> ALS -> top-5 popular lists -> sink (S5/U4)
* ``run_rating_merge``   a batch of submitted ratings -> new reviews and games
                         table versions (U1, U2; never overwrites what it reads)
* ``run_rating_batch``   the same into versioned tables: a batch writes its own rows only
* ``run_load_checks``    constraint violations, and reviews repaired of duplicates
* ``run_daily_stream``   event messages -> daily counts, daily documents, dead letters
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meeple import schemas
from meeple.functions import text
from meeple.operators import etl, quality, ratings, recommend
from meeple.operators import events as evops
from meeple.session import checkpoint_dir, scratch_path
from meeple.sources import files, jdbc
from meeple.sources.versioned import VersionedTable
from meeple.streaming import daily


@dataclass
class EtlOutput:
    games: str
    users: str
    reviews: str


def run_etl(spark: SparkSession, detailed_csv: str, list_csv: str, reviews_csv: str,
            out_dir: str, null_tokens=text.PANDAS_NULL_TOKENS,
            reviews_buckets: int | None = None, reviews_table: str = "reviews") -> EtlOutput:
    """Catalogue + review ETL to Parquet.

    Dumps are read by column name, with quoted newlines kept and the null tokens
    of pandas, in as many tasks as the files have splits. The reviews are landed as
    Parquet once and every later step reads that.

    The file position of a review is the dump's own row number column when
    it has one; otherwise its place in the file as the reader counts it. With ``reviews_buckets`` the
    reviews are also registered as table ``reviews_table``, bucketed by
    user_id over the same folder, so per-user reads skip their shuffle.
    """
    raw1 = files.read_csv(spark, detailed_csv, schemas.RAW_GAMES_DETAILED, null_tokens=null_tokens)
    raw2 = files.read_csv(spark, list_csv, schemas.RAW_GAMES_LIST, null_tokens=null_tokens)
    games = etl.complete_games(etl.clean_games_detailed(raw1), etl.clean_games_list(raw2))

    raw_r = files.read_csv(spark, reviews_csv, schemas.RAW_REVIEWS, null_tokens=null_tokens, position="_place")
    pos = F.coalesce(F.col("_row").try_cast("long"), F.col("_place") + F.lit(1 << 62))
    raw_r = files.land(raw_r.withColumn("_pos", pos).drop("_row", "_place"), "raw-reviews")
    clean = etl.clean_reviews(raw_r, tokens=null_tokens)
    ids = etl.dense_user_ids(clean, "_pos")
    reviews = etl.reviews_table(etl.attach_user_ids(clean, ids))
    users = etl.users_table(ids)

    out = EtlOutput(f"{out_dir}/games", f"{out_dir}/users", f"{out_dir}/reviews")
    files.write_table(games, out.games)
    files.write_table(users, out.users)
    if reviews_buckets:
        # rows are dealt by the bucket key first: one file per bucket, not per task and bucket
        (reviews.repartition(reviews_buckets, "user_id").write.mode("overwrite").bucketBy(reviews_buckets, "user_id").sortBy("user_id")
         .option("path", out.reviews).saveAsTable(reviews_table))
    else:
        files.write_table(reviews, out.reviews)
    return out


def run_recommendations(spark: SparkSession, reviews: DataFrame,
                        params: recommend.AlsParams = recommend.AlsParams(), *,
                        parquet_path: str | None = None, jdbc_url: str | None = None,
                        jdbc_table: str = "recommendations", jdbc_props: dict | None = None,
                        long_form: bool = False) -> dict:
    """M6 + S5: train, evaluate, publish. Returns {'rmse': float, 'users': int}.

    The list table is replaced as a whole (U4). JDBC targets without array
    columns take the long form (user_id, pos, game_id). Users and games are
    scored against each other once: the lists are written (to the shared scratch
    folder without a ``parquet_path``) and every other step reads them back.
    """
    res = recommend.recommend(reviews, params)
    recs = res.recommendations
    path = parquet_path or scratch_path(spark, "recommendations")
    files.write_table(recommend.lists_long(recs) if long_form else recs, path)
    rmse = res.rmse.first()["rmse"]
    res.release()
    out = spark.read.parquet(path)
    if jdbc_url:
        jdbc.write_replace(out, jdbc_url, jdbc_table, jdbc_props)
    published = out.select("user_id").distinct().count()
    return {"rmse": rmse, "users": published}


def run_rating_merge(spark: SparkSession, reviews_path: str, games_path: str, batch: DataFrame,
                     out_dir: str, mode: str = "parity", base_unique: bool = False,
                     bounds: tuple[float, float] | None = None) -> dict:
    """U1 + U2 (+F8): merged reviews and refreshed games as new table versions.

    Rejected rows (unknown game, rating not a number or out of ``bounds``) go to
    ``rejects``. ``base_unique=True`` skips the repair of duplicate (user, game)
    pairs in the table; set it when ``run_load_checks`` has found or left none.
    The inputs are read, the outputs written to ``out_dir``; the caller
    swaps table pointers afterwards.
    """
    checkpoint_dir(spark)
    base = spark.read.parquet(reviews_path)
    games = spark.read.parquet(games_path)
    accepted, rejected = ratings.split_known_games(batch, games, bounds=bounds)
    # read three times below: pin it once (batch-sized, reliable checkpoint)
    accepted = accepted.checkpoint(eager=True)
    merged = ratings.upsert_ratings(base, accepted, base_unique=base_unique)
    files.write_table(merged, f"{out_dir}/reviews")
    merged_back = spark.read.parquet(f"{out_dir}/reviews")
    refreshed = ratings.refresh_game_stats(games, merged_back, accepted, base, mode)
    files.write_table(refreshed, f"{out_dir}/games")
    files.write_table(rejected, f"{out_dir}/rejects")
    return {"reviews": f"{out_dir}/reviews", "games": f"{out_dir}/games",
            "rejects": f"{out_dir}/rejects"}


def run_rating_batch(spark: SparkSession, reviews_path: str, stats_path: str, games: DataFrame, batch: DataFrame,
                     batch_id: str, rejects_path: str, buckets: int = 64,
                     bounds: tuple[float, float] | None = None) -> None:
    """U1 + U2 (+F8) into versioned tables: only the buckets and files that the batch
    touches are read and written, and a batch that comes again changes nothing.
    ``start_rating_tables`` makes the tables. Rejected rows go to ``rejects_path``."""
    checkpoint_dir(spark)
    accepted, rejected = ratings.split_known_games(batch, games, bounds=bounds)
    reviews = VersionedTable(spark, reviews_path, ratings.REVIEW_ROWS, ["user_id", "id"], buckets)
    stats = VersionedTable(spark, stats_path, ratings.STATS_ROWS, ["id"], buckets)
    ratings.merge_ratings(reviews, stats, accepted, batch_id)
    files.write_table(rejected, f"{rejects_path}/batch={batch_id}")


def start_rating_tables(spark: SparkSession, reviews: DataFrame, reviews_path: str, stats_path: str,
                        buckets: int = 64) -> tuple[VersionedTable, VersionedTable]:
    """The versioned tables of reviews (one row per user and game) and their statistics."""
    table = VersionedTable(spark, reviews_path, ratings.REVIEW_ROWS, ["user_id", "id"], buckets)
    table.merge(reviews.select("user_id", "id", "rating"), "start")
    stats = VersionedTable(spark, stats_path, ratings.STATS_ROWS, ["id"], buckets)
    stats.merge(ratings.stats_rows(table.read()), "start")
    return table, stats


def run_daily_stream(messages: DataFrame, out_dir: str, checkpoint: str,
                     available_now: bool = False, watermark: str = daily.WATERMARK):
    """ST1-ST5 + S8: daily counts and daily documents from one message stream.

    ``messages`` is a streaming frame with key, value, timestamp (the Kafka
    source of ``meeple.sources.kafka.read_events`` or a file stream). One
    stateful query writes counts and documents; a second, stateless one writes the
    messages that cannot be counted to ``dead_letters``. Both are returned
    started, with their own checkpoints; ``daily.late_rows`` of the first tells
    how many rows came too late.
    """
    parsed = evops.parse_messages(messages)
    counts = daily.daily_counts_stream(parsed, watermark)
    dead = daily.start_dead_letter_sink(parsed, f"{out_dir}/dead_letters", f"{checkpoint}/dead_letters",
                                        available_now=available_now)
    return daily.start_daily_sinks(counts, f"{out_dir}/daily_counts", f"{out_dir}/daily_reports",
                                   f"{checkpoint}/daily", available_now=available_now), dead


def run_load_checks(spark: SparkSession, tables: dict[str, str], out_dir: str) -> dict:
    """Q1 + Q2 before a load: ``tables`` maps users / games / reviews /
    recommendations to their Parquet folders.

    Violations go to ``out_dir/violations``. Reviews with duplicate (user, game)
    pairs are written repaired (one row per pair, the highest rating) to
    ``out_dir/reviews``. Returns the number of violations per check and where the
    reviews to load are.
    """
    frames = {n: spark.read.parquet(p) for n, p in tables.items()}
    files.write_table(quality.constraint_report(frames), f"{out_dir}/violations")
    found = {r["check"]: r["count"] for r in
             spark.read.parquet(f"{out_dir}/violations").groupBy("check").count().collect()}
    reviews = tables.get("reviews")
    if any(c.startswith("reviews(") for c in found):
        fixed = quality.drop_duplicate_keys(frames["reviews"], ["user_id", "id"], ["rating"])
        reviews = f"{out_dir}/reviews"
        files.write_table(fixed, reviews)
    return {"violations": found, "reviews": reviews}
