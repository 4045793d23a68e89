"""Table changes re-aimed as batch merges.

The reference changes one row per web request inside a database
transaction. Here a batch of requests is merged into the tables at once:
last write wins per key, statistics are refreshed only for touched games,
and new users get consecutive ids after the current maximum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meeple.functions import events as ev
from meeple.functions import text
from meeple.operators.dense_ids import dense_ids
from meeple.operators.joins import join_spreading_nulls
from meeple.sources.versioned import VersionedTable


def split_known_games(batch: DataFrame, games: DataFrame, game_col: str = "id",
                      rating_col: str | None = "rating",
                      bounds: tuple[float, float] | None = None) -> tuple[DataFrame, DataFrame]:
    """F8 + E10: (accepted, rejected) rows of a rating batch.

    A row is rejected when its game does not exist (the reference answers
    404), its rating text is not a finite number, or the number is outside
    ``bounds`` (the reference's form allows 1 to 10, its server any number). Semi/anti joins on the game key;
    Spark broadcasts the games side when AQE measures it small.
    """
    if rating_col is not None:
        batch = batch.withColumn(rating_col, text.to_number(F.col(rating_col).cast("string")))
    ids = games.select(F.col("id").alias(game_col))
    known = join_spreading_nulls(batch, ids, [game_col], "left_semi")
    unknown = join_spreading_nulls(batch, ids, [game_col], "left_anti")
    if rating_col is not None:
        bad = F.col(rating_col).isNull()
        if bounds is not None:
            bad = bad | ~F.col(rating_col).between(*bounds)
        return known.filter(~bad), unknown.unionByName(known.filter(bad))
    return known, unknown


def upsert_ratings(base: DataFrame, batch: DataFrame,
                   order_cols: Sequence[str] = ("ts", "event_id"),
                   keys: Sequence[str] = ("user_id", "id"),
                   base_unique: bool = True) -> DataFrame:
    """Reviews after applying the batch, last write per (user_id, id) wins.

    Base rows come before every batch row; inside the batch ``order_cols``
    decide. ``max_by`` over the ordering struct is combined map-side, so a
    key repeated a million times is reduced before the shuffle.

    With ``base_unique`` (the table's primary key holds) only the batch is
    aggregated: base rows whose key the batch touches are dropped by an
    anti join against the batch keys and the latest batch rows are appended.
    While AQE finds the batch keys small enough to broadcast, the large table is
    scanned once and neither shuffled nor sorted; a larger batch makes it a
    shuffle join of both. Otherwise base and batch are unioned
    and reduced together, which also removes duplicate base keys.
    """
    if base_unique:
        latest = (batch.groupBy(*keys)
                  .agg(F.max_by(F.col("rating").cast("double"),
                                F.struct(*[F.col(c) for c in order_cols])).alias("rating")))
        kept = base.select("rating", *keys).join(latest.select(*keys), list(keys), "left_anti")
        return kept.unionByName(latest.select("rating", *keys))
    first = batch.select(*[F.col(c) for c in order_cols])
    null_order = [F.lit(None).cast(f.dataType).alias(f.name) for f in first.schema.fields]
    b = base.select(*keys, "rating",
                    F.struct(F.lit(0).alias("_src"), *null_order).alias("_ord"))
    n = batch.select(*keys, F.col("rating").cast("double"),
                     F.struct(F.lit(1).alias("_src"), *[F.col(c) for c in order_cols]).alias("_ord"))
    merged = b.unionByName(n)
    return (merged.groupBy(*keys).agg(F.max_by("rating", "_ord").alias("rating"))
            .select("rating", *keys))


def refresh_game_stats(games: DataFrame, merged_reviews: DataFrame, batch: DataFrame,
                       base_reviews: DataFrame | None = None,
                       mode: str = "parity") -> DataFrame:
    """U2 = A3 + A4: new average and usersrated for games the batch touched.

    A3: average = mean rating over the merged reviews of the game.
    A4 parity: usersrated + number of submitted ratings (a re-rating counts
    again, as the reference does). ``mode='corrected'``: + number of new
    (user, game) pairs only (needs ``base_reviews``). A null start counts as 0.
    Untouched games keep their loaded values.
    """
    if mode == "parity":
        inc = batch.groupBy("id").agg(F.count(F.lit(1)).alias("_inc"))
    elif mode == "corrected":
        if base_reviews is None:
            raise ValueError("corrected mode needs base_reviews")
        pairs = batch.select("user_id", "id").distinct()
        # the big table is filtered by the (small, broadcastable) batch keys,
        # never shuffled whole; the anti join then runs small against small
        seen = base_reviews.select("user_id", "id").join(pairs, ["user_id", "id"], "left_semi")
        new_pairs = pairs.join(seen, ["user_id", "id"], "left_anti")
        inc = (batch.select("id").distinct()
               .join(new_pairs.groupBy("id").agg(F.count(F.lit(1)).alias("_inc")), "id", "left")
               .fillna(0, ["_inc"]))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    avgs = (merged_reviews.join(inc.select("id"), "id", "left_semi")
            .groupBy("id").agg(F.avg("rating").alias("_avg")))
    touched = inc.join(avgs, "id", "left")
    out = games.join(touched, "id", "left")
    hit = F.col("_inc").isNotNull()
    return out.select(
        *[c for c in games.columns if c not in ("average", "usersrated")],
        F.when(hit, F.col("_avg")).otherwise(F.col("average")).alias("average"),
        F.when(hit, F.coalesce(F.col("usersrated"), F.lit(0.0)) + F.col("_inc"))
         .otherwise(F.col("usersrated")).cast("double").alias("usersrated"),
    )


# --- merges into versioned tables ------------------------------------------------

REVIEW_ROWS = T.StructType([T.StructField("user_id", T.IntegerType()), T.StructField("id", T.IntegerType()),
                            T.StructField("rating", T.DoubleType())])
# the parts of an average, which can be corrected; ratings are added as decimals, so
# what went in and out again leaves no trace
STATS_ROWS = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("total", T.DecimalType(30, 10)),
                           T.StructField("n", T.LongType()), T.StructField("submitted", T.LongType())])


def stats_rows(reviews: DataFrame) -> DataFrame:
    """STATS_ROWS of whole reviews: where incremental statistics start."""
    value = F.col("rating").cast("decimal(20,10)")
    return reviews.groupBy("id").agg(
        F.coalesce(F.sum(value), F.lit(0)).cast("decimal(30,10)").alias("total"), F.count("rating").alias("n"),
        F.count("rating").alias("submitted"))


def merge_ratings(reviews: VersionedTable, stats: VersionedTable, batch: DataFrame, batch_id: str,
                  order_cols: Sequence[str] = ("ts", "event_id")) -> None:
    """U1 + U2 for one batch: reviews take the last rating of each (user, game), and
    each touched game's statistics the difference it makes: the old rating out, the new
    one in. Neither the reviews of the touched games nor any other bucket is read.

    A batch may come again: what was applied stays as it is, and a job that failed
    between the two tables completes, since differences are always taken against the
    reviews as they were before this batch.
    """
    if batch_id in reviews.batches() and batch_id in stats.batches():
        return
    first = reviews.before(batch_id)
    latest = batch.groupBy("user_id", "id").agg(
        F.max_by(F.col("rating").cast("double"), F.struct(*order_cols)).alias("rating"),
        F.count(F.lit(1)).alias("submitted"))
    latest = latest.checkpoint(eager=True)  # read by both tables; batch-sized
    old = reviews.lookup(latest, first).withColumnRenamed("rating", "before").withColumn("known", F.lit(True))
    value = lambda c: F.coalesce(F.col(c).cast("decimal(20,10)"), F.lit(0).cast("decimal(20,10)"))
    change = (latest.join(old, ["user_id", "id"], "left").groupBy("id").agg(
        F.sum(value("rating") - value("before")).alias("total"),
        F.sum(F.col("rating").isNotNull().cast("long") - F.col("before").isNotNull().cast("long")).alias("n"),
        F.sum("submitted").alias("submitted")).checkpoint(eager=True))
    had = stats.lookup(change, stats.before(batch_id)).select(
        "id", *[F.col(c).alias(f"_{c}") for c in ("total", "n", "submitted")])
    none = F.lit(0)
    new = change.join(had, "id", "left").select(
        "id", (F.coalesce("_total", none) + F.col("total")).cast("decimal(30,10)").alias("total"),
        *[(F.coalesce(f"_{c}", none) + F.col(c)).cast("long").alias(c) for c in ("n", "submitted")])
    reviews.merge(latest.select("user_id", "id", "rating"), batch_id)
    stats.merge(new, batch_id)


def averages(stats: DataFrame) -> DataFrame:
    """(id, average, n, submitted) of STATS_ROWS; no average without a rating."""
    return stats.select("id", F.when(F.col("n") > 0, F.col("total").cast("double") / F.col("n")).alias("average"),
                        "n", "submitted")


def register_users(existing: DataFrame, batch: DataFrame, order_col: str = "event_id") -> DataFrame:
    """Accept new users, refusing an email already taken.

    An email present in the table is refused; inside the batch the first
    request per email (by ``order_col``) wins and later ones are refused, as
    the second request would find the first committed. A request without an
    email is refused too (the reference's lookup by a missing email matches
    the loaded users, whose emails are all empty). Accepted users get ids
    max(user_id)+1, +2, ... in request order (1, 2, ... in an empty table, as a
    serial column counts).
    """
    taken = existing.select("email").filter(F.col("email").isNotNull())
    # first request per email, combined map-side: a hot email reaches the
    # join below as one row
    firsts = (batch.filter(F.col("email").isNotNull()).groupBy("email")
              .agg(F.min_by(F.struct(order_col, "username"), F.col(order_col)).alias("_r")))
    # the users table is only filtered by the batch's emails (a broadcastable
    # semi join); the anti join then runs batch against batch-sized input
    clashes = taken.join(firsts.select("email"), "email", "left_semi")
    fresh = firsts.join(clashes, "email", "left_anti")
    accepted = fresh.select("email", F.col(f"_r.{order_col}").alias(order_col),
                            F.col("_r.username").alias("username"))
    top = existing.agg(F.max("user_id").alias("m")).first()["m"]
    start = 1 if top is None else int(top) + 1
    ids = dense_ids(accepted, order_col, "user_id", start=start)
    return ids.select("user_id", "username", "email", order_col)


def user_created_messages(new_users: DataFrame) -> DataFrame:
    """U3 + S7: the user_created message of each accepted registration."""
    return new_users.select(text.key_text("user_id").alias("key"),
                            ev.user_created_json("user_id", "username").alias("value"))
