"""Event messages and daily counts (S7, E7-E9, E11, F6, A5, A6, ST3).

The same functions serve batch frames and streaming frames: a message frame
has the Kafka record columns ``key``, ``value`` and ``timestamp``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meeple.functions import events as ev
from meeple.functions import text


# --- S7 + E8 + E11 ----------------------------------------------------------

def view_messages(views: DataFrame) -> DataFrame:
    """game_viewed messages from (user_id or null, game_id, ts)."""
    return views.select(
        *[c for c in ("event_id",) if c in views.columns],
        text.key_text("user_id").alias("key"),
        ev.game_viewed_json("user_id", "game_id").alias("value"),
        F.col("ts").alias("timestamp"))


def registration_messages(signups: DataFrame) -> DataFrame:
    """user_created messages from (user_id, username, ts)."""
    return signups.select(
        *[c for c in ("event_id",) if c in signups.columns],
        text.key_text("user_id").alias("key"),
        ev.user_created_json("user_id", "username").alias("value"),
        F.col("ts").alias("timestamp"))


# --- E7 + F6 ----------------------------------------------------------------

def parse_messages(messages: DataFrame) -> DataFrame:
    """Message value -> event fields, plus a ``dead_letter`` flag.

    Dead letters are texts that are not an event object, or a game view
    without an integer game id (a missing one stops the reference's consumer; a
    text that is an integer counts as that game). Kinds other than
    the two counted ones are valid but ignored by the counts (F6).
    """
    parsed = messages.withColumn("_e", ev.parse_event("value"))
    e = F.col("_e")
    game = e["game_id"].try_cast("int")  # a game id may come as a number or as text
    dead = (e.isNull() | e["event"].isNull()
            | ((e["event"] == ev.GAME_VIEWED) & game.isNull()))
    return parsed.select(
        *[c for c in messages.columns if c != "value"], "value",
        e["event"].alias("event"), e["user_id"].alias("user_id"),
        game.alias("game_id"), e["username"].alias("username"),
        dead.alias("dead_letter"))


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("dead_letter"))


def countable(parsed: DataFrame) -> DataFrame:
    """(timestamp, kind, key) of the two counted kinds.

    key = game id text for views, the day for registrations (the reference
    counts registrations per day).
    """
    ok = parsed.filter(~F.col("dead_letter")
                       & F.col("event").isin(ev.USER_CREATED, ev.GAME_VIEWED))
    key = F.when(F.col("event") == ev.GAME_VIEWED, F.col("game_id").cast("string")) \
           .otherwise(ev.day_text("timestamp"))
    return ok.select("timestamp", F.col("event").alias("kind"), key.alias("key"))


# --- A5 + A6 ----------------------------------------------------------------

def daily_counts(parsed: DataFrame) -> DataFrame:
    """A5 + A6 long form: (date, kind, key, n) per UTC day of the record time."""
    c = countable(parsed)
    return (c.groupBy(ev.day_text("timestamp").alias("date"), "kind", "key")
            .agg(F.count(F.lit(1)).alias("n")))


def daily_registrations(parsed: DataFrame) -> DataFrame:
    """A5: registrations per day."""
    c = countable(parsed).filter(F.col("kind") == ev.USER_CREATED)
    return (c.groupBy(ev.day_text("timestamp").alias("date"))
            .agg(F.count(F.lit(1)).alias("n")))


def daily_game_views(parsed: DataFrame) -> DataFrame:
    """Views per game per day."""
    c = countable(parsed).filter(F.col("kind") == ev.GAME_VIEWED)
    return (c.groupBy(ev.day_text("timestamp").alias("date"),
                      F.col("key").cast("int").alias("game_id"))
            .agg(F.count(F.lit(1)).alias("n")))


# --- ST3 --------------------------------------------------------------------

def daily_report(counts: DataFrame) -> DataFrame:
    """ST3: one document per day from the long-form counts.

    ``user_counts`` maps the day to its registrations, ``game_views`` maps
    game id text to views (text keys: the reference's date keys cannot be
    written as JSON). A day's map is bounded by the number of games.
    """
    uc = F.when(F.col("kind") == ev.USER_CREATED, F.struct("key", "n"))
    gv = F.when(F.col("kind") == ev.GAME_VIEWED, F.struct("key", "n"))
    return counts.groupBy("date").agg(
        F.map_from_entries(F.array_sort(F.collect_list(uc))).alias("user_counts"),
        F.map_from_entries(F.array_sort(F.collect_list(gv))).alias("game_views"))


def counts_summary(counts: DataFrame) -> DataFrame:
    """Per day: registrations, views, distinct games viewed, straight from the
    long-form counts (three sums, combined map-side; no map is built)."""
    view = F.col("kind") == ev.GAME_VIEWED
    return counts.groupBy("date").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == ev.USER_CREATED, F.col("n"))), F.lit(0)).alias("n_users"),
        F.coalesce(F.sum(F.when(view, F.col("n"))), F.lit(0)).alias("n_views"),
        F.count(F.when(view, F.lit(1))).alias("n_games"))


def report_summary(report: DataFrame) -> DataFrame:
    """Per day: registrations, views, distinct games viewed."""
    return report.select(
        "date",
        F.coalesce(F.aggregate(F.map_values("user_counts"), F.lit(0).cast("long"),
                               lambda a, x: a + x), F.lit(0)).alias("n_users"),
        F.aggregate(F.map_values("game_views"), F.lit(0).cast("long"),
                    lambda a, x: a + x).alias("n_views"),
        F.size("game_views").cast("long").alias("n_games"))


def report_json(report: DataFrame) -> DataFrame:
    """S8 document text: {"date":..,"user_counts":{..},"game_views":{..}}."""
    return report.select("date", F.to_json(F.struct("date", "user_counts", "game_views")).alias("json"))
