"""Column functions for event messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meeple import schemas

# The message kinds on the events topic.
USER_CREATED = "user_created"
GAME_VIEWED = "game_viewed"

# to_json keeps null fields ("user_id": null), as the producer writes them.
_JSON_OPTS = {"ignoreNullFields": "false"}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def game_viewed_json(user_id, game_id) -> Column:
    """{"event":"game_viewed","user_id":<int|null>,"game_id":<int>}."""
    return F.to_json(F.struct(F.lit(GAME_VIEWED).alias("event"),
                              _col(user_id).cast("int").alias("user_id"),
                              _col(game_id).cast("int").alias("game_id")), _JSON_OPTS)


def user_created_json(user_id, username) -> Column:
    """{"event":"user_created","user_id":<int>,"username":<text>}."""
    return F.to_json(F.struct(F.lit(USER_CREATED).alias("event"),
                              _col(user_id).cast("int").alias("user_id"),
                              _col(username).cast("string").alias("username")), _JSON_OPTS)


def parse_event(value) -> Column:
    """E7 + E11: message bytes or text -> struct(event, user_id, game_id, username).

    Text that is not a JSON object gives a struct of nulls, never an error.
    """
    return F.from_json(_col(value).cast("string"), schemas.EVENT, {"mode": "PERMISSIVE"})


def day_text(ts) -> Column:
    """Timestamp -> 'yyyy-MM-dd' in the session time zone (UTC)."""
    return F.date_format(F.to_date(_col(ts)), "yyyy-MM-dd")
