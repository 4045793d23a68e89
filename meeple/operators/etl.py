"""Catalogue and review ETL.

Raw dumps -> typed ``games``, ``users`` and ``reviews`` tables. Every step
is a DataFrame transformation; the category text is parsed with built-in
string/array functions instead of a row-wise Python function (X1).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meeple import schemas
from meeple.functions import text
from meeple.operators.dense_ids import dense_ids


def drop_columns(df: DataFrame, cols: Sequence[str], must_exist: bool = True) -> DataFrame:
    """Drop columns by name; a missing column is an error, as in pandas."""
    if must_exist:
        missing = [c for c in cols if c not in df.columns]
        if missing:
            raise ValueError(f"columns not found: {missing}")
    return df.drop(*cols)


def conform(df: DataFrame, schema) -> DataFrame:
    """Select the target columns by name in schema order, with the
    target types; absent columns become typed nulls."""
    cols = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def clean_games_detailed(raw: DataFrame) -> DataFrame:
    """First catalogue source -> games rows.

    E1 rank text -> number (bad text -> null), P2 column subset, P3 renames
    (primary -> name, boardgamecategory -> category), E3/E4 category text ->
    array.
    """
    df = drop_columns(raw, ["_row"], must_exist=False)
    df = (df.withColumn("board_game_rank", text.to_number(F.col("`Board Game Rank`")))
            .withColumn("category", text.category_list("boardgamecategory"))
            .withColumnsRenamed({"primary": "name"}))
    return conform(df, schemas.GAMES)


def clean_games_list(raw: DataFrame) -> DataFrame:
    """Second catalogue source (ranking list) -> games rows.

    P3 renames as the reference does, including URL -> image.
    """
    df = drop_columns(raw, ["_row"], must_exist=False)
    df = df.withColumnsRenamed({
        "ID": "id", "Name": "name", "Year": "yearpublished", "Rank": "board_game_rank",
        "Average": "average", "Bayes average": "bayesaverage", "Users rated": "usersrated",
        "URL": "image", "Thumbnail": "thumbnail"})
    return conform(df, schemas.GAMES)


def complete_games(first: DataFrame, second: DataFrame) -> DataFrame:
    """J2 + O1: add games of the second source whose id is not in the first.

    ``left_anti`` replaces the driver-side set difference; duplicates inside
    the second source are kept as the reference keeps them. Added games get
    an empty category list instead of null.
    """
    missing = second.filter(F.col("id").isNotNull()).join(
        first.select("id").filter(F.col("id").isNotNull()), "id", "left_anti")
    out = first.unionByName(missing, allowMissingColumns=True)
    return out.withColumn("category", F.coalesce("category", F.array().cast("array<string>")))


def clean_reviews(raw: DataFrame, tokens: Iterable[str] = ("",),
                  user_col: str = "user") -> DataFrame:
    """P1 + E2 + F1: drop comment and name, then drop rows with any null
    among user, rating and game id. Null tokens apply to the user text."""
    df = drop_columns(raw, [c for c in ("_row", "comment", "name") if c in raw.columns],
                      must_exist=False)
    df = df.withColumn(user_col, text.null_tokens(user_col, tokens))
    return df.dropna("any", subset=[user_col, "rating", "ID" if "ID" in df.columns else "id"])


def dense_user_ids(clean: DataFrame, pos_col: str, user_col: str = "user") -> DataFrame:
    """A7 + R1: users numbered 0..n-1 in order of first appearance.

    First appearance = smallest file position per user (a map-side combined
    aggregate), then the distributed dense numbering of ``dense_ids``.
    """
    firsts = clean.groupBy(user_col).agg(F.min(pos_col).alias("_first"))
    ids = dense_ids(firsts, "_first", "user_id", tie_breakers=[user_col])
    return ids.select("user_id", F.col(user_col).alias("username"))


def attach_user_ids(clean: DataFrame, ids: DataFrame, user_col: str = "user") -> DataFrame:
    """User text -> user_id; total after F1, so an inner equi-join."""
    return clean.join(ids.select("user_id", F.col("username").alias(user_col)), user_col)


def users_table(ids: DataFrame) -> DataFrame:
    """Users with an empty email column."""
    return ids.select("user_id", "username", F.lit(None).cast("string").alias("email"))


def reviews_table(with_ids: DataFrame, game_col: str = "ID") -> DataFrame:
    """Final review columns (rating, id, user_id)."""
    return with_ids.select(F.col("rating").cast("double"),
                           F.col(game_col).cast("int").alias("id"),
                           F.col("user_id").cast("int"))
