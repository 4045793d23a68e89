"""Catalogue reads (F4, T2-T5, A10, J4-J7, P7) as batch operators over tables.

The reference answers these one request at a time; here each one is a
DataFrame operator that answers it for a whole table of keys at once.
Every ranking states its null order and ends with an ``id`` tie-break, so
pages are stable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meeple.functions import text
from meeple.operators.dense_ids import global_positions
from meeple.operators.joins import join_spreading_nulls

# Page sizes of the catalogue listings and the profile page.
GAMES_PER_PAGE = 10
RATINGS_PER_PAGE = 5


def _page_number(page: int) -> int:
    # a page below 1 reads as page 1 (pagination with errors off)
    return max(1, int(page))


# --- F4 ------------------------------------------------------------------

def search(games: DataFrame, query: str, wildcards: bool = False) -> DataFrame:
    """games whose name contains ``query`` ignoring case; empty query -> no rows.

    Literal mode (default) matches the text as typed. ``wildcards=True`` keeps
    ``%`` and ``_`` as LIKE wildcards, as the reference's ilike does, with a
    backslash taken literally.
    """
    if not query:
        return games.limit(0)
    if not wildcards:
        return games.filter(F.lower(F.col("name")).contains(query.lower()))
    pattern = "%" + query.replace("\\", "\\\\") + "%"
    return games.filter(F.col("name").ilike(pattern))


# --- T2-T4 and A10 --------------------------------------------------------

def ordered_by(metric: str, descending: bool, nulls_first: bool) -> list[Column]:
    c = F.col(metric)
    if descending:
        first = c.desc_nulls_first() if nulls_first else c.desc_nulls_last()
    else:
        first = c.asc_nulls_first() if nulls_first else c.asc_nulls_last()
    return [first, F.col("id").asc()]


def page(df: DataFrame, order: Sequence[Column], page_no: int,
         per_page: int = GAMES_PER_PAGE) -> DataFrame:
    """One page of a global ranking, with its 1-based position ``pos``.

    ``orderBy().offset().limit()`` plans as one TakeOrderedAndProject: each
    task keeps only offset+limit rows, nothing else is shuffled. The position
    is numbered over the <= per_page rows of the page.
    """
    n = _page_number(page_no)
    skip = (n - 1) * per_page
    rows = df.orderBy(*order).offset(skip).limit(per_page)
    return rows.withColumn("pos", (F.lit(skip) + F.row_number().over(Window.orderBy(*order))).cast("int"))


def top_ranked(games: DataFrame, page_no: int = 1) -> DataFrame:
    """By board_game_rank ascending; unranked games last."""
    return page(games.select("id", "name", "board_game_rank"),
                ordered_by("board_game_rank", False, False), page_no)


def top_rated(games: DataFrame, page_no: int = 1, nulls: str = "first") -> DataFrame:
    """By average descending. Parity with the reference's database puts
    null averages first; ``nulls='last'`` puts them last."""
    return page(games.select("id", "name", "average"),
                ordered_by("average", True, nulls == "first"), page_no)


def most_popular(games: DataFrame, page_no: int = 1, nulls: str = "first") -> DataFrame:
    """T4: by usersrated descending, null order as in ``top_rated``."""
    return page(games.select("id", "name", "usersrated"),
                ordered_by("usersrated", True, nulls == "first"), page_no)


def ranking(df: DataFrame, order: Sequence[Column], pos_col: str = "pos") -> DataFrame:
    """The whole ranking with exact 1-based positions, for deep pages.

    ``page`` keeps offset+limit rows per task, fine for the first pages; a
    ranking table written once serves any page as a filter on ``pos``
    (pushed down to the Parquet scan).
    """
    return global_positions(df, order, pos_col)


def page_of_ranking(ranked: DataFrame, page_no: int, per_page: int = GAMES_PER_PAGE,
                    pos_col: str = "pos") -> DataFrame:
    n = _page_number(page_no)
    lo, hi = (n - 1) * per_page, n * per_page
    return ranked.filter((F.col(pos_col) > lo) & (F.col(pos_col) <= hi))


def page_info(df: DataFrame, page_no: int, per_page: int = GAMES_PER_PAGE,
              by: Sequence[str] = ()) -> DataFrame:
    """A10: total rows, number of pages and next/prev flags for a page.

    With ``by`` the totals are per group (e.g. per user for the profile page).
    """
    n = _page_number(page_no)
    counted = (df.groupBy(*by).agg(F.count(F.lit(1)).alias("total")) if by
               else df.agg(F.count(F.lit(1)).alias("total")))
    pages = F.ceil(F.col("total") / F.lit(per_page)).cast("long")
    return counted.select(
        *by, "total",
        pages.alias("pages"),
        F.lit(n).alias("page"),
        (F.lit(n) < pages).alias("has_next"),
        (F.lit(n) > 1).alias("has_prev"),
    )


# --- T5 + J4 --------------------------------------------------------------

def profile_ratings(reviews: DataFrame, games: DataFrame, page_no: int = 1,
                    per_page: int = RATINGS_PER_PAGE) -> DataFrame:
    """T5 + J4: one profile page of own ratings for every user at once.

    Order: rating descending (nulls first, as the database does), then id.
    The ``row_number() <= k`` filter plans a WindowGroupLimit before the
    shuffle, so a user with a huge number of ratings ships at most k rows
    per task. The game row is attached by one join instead of a lookup per
    rating; a missing game leaves name null.
    """
    n = _page_number(page_no)
    lo, hi = (n - 1) * per_page, n * per_page
    w = Window.partitionBy("user_id").orderBy(F.col("rating").desc_nulls_first(), F.col("id"))
    ranked = (reviews.select("user_id", "id", "rating")
              .withColumn("pos", F.row_number().over(w))
              .filter((F.col("pos") <= hi) & (F.col("pos") > lo)))
    named = ranked.join(games.select("id", "name"), "id", "left")
    return named.select("user_id", F.col("pos").cast("int").alias("pos"), "id", "name", "rating")


# --- J5 + J6 --------------------------------------------------------------

def hydrate_recommendations(users: DataFrame, recs: DataFrame, games: DataFrame) -> DataFrame:
    """J6 + J5: each user with the games of their list, list order kept.

    A user without a row, or with an empty list, gets one row with
    ``has_recommendations = false`` and null position/game (the fallback
    links case). A listed id with no game row keeps a null name.
    """
    joined = users.select("user_id").join(recs.select("user_id", "recommendation_list"),
                                          "user_id", "left")
    flagged = joined.withColumn(
        "has_recommendations",
        F.coalesce(F.size("recommendation_list") > 0, F.lit(False)))
    exploded = flagged.select(
        "user_id", "has_recommendations",
        F.posexplode_outer("recommendation_list").alias("pos0", "id"))
    # users without a list carry a null id: spread them, do not pile them up
    with_games = join_spreading_nulls(exploded, games.select("id", "name"), ["id"], "left")
    return with_games.select(
        "user_id", (F.col("pos0") + 1).cast("int").alias("pos"), "id", "name",
        "has_recommendations")


# --- J7 -------------------------------------------------------------------

def with_own_rating(pairs: DataFrame, reviews: DataFrame,
                    user_col: str = "user_id", game_col: str = "game_id") -> DataFrame:
    """Attach the user's own rating of the game; signed out or unrated -> null.

    Signed-out rows (null user) cannot match; their keys are spread over many
    shuffle buckets instead of one, as signed-out views may be a large share
    of all views.
    """
    r = reviews.select(F.col("user_id").alias(user_col), F.col("id").alias(game_col), "rating")
    return join_spreading_nulls(pairs, r, [user_col, game_col], "left")


# --- P7 -------------------------------------------------------------------

# The detail page's whole-number fields.
DETAIL_INTS = ("yearpublished", "minplayers", "maxplayers", "playingtime", "minage", "usersrated")


def display(games: DataFrame) -> DataFrame:
    """Values as the detail and list pages show them: whole numbers for the
    rank, year, players, time, age and number of raters, two decimals for the
    averages, the category list as one text. Columns the table lacks are left out."""
    cols = [F.col("id"),
            text.int_or_zero("board_game_rank").alias("rank_int"),
            text.round_half_up_2("average").alias("average_2dp"),
            text.two_decimals_text("average").alias("average_text")]
    cols += [text.int_or_zero(c).alias(f"{c}_int") for c in DETAIL_INTS if c in games.columns]
    if "bayesaverage" in games.columns:
        cols.append(text.two_decimals_text("bayesaverage").alias("bayesaverage_text"))
    if "category" in games.columns:
        cols.append(text.joined("category").alias("category_text"))
    return games.select(*cols)
