"""Oracle SQL for the query catalogue, in DuckDB's dialect.

Each statement inlines the fixture views it needs as CTEs over the
pre-registered test tables, then states the query the plain SQL way
(global windows, group-bys). Column names and types match the Spark side.
"""

from __future__ import annotations

import re

# --- fixture views (same rules as meeple.plans.fixtures) ------------------------

_FIXTURES: dict[str, tuple[tuple[str, ...], str]] = {
    "fx_ratings_log": ((), """
SELECT CAST(o_custkey AS INT) AS user_id, CAST(l_partkey AS INT) AS id,
       CAST(CAST(l_quantity - 1 AS INT) % 10 + 1 AS DOUBLE) AS rating,
       o_orderdate AS rated_at, o_orderkey AS order_no, l_linenumber AS line_no
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "fx_reviews": (("fx_ratings_log",), """
SELECT user_id, id, rating FROM (
  SELECT user_id, id, rating, row_number() OVER (PARTITION BY user_id, id
           ORDER BY rated_at DESC, order_no DESC, line_no DESC, rating DESC) AS rn
  FROM fx_ratings_log) t WHERE rn = 1"""),
    "fx_users": ((), """
SELECT CAST(c_custkey AS INT) AS user_id, c_name AS username,
       CASE WHEN c_custkey % 3 = 0 THEN NULL
            ELSE 'u' || CAST(c_custkey AS VARCHAR) || '@example.org' END AS email
FROM customer"""),
    "fx_games_detailed_all": ((), """
SELECT CAST(p_partkey AS INT) AS id, p_name AS primary_name,
       CASE WHEN p_partkey % 7 = 0 THEN NULL
            WHEN p_partkey % 11 = 0 THEN '[]'
            WHEN p_partkey % 13 = 0 THEN '[' || chr(34) || 'Collector' || chr(39) || 's Item' || chr(34) || ', ' || chr(39) || p_type || chr(39) || ']'
            ELSE '[' || chr(39) || p_type || chr(39) || ', ' || chr(39) || p_brand || chr(39) || ']' END AS boardgamecategory,
       CASE WHEN p_partkey % 17 = 0 THEN 'Not Ranked'
            WHEN p_partkey % 41 = 0 THEN 'NaN' WHEN p_partkey % 43 = 0 THEN 'Infinity'
            WHEN p_partkey % 47 = 0 THEN CAST(p_partkey + 1 AS VARCHAR) || 'd'
            WHEN p_partkey % 53 = 0 THEN ' ' || CAST(p_partkey + 1 AS VARCHAR) || '.50 '
            ELSE CAST(p_partkey + 1 AS VARCHAR) END AS rank_text,
       CAST(1990 + p_partkey % 35 AS DOUBLE) AS yearpublished,
       CAST(1 + p_partkey % 4 AS DOUBLE) AS minplayers,
       CASE WHEN p_partkey % 23 <> 0 THEN CAST(1 + p_partkey % 4 + p_partkey % 5 AS DOUBLE) END AS maxplayers,
       CAST(p_partkey % 240 + 0.5 AS DOUBLE) AS playingtime,
       CASE WHEN p_partkey % 29 <> 0 THEN CAST(8 + p_partkey % 10 AS DOUBLE) END AS minage,
       CASE WHEN p_partkey % 31 <> 0 THEN CAST(p_partkey % 1000 AS DOUBLE) / 100 END AS bayesaverage
FROM part"""),
    "fx_games_detailed": (("fx_games_detailed_all",), """
SELECT * FROM fx_games_detailed_all WHERE id % 10 <> 9"""),
    "fx_games_list": ((), """
SELECT CAST(p_partkey AS INT) AS id, p_name AS name, CAST(p_partkey + 1 AS DOUBLE) AS board_game_rank
FROM part WHERE p_partkey % 10 = 9 OR p_partkey % 5 = 0"""),
    "fx_games": (("fx_reviews",), """
SELECT CAST(p_partkey AS INT) AS id, p_name AS name,
       CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE CAST(p_partkey + 1 AS DOUBLE) END AS board_game_rank,
       CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE a.avg_rating END AS average,
       CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE CAST(a.n AS DOUBLE) END AS usersrated
FROM part LEFT JOIN (SELECT id AS rid, avg(rating) AS avg_rating, count(rating) AS n
                     FROM fx_reviews GROUP BY id) a ON p_partkey = a.rid"""),
    "fx_reviews_raw": (("fx_ratings_log",), """
SELECT c_name AS user_name,
       CASE WHEN (r.order_no + r.line_no) % 23 = 0 THEN NULL ELSE r.rating END AS rating,
       CASE WHEN r.order_no % 4 = 0 THEN 'nice' ELSE NULL END AS comment_text,
       r.id AS id, r.order_no * 10 + r.line_no AS pos
FROM fx_ratings_log r JOIN customer ON r.user_id = c_custkey"""),
    "fx_candidates": (("fx_reviews",), """
SELECT user_id, pos, id FROM (
  SELECT user_id, id, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, id) AS pos
  FROM fx_reviews) t WHERE pos <= 50"""),
    "fx_popular": (("fx_reviews",), """
SELECT id, count(rating) AS review_count FROM fx_reviews GROUP BY id HAVING count(rating) > 25"""),
    "fx_top5": (("fx_candidates", "fx_popular"), """
SELECT user_id, list(id ORDER BY pos) AS lst FROM (
  SELECT c.user_id, c.pos, c.id,
         row_number() OVER (PARTITION BY c.user_id ORDER BY c.pos) AS rn
  FROM fx_candidates c JOIN fx_popular p ON c.id = p.id) t
WHERE rn <= 5 GROUP BY user_id"""),
    "fx_views": ((), """
SELECT event_id, CAST(ts AS TIMESTAMP) AS ts,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(user_id AS INT) END AS user_id,
       CAST(json_extract(props, '$.k') AS INT) AS game_id
FROM events WHERE event_type = 'view'"""),
    "fx_signups": ((), """
SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, CAST(user_id AS INT) AS user_id,
       'n' || CAST(user_id AS VARCHAR) AS username,
       'u' || CAST(user_id AS VARCHAR) || '@example.org' AS email
FROM events WHERE event_type = 'signup'"""),
    "fx_rating_batch": ((), """
SELECT CAST(user_id AS INT) AS user_id, CAST(json_extract(props, '$.k') AS INT) AS id,
       CAST(floor(value) % 10 + 1 AS DOUBLE) AS rating, ts, event_id
FROM events WHERE event_type = 'purchase'"""),
    "fx_accepted_batch": (("fx_rating_batch",), """
SELECT b.* FROM fx_rating_batch b WHERE b.id IN (SELECT CAST(p_partkey AS INT) FROM part)
  AND b.rating IS NOT NULL"""),
    "fx_upserted": (("fx_reviews", "fx_accepted_batch"), """
SELECT user_id, id, rating FROM (
  SELECT user_id, id, rating, row_number() OVER (PARTITION BY user_id, id
           ORDER BY src DESC, ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
  FROM (SELECT user_id, id, rating, 0 AS src, CAST(NULL AS TIMESTAMP) AS ts, CAST(NULL AS BIGINT) AS event_id
        FROM fx_reviews
        UNION ALL
        SELECT user_id, id, rating, 1 AS src, ts, event_id FROM fx_accepted_batch) u) t
WHERE rn = 1"""),
    "fx_messages": (("fx_views", "fx_signups"), """
SELECT event_id, coalesce(CAST(user_id AS VARCHAR), 'None') AS key,
       '{"event":"game_viewed","user_id":' || coalesce(CAST(user_id AS VARCHAR), 'null')
         || ',"game_id":' || CAST(game_id AS VARCHAR) || '}' AS value,
       ts AS timestamp, 'game_viewed' AS kind, CAST(game_id AS VARCHAR) AS mkey
FROM fx_views
UNION ALL
SELECT event_id, coalesce(CAST(user_id AS VARCHAR), 'None') AS key,
       '{"event":"user_created","user_id":' || CAST(user_id AS VARCHAR)
         || ',"username":"' || username || '"}' AS value,
       ts AS timestamp, 'user_created' AS kind, strftime(ts, '%Y-%m-%d') AS mkey
FROM fx_signups"""),
    "fx_daily_counts": (("fx_messages",), """
SELECT strftime(timestamp, '%Y-%m-%d') AS date, kind, mkey AS key, count(*) AS n
FROM fx_messages GROUP BY 1, 2, 3"""),
    "fx_clean_reviews": (("fx_reviews_raw",), """
SELECT user_name, rating, id, pos FROM fx_reviews_raw
WHERE user_name IS NOT NULL AND user_name <> '' AND rating IS NOT NULL AND id IS NOT NULL"""),
    "fx_dense_users": (("fx_clean_reviews",), """
SELECT CAST(row_number() OVER (ORDER BY first_pos, user_name) - 1 AS INT) AS user_id,
       user_name AS username
FROM (SELECT user_name, min(pos) AS first_pos FROM fx_clean_reviews GROUP BY user_name) t"""),
    "fx_new_users": (("fx_users", "fx_signups"), """
SELECT CAST((SELECT max(user_id) FROM fx_users) + row_number() OVER (ORDER BY event_id) AS INT) AS user_id,
       username, email
FROM (SELECT event_id, username, email,
             row_number() OVER (PARTITION BY email ORDER BY event_id) AS rn
      FROM fx_signups
      WHERE email IS NOT NULL
        AND email NOT IN (SELECT email FROM fx_users WHERE email IS NOT NULL)) t
WHERE rn = 1"""),
    "fx_categories": (("fx_games_detailed_all",), """
SELECT id, CASE WHEN boardgamecategory IS NULL THEN CAST([] AS VARCHAR[]) ELSE
  list_filter(
    list_transform(
      string_split(replace(regexp_replace(boardgamecategory, '^[\\[\\]]+|[\\[\\]]+$', '', 'g'), chr(39), ''), ', '),
      lambda x: CASE WHEN length(x) >= 2 AND starts_with(x, chr(34)) AND ends_with(x, chr(34))
                     THEN substr(x, 2, length(x) - 2) ELSE trim(x) END),
    lambda x: x <> '') END AS category
FROM fx_games_detailed_all"""),
}


def _with(names: list[str], body: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in _FIXTURES[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({_FIXTURES[n][1]}\n)" for n in order)
    return _num(f"WITH {ctes}\n{body.strip()}")


# text that is a plain finite number, else null
def _num(sql: str) -> str:
    return re.sub(r"NUM\(([a-z_.]+)\)",
                  r"CASE WHEN regexp_matches(\1, '^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*$')"
                  r" THEN TRY_CAST(trim(\1) AS DOUBLE) END", sql)


def _page(metric: str, order: str, offset: int) -> str:
    return f"""
SELECT id, name, {metric}, CAST({offset} + row_number() OVER (ORDER BY {order}, id) AS INT) AS pos
FROM (SELECT id, name, {metric} FROM fx_games ORDER BY {order}, id LIMIT 10 OFFSET {offset}) t"""


ORACLE: dict[str, str] = {
    "popular_games": _with(["fx_popular"], "SELECT id, review_count FROM fx_popular"),
    "top_ranked_page": _with(["fx_games"], _page("board_game_rank", "board_game_rank ASC NULLS LAST", 10)),
    "top_rated_page": _with(["fx_games"], _page("average", "average DESC NULLS FIRST", 10)),
    "most_popular_page": _with(["fx_games"], _page("usersrated", "usersrated DESC NULLS FIRST", 10)),
    "rated_ranking": _with(["fx_games"], """
SELECT id, average, row_number() OVER (ORDER BY average DESC NULLS FIRST, id) AS pos FROM fx_games"""),
    "page_info": _with(["fx_games"], """
SELECT total, CAST(ceil(total / 10.0) AS BIGINT) AS pages, 3 AS page,
       3 < ceil(total / 10.0) AS has_next, true AS has_prev
FROM (SELECT count(*) AS total FROM fx_games) t"""),
    "profile_page_info": _with(["fx_reviews"], """
SELECT user_id, total, CAST(ceil(total / 5.0) AS BIGINT) AS pages, 2 AS page,
       2 < ceil(total / 5.0) AS has_next, true AS has_prev
FROM (SELECT user_id, count(*) AS total FROM fx_reviews GROUP BY user_id) t"""),
    "search_games": _with(["fx_games"], """
SELECT id, name FROM fx_games WHERE lower(name) LIKE '%ring%'"""),
    "search_games_wildcard": _with(["fx_games"], """
SELECT id, name FROM fx_games WHERE name ILIKE '%r_ng%'"""),
    "game_display": _with(["fx_games"], """
SELECT id, coalesce(CAST(trunc(board_game_rank) AS INT), 0) AS rank_int,
       floor(average * 100 + 0.5) / 100 AS average_2dp
FROM fx_games"""),
    "game_detail_display": _with(["fx_games_detailed", "fx_games_list", "fx_categories", "fx_games"], """
SELECT m.id, coalesce(CAST(trunc(m.board_game_rank) AS INT), 0) AS rank_int,
       floor(g.average * 100 + 0.5) / 100 AS average_2dp, m.category_text,
       coalesce(CAST(trunc(m.yearpublished) AS INT), 0) AS yearpublished_int,
       coalesce(CAST(trunc(m.minplayers) AS INT), 0) AS minplayers_int,
       coalesce(CAST(trunc(m.maxplayers) AS INT), 0) AS maxplayers_int,
       coalesce(CAST(trunc(m.playingtime) AS INT), 0) AS playingtime_int,
       coalesce(CAST(trunc(m.minage) AS INT), 0) AS minage_int,
       coalesce(CAST(g.usersrated AS INT), 0) AS usersrated_int,
       printf('%.2f', m.bayesaverage) AS bayesaverage_text
FROM (SELECT d.id, NUM(d.rank_text) AS board_game_rank, d.yearpublished, d.minplayers, d.maxplayers,
             d.playingtime, d.minage, d.bayesaverage, array_to_string(c.category, ', ') AS category_text
      FROM fx_games_detailed d JOIN fx_categories c ON d.id = c.id
      UNION ALL
      SELECT l.id, l.board_game_rank, NULL, NULL, NULL, NULL, NULL, NULL, '' AS category_text
      FROM fx_games_list l WHERE l.id NOT IN (SELECT id FROM fx_games_detailed)) m
LEFT JOIN fx_games g ON m.id = g.id"""),
    "profile_ratings": _with(["fx_reviews", "fx_games"], """
SELECT r.user_id, CAST(r.pos AS INT) AS pos, r.id, g.name, r.rating
FROM (SELECT user_id, id, rating,
             row_number() OVER (PARTITION BY user_id ORDER BY rating DESC NULLS FIRST, id) AS pos
      FROM fx_reviews) r
LEFT JOIN fx_games g ON r.id = g.id
WHERE r.pos > 5 AND r.pos <= 10"""),
    "games_rank_numeric": _with(["fx_games_detailed_all"], """
SELECT id, NUM(rank_text) AS board_game_rank FROM fx_games_detailed_all"""),
    "games_categories": _with(["fx_categories"], """
SELECT id, array_to_string(category, '|') AS category_text, CAST(len(category) AS INT) AS n
FROM fx_categories"""),
    "games_completed": _with(["fx_games_detailed", "fx_games_list", "fx_categories"], """
SELECT d.id, d.primary_name AS name, NUM(d.rank_text) AS board_game_rank,
       d.yearpublished, array_to_string(c.category, '|') AS category_text,
       CAST(len(c.category) AS INT) AS n_categories
FROM fx_games_detailed d JOIN fx_categories c ON d.id = c.id
UNION ALL
SELECT l.id, l.name, l.board_game_rank, CAST(NULL AS DOUBLE) AS yearpublished,
       '' AS category_text, 0 AS n_categories
FROM fx_games_list l WHERE l.id NOT IN (SELECT id FROM fx_games_detailed)"""),
    "reviews_clean": _with(["fx_clean_reviews"], "SELECT user_name, rating, id, pos FROM fx_clean_reviews"),
    "users_dense_ids": _with(["fx_dense_users"], "SELECT user_id, username FROM fx_dense_users"),
    "users_loaded": _with(["fx_dense_users"],
                          "SELECT user_id, username, CAST(NULL AS VARCHAR) AS email FROM fx_dense_users"),
    "reviews_dense": _with(["fx_clean_reviews", "fx_dense_users"], """
SELECT c.rating, c.id, u.user_id FROM fx_clean_reviews c JOIN fx_dense_users u ON c.user_name = u.username"""),
    "reviews_upserted": _with(["fx_upserted"], "SELECT user_id, id, rating FROM fx_upserted"),
    "game_stats_refreshed": _with(["fx_games", "fx_upserted", "fx_accepted_batch"], """
SELECT g.id,
       CASE WHEN t.inc IS NULL THEN g.average ELSE t.avg_rating END AS average,
       CASE WHEN t.inc IS NULL THEN g.usersrated ELSE coalesce(g.usersrated, 0) + t.inc END AS usersrated
FROM fx_games g LEFT JOIN (
  SELECT b.id, b.inc, a.avg_rating FROM
    (SELECT id, count(*) AS inc FROM fx_accepted_batch GROUP BY id) b
    LEFT JOIN (SELECT id, avg(rating) AS avg_rating FROM fx_upserted GROUP BY id) a ON a.id = b.id
) t ON g.id = t.id"""),
    "new_users": _with(["fx_new_users"], "SELECT user_id, username, email FROM fx_new_users"),
    "new_user_messages": _with(["fx_new_users"], """
SELECT CAST(user_id AS VARCHAR) AS key,
       '{"event":"user_created","user_id":' || CAST(user_id AS VARCHAR) || ',"username":"' || username || '"}' AS value
FROM fx_new_users"""),
    "game_stats_corrected": _with(["fx_games", "fx_upserted", "fx_accepted_batch", "fx_reviews"], """
SELECT g.id,
       CASE WHEN t.id IS NULL THEN g.average ELSE t.avg_rating END AS average,
       CASE WHEN t.id IS NULL THEN g.usersrated ELSE coalesce(g.usersrated, 0) + t.inc END AS usersrated
FROM fx_games g LEFT JOIN (
  SELECT b.id, coalesce(n.inc, 0) AS inc, a.avg_rating FROM
    (SELECT DISTINCT id FROM fx_accepted_batch) b
    LEFT JOIN (SELECT id, count(*) AS inc FROM (SELECT DISTINCT user_id, id FROM fx_accepted_batch) p
               WHERE NOT EXISTS (SELECT 1 FROM fx_reviews r WHERE r.user_id = p.user_id AND r.id = p.id)
               GROUP BY id) n ON n.id = b.id
    LEFT JOIN (SELECT id, avg(rating) AS avg_rating FROM fx_upserted GROUP BY id) a ON a.id = b.id
) t ON g.id = t.id"""),
    "duplicate_reviews": _with(["fx_ratings_log"], """
SELECT user_id, id, count(*) AS n FROM fx_ratings_log
WHERE user_id IS NOT NULL AND id IS NOT NULL GROUP BY user_id, id HAVING count(*) > 1"""),
    "orphan_reviews": _with(["fx_reviews", "fx_games_detailed"], """
SELECT id, count(*) AS n FROM fx_reviews
WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM fx_games_detailed WHERE id IS NOT NULL)
GROUP BY id"""),
    "constraint_violations": _with(["fx_users", "fx_games_detailed", "fx_ratings_log", "fx_top5"], """
SELECT 'users(user_id) unique' AS "check", CAST(user_id AS VARCHAR) AS key, count(*) AS n
FROM fx_users WHERE user_id IS NOT NULL GROUP BY user_id HAVING count(*) > 1
UNION ALL
SELECT 'users(email) unique', email, count(*) FROM fx_users WHERE email IS NOT NULL GROUP BY email HAVING count(*) > 1
UNION ALL
SELECT 'games(id) unique', CAST(id AS VARCHAR), count(*) FROM fx_games_detailed WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1
UNION ALL
SELECT 'reviews(id,user_id) unique', CAST(id AS VARCHAR) || ',' || CAST(user_id AS VARCHAR), count(*)
FROM fx_ratings_log WHERE id IS NOT NULL AND user_id IS NOT NULL GROUP BY id, user_id HAVING count(*) > 1
UNION ALL
SELECT 'recommendations(user_id) unique', CAST(user_id AS VARCHAR), count(*) FROM fx_top5 GROUP BY user_id HAVING count(*) > 1
UNION ALL
SELECT 'reviews.id -> games.id', CAST(id AS VARCHAR), count(*) FROM fx_ratings_log
WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM fx_games_detailed WHERE id IS NOT NULL) GROUP BY id
UNION ALL
SELECT 'reviews.user_id -> users.user_id', CAST(user_id AS VARCHAR), count(*) FROM fx_ratings_log
WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT user_id FROM fx_users) GROUP BY user_id
UNION ALL
SELECT 'recommendations.user_id -> users.user_id', CAST(user_id AS VARCHAR), count(*) FROM fx_top5
WHERE user_id NOT IN (SELECT user_id FROM fx_users) GROUP BY user_id"""),
    "recs_popular_top5": _with(["fx_top5"], """
SELECT user_id, array_to_string(lst, ',') AS recommendation_list FROM fx_top5"""),
    "recs_long": _with(["fx_top5"], """
SELECT user_id, CAST(generate_subscripts(lst, 1) AS INT) AS pos, unnest(lst) AS game_id FROM fx_top5"""),
    "recs_hydrated": _with(["fx_users", "fx_top5", "fx_games"], """
SELECT u.user_id, CAST(x.pos AS INT) AS pos, x.id, g.name,
       coalesce(len(r.lst) > 0, false) AS has_recommendations
FROM fx_users u
LEFT JOIN fx_top5 r ON u.user_id = r.user_id
LEFT JOIN (SELECT user_id, generate_subscripts(lst, 1) AS pos, unnest(lst) AS id
           FROM fx_top5) x ON u.user_id = x.user_id
LEFT JOIN fx_games g ON x.id = g.id"""),
    "rating_enriched_views": _with(["fx_views", "fx_reviews"], """
SELECT v.event_id, v.user_id, v.game_id, r.rating
FROM fx_views v LEFT JOIN fx_reviews r ON v.user_id = r.user_id AND v.game_id = r.id"""),
    "event_messages": _with(["fx_messages"], "SELECT event_id, key, value FROM fx_messages"),
    "daily_registrations": _with(["fx_messages"], """
SELECT strftime(timestamp, '%Y-%m-%d') AS date, count(*) AS n
FROM fx_messages WHERE kind = 'user_created' GROUP BY 1"""),
    "daily_game_views": _with(["fx_messages"], """
SELECT strftime(timestamp, '%Y-%m-%d') AS date, CAST(mkey AS INT) AS game_id, count(*) AS n
FROM fx_messages WHERE kind = 'game_viewed' GROUP BY 1, 2"""),
    "daily_report": _with(["fx_daily_counts"], """
SELECT date,
       CAST(coalesce(sum(CASE WHEN kind = 'user_created' THEN n END), 0) AS BIGINT) AS n_users,
       CAST(coalesce(sum(CASE WHEN kind = 'game_viewed' THEN n END), 0) AS BIGINT) AS n_views,
       CAST(count(CASE WHEN kind = 'game_viewed' THEN 1 END) AS BIGINT) AS n_games
FROM fx_daily_counts GROUP BY date"""),
}

ORACLE["reviews_from_dump"] = _with(["fx_reviews_raw"], """
SELECT user_name, rating, id, pos FROM fx_reviews_raw
WHERE user_name IS NOT NULL AND rating IS NOT NULL AND id IS NOT NULL AND pos % 59 <> 0 AND pos % 61 <> 0""")
ORACLE["dump_positions"] = _with(["fx_reviews_raw"], """
SELECT pos, count(*) AS n, count(*) AS places, true AS whole FROM fx_reviews_raw GROUP BY pos""")
ORACLE["reviews_versioned"] = ORACLE["reviews_upserted"]
ORACLE["game_stats_incremental"] = _with(["fx_upserted"], """
SELECT id, avg(rating) AS average, count(rating) AS n FROM fx_upserted GROUP BY id""")
ORACLE["categories_bulk_loaded"] = _with(["fx_categories"], r"""
SELECT id,
       CASE WHEN id % 3 = 0 THEN 'A, ' || id || '|C"D|{x}||back\slash|null|<null>| pad '
            ELSE array_to_string(category, '|') END AS category_text,
       CASE WHEN id % 3 = 0 THEN 8 ELSE CAST(len(category) AS INT) END AS n
FROM fx_categories""")
ORACLE["rating_texts_split"] = _with(["fx_rating_batch"], """
SELECT event_id, num AS rating,
       known AND num IS NOT NULL AND num BETWEEN 1 AND 10 AS accepted
FROM (SELECT event_id, id IN (SELECT p_partkey FROM part) AS known,
             CASE WHEN event_id % 13 = 0 OR event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN 999.0
                  WHEN event_id % 23 = 0 OR event_id % 29 = 0 THEN NULL ELSE rating END AS num
      FROM fx_rating_batch) t""")
ORACLE["daily_documents"] = _with(["fx_daily_counts"], """
SELECT date, '{"date":"' || date || '","user_counts":{'
  || coalesce(string_agg(CASE WHEN kind = 'user_created' THEN '"' || key || '":' || n END, ',' ORDER BY key), '')
  || '},"game_views":{'
  || coalesce(string_agg(CASE WHEN kind = 'game_viewed' THEN '"' || key || '":' || n END, ',' ORDER BY key), '')
  || '}}' AS json
FROM fx_daily_counts GROUP BY date""")
_FIXTURES["fx_broken"] = (("fx_messages",), r"""
SELECT event_id, timestamp, kind, mkey,
       event_id % 31 = 0 AS cut, event_id % 31 <> 0 AND event_id % 37 = 0 AND kind = 'game_viewed' AS no_game,
       CASE WHEN event_id % 31 = 0 THEN substr(value, 1, 12)
            WHEN event_id % 37 = 0 THEN regexp_replace(value, '"game_id":\d+', '"game_id":null')
            WHEN event_id % 41 = 0 THEN regexp_replace(value, '"game_id":(\d+)', '"game_id":"\1"')
            ELSE value END AS value
FROM fx_messages""")
ORACLE["dead_letters"] = _with(["fx_broken"], "SELECT event_id, value FROM fx_broken WHERE cut OR no_game")
ORACLE["text_id_views"] = _with(["fx_broken"], """
SELECT strftime(timestamp, '%Y-%m-%d') AS date, CAST(mkey AS INT) AS game_id, count(*) AS n
FROM fx_broken WHERE kind = 'game_viewed' AND NOT cut AND NOT no_game GROUP BY 1, 2""")
ORACLE["als_structure"] = _with(["fx_reviews"], """
SELECT DISTINCT user_id, true AS at_most_five, true AS none_twice, true AS all_popular, true AS scores_fall,
       true AS first_popular, true AS trained_only FROM fx_reviews""")

ORACLE["als_optimality"] = _with(["fx_reviews"], """
SELECT DISTINCT 'user' AS side, user_id AS key, true AS solves FROM fx_reviews
UNION ALL SELECT DISTINCT 'game' AS side, id AS key, true AS solves FROM fx_reviews""")
ORACLE["als_rmse_by_hand"] = "SELECT true AS rmse_agrees, true AS evaluator_agrees, true AS same_rows"
ORACLE["als_exact_lists"] = _with(["fx_reviews"], """
SELECT DISTINCT user_id, true AS same_scores, true AS same_games, true AS fewer_scored FROM fx_reviews""")

# The stream emits a day once the 1-day watermark has passed its end.
_CLOSED = "CAST(date AS DATE) + INTERVAL 1 DAY <= (SELECT max(timestamp) FROM fx_messages) - INTERVAL 1 DAY"
ORACLE["stream_daily_game_views"] = _with(["fx_messages"], f"""
SELECT * FROM (
SELECT strftime(timestamp, '%Y-%m-%d') AS date, CAST(mkey AS INT) AS game_id, count(*) AS n
FROM fx_messages WHERE kind = 'game_viewed' GROUP BY 1, 2) d WHERE {_CLOSED}""")
ORACLE["stream_daily_registrations"] = _with(["fx_messages"], f"""
SELECT * FROM (
SELECT strftime(timestamp, '%Y-%m-%d') AS date, count(*) AS n
FROM fx_messages WHERE kind = 'user_created' GROUP BY 1) d WHERE {_CLOSED}""")
ORACLE["stream_late_corrected"] = _with(["fx_messages", "fx_daily_counts"], f"""
SELECT date, kind, key, n FROM fx_daily_counts WHERE {_CLOSED}""")

# search texts as meeple.plans.fixtures makes them
ORACLE["search_many_texts"] = """
WITH t AS (SELECT DISTINCT unnest([upper(split_part(p_name, ' ', 2)), substring(p_name, 3, 4),
                                   substring(p_name, 1, 2), substring(p_name, 1, 1)]) AS text FROM part)
SELECT text, CAST(p_partkey AS INT) AS id FROM t JOIN part ON contains(lower(p_name), lower(text)) WHERE text <> ''"""
ORACLE["search_many_wildcards"] = """
WITH t AS (SELECT DISTINCT unnest([substring(split_part(p_name, ' ', 1), 1, 2) || '_' || substring(split_part(p_name, ' ', 1), 4),
                                   substring(p_name, 1, 2) || '%' || right(p_name, 2)]) AS text FROM part)
SELECT text, CAST(p_partkey AS INT) AS id FROM t JOIN part ON p_name ILIKE '%' || text || '%'"""

_RANKED_AFTER = """
SELECT id, average, row_number() OVER (ORDER BY average DESC NULLS FIRST, id) AS pos FROM (
  SELECT g.id, CASE WHEN t.id IS NULL THEN g.average ELSE a.avg_rating END AS average
  FROM fx_games g LEFT JOIN (SELECT DISTINCT id FROM fx_accepted_batch) t ON g.id = t.id
  LEFT JOIN (SELECT id, avg(rating) AS avg_rating FROM fx_upserted GROUP BY id) a ON a.id = t.id) s"""
ORACLE["ranking_after_merge"] = _with(["fx_games", "fx_upserted", "fx_accepted_batch"], _RANKED_AFTER)
ORACLE["deep_pages_after_merge"] = _with(["fx_games", "fx_upserted", "fx_accepted_batch"], f"""
SELECT CAST(page AS INT) AS page, CAST(pos AS INT) AS pos, id, average FROM (
  SELECT *, (pos + 9) // 10 AS page, (count(*) OVER () + 9) // 10 AS last FROM ({_RANKED_AFTER}) r) p
WHERE page IN (1, 2, last // 2, last - 1, last)"""
)
