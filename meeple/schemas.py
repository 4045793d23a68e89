"""Table and event schemas (S9) and the raw-dump schemas read by the ETL.

Stored tables use fixed types; raw dumps are read with explicit schemas, never
inferred. Column order of the stored tables is the positional order used by
the bulk load (S3).
"""

from pyspark.sql import types as T

USERS = T.StructType([
    T.StructField("user_id", T.IntegerType(), False),
    T.StructField("username", T.StringType(), True),
    T.StructField("email", T.StringType(), True),
])

GAMES = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("thumbnail", T.StringType(), True),
    T.StructField("image", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
    T.StructField("yearpublished", T.DoubleType(), True),
    T.StructField("minplayers", T.DoubleType(), True),
    T.StructField("maxplayers", T.DoubleType(), True),
    T.StructField("playingtime", T.DoubleType(), True),
    T.StructField("minage", T.DoubleType(), True),
    T.StructField("category", T.ArrayType(T.StringType()), True),
    T.StructField("usersrated", T.DoubleType(), True),
    T.StructField("average", T.DoubleType(), True),
    T.StructField("bayesaverage", T.DoubleType(), True),
    T.StructField("board_game_rank", T.DoubleType(), True),
])

REVIEWS = T.StructType([
    T.StructField("rating", T.DoubleType(), True),
    T.StructField("id", T.IntegerType(), False),
    T.StructField("user_id", T.IntegerType(), False),
])

RECOMMENDATIONS = T.StructType([
    T.StructField("user_id", T.IntegerType(), False),
    T.StructField("recommendation_list", T.ArrayType(T.IntegerType()), True),
])

# Long form of the recommendations table, for sinks without array columns.
RECOMMENDATIONS_LONG = T.StructType([
    T.StructField("user_id", T.IntegerType(), False),
    T.StructField("pos", T.IntegerType(), False),
    T.StructField("game_id", T.IntegerType(), False),
])

# One struct for every message kind on the events topic; fields absent from a
# kind stay null.
EVENT = T.StructType([
    T.StructField("event", T.StringType(), True),
    T.StructField("user_id", T.IntegerType(), True),
    T.StructField("game_id", T.StringType(), True),  # a number or its text
    T.StructField("username", T.StringType(), True),
])

# Kafka record shape used by the event source and sink.
KAFKA_RECORD = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])

# Raw catalogue dump with detailed info; text columns that the ETL coerces
# are read as strings.
RAW_GAMES_DETAILED = T.StructType([
    T.StructField("_row", T.StringType(), True),
    T.StructField("id", T.IntegerType(), True),
    T.StructField("primary", T.StringType(), True),
    T.StructField("thumbnail", T.StringType(), True),
    T.StructField("image", T.StringType(), True),
    T.StructField("description", T.StringType(), True),
    T.StructField("yearpublished", T.DoubleType(), True),
    T.StructField("minplayers", T.DoubleType(), True),
    T.StructField("maxplayers", T.DoubleType(), True),
    T.StructField("playingtime", T.DoubleType(), True),
    T.StructField("minage", T.DoubleType(), True),
    T.StructField("boardgamecategory", T.StringType(), True),
    T.StructField("usersrated", T.DoubleType(), True),
    T.StructField("average", T.DoubleType(), True),
    T.StructField("bayesaverage", T.DoubleType(), True),
    T.StructField("Board Game Rank", T.StringType(), True),
])

# Raw ranking list dump (second catalogue source).
RAW_GAMES_LIST = T.StructType([
    T.StructField("_row", T.StringType(), True),
    T.StructField("ID", T.IntegerType(), True),
    T.StructField("Name", T.StringType(), True),
    T.StructField("Year", T.DoubleType(), True),
    T.StructField("Rank", T.DoubleType(), True),
    T.StructField("Average", T.DoubleType(), True),
    T.StructField("Bayes average", T.DoubleType(), True),
    T.StructField("Users rated", T.DoubleType(), True),
    T.StructField("URL", T.StringType(), True),
    T.StructField("Thumbnail", T.StringType(), True),
])

# Raw review dump.
RAW_REVIEWS = T.StructType([
    T.StructField("_row", T.StringType(), True),
    T.StructField("user", T.StringType(), True),
    T.StructField("rating", T.DoubleType(), True),
    T.StructField("comment", T.StringType(), True),
    T.StructField("ID", T.IntegerType(), True),
    T.StructField("name", T.StringType(), True),
])
