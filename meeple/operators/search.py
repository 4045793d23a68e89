"""F4 for a table of search texts: one join instead of a scan per text.

Names are taken apart into grams (runs of one, two and three characters). A text's
rarest gram, by the number of names that hold it, brings the candidates in an
equi-join, and the text itself decides. No text meets a name that lacks its gram.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meeple.session import checkpoint_dir

LONGEST_GRAM = 3
FEW_TEXTS = 100_000  # texts with their grams up to which they are sent to all tasks
ANY = ""  # the gram of every name: for texts of nothing but wildcards


def grams(c: Column, sizes: range = range(1, LONGEST_GRAM + 1)) -> Column:
    """Distinct runs of characters of these sizes."""
    def of(size: int) -> Column:
        last = F.length(c) - size + 1
        starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substring(c, i, F.lit(size)))
    return F.array_distinct(F.concat(*[of(s) for s in sizes]))


def search_many(games: DataFrame, texts: DataFrame, wildcards: bool = False) -> DataFrame:
    """(text, id, name) for each distinct text of texts(text) and each game whose name
    contains it, ignoring case.

    As ``catalog.search``: empty and null texts find nothing; ``wildcards`` keeps % and
    _ as LIKE wildcards, a backslash being itself. Texts are as many as they like, and
    so are the games of one text: result rows are never gathered. A gram that many
    names hold serves only texts that have no rarer one, and its postings spread by
    AQE's skewed joins. Of all tables only the texts, if they are few, go to all tasks:
    names compress so well and have so many grams that the size of their file says
    nothing about that of the postings.
    """
    spark = games.sparkSession
    games = games.select("id", "name", F.lower("name").alias("_low")).filter("name IS NOT NULL")
    # a small file of names is many postings: taken apart by all tasks
    games = games.repartition(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), "id")
    asked = (texts.select("text").filter("text IS NOT NULL AND text <> ''").distinct()
             .withColumn("_low_text", F.lower("text")))
    postings = games.select("id", F.explode(F.array_append(grams(F.col("_low")), F.lit(ANY))).alias("gram"))
    held = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    pieces = F.split("_low_text", "[%_]") if wildcards else F.array("_low_text")

    def own(piece: Column) -> Column:
        # the longest grams of a piece are at least as rare as the ones they contain
        whole = F.array(piece)
        return F.when(F.length(piece) == 0, F.array().cast("array<string>")).when(
            F.length(piece) <= LONGEST_GRAM, whole).otherwise(grams(piece, range(LONGEST_GRAM, LONGEST_GRAM + 1)))
    wanted = F.array_distinct(F.flatten(F.transform(pieces, own)))
    wanted = F.when(F.size(wanted) == 0, F.array(F.lit(ANY))).otherwise(wanted)
    by_gram = asked.select("text", "_low_text", F.explode(wanted).alias("gram")).join(held.hint("merge"), "gram", "left")
    # a gram that no name holds (n null) sorts first, and its text finds nothing
    rarest = Window.partitionBy("text").orderBy(F.asc_nulls_first("n"), "gram")
    chosen = by_gram.withColumn("_r", F.row_number().over(rarest)).filter("_r = 1 AND n IS NOT NULL")
    checkpoint_dir(spark)
    chosen = chosen.select("text", "_low_text", "gram").checkpoint(eager=True)
    few = chosen.limit(FEW_TEXTS + 1).count() <= FEW_TEXTS
    chosen = F.broadcast(chosen) if few else chosen.hint("merge")
    found = chosen.join(postings, "gram").join(games.hint("merge"), "id")
    if wildcards:
        pattern = F.concat(F.lit("%"), F.replace("_low_text", F.lit("\\"), F.lit("\\\\")), F.lit("%"))
        found = found.withColumn("_pattern", pattern).filter(F.expr("_low LIKE _pattern"))
    else:
        found = found.filter(F.contains("_low", "_low_text"))
    return found.select("text", "id", "name")
