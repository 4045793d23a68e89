"""The corpus pipeline: five stages over ``documents``, each built on one operator.

Every stage takes the documents that the one before kept and returns the columns
of ``documents`` (the last one adds piece ids). Null and repeated rows are treated
as each operator's docstring says; an empty table passes through as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meeple.llm import exact_dedup, mixing, near_dedup, piece_fst, toxicity
from meeple.llm.common import SPACE, fresh, pin, stored, table
from meeple.session import scratch_path

BROADCAST_ROWS = 100_000  # ids with a digest (10 MB) up to which a join is broadcast


def _few(rows: DataFrame) -> DataFrame:
    """Marked for a broadcast if its size was found small enough, else as it is."""
    small = rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(rows) if small else rows


def _all(docs: DataFrame) -> list[Column]:
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    model, score = toxicity.train(docs, table(spark, sf_dir, "labels")), fresh("_score", docs)
    return toxicity.with_score(docs, model, score).filter(F.col(score) < 0.5).select(*_all(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    found = pin(exact_dedup.exact_groups(docs).select("doc_id", "text_sha256", "kept", "group_size"))
    per_key = found.filter("group_size > 1").groupBy("doc_id", "text_sha256").agg(
        F.max("kept").alias("stays"), F.count(F.lit(1)).alias("n"))
    other_id, other_sha, mine = (fresh(c, docs) for c in ("_id", "_sha", "_digest"))
    keys = [F.col("doc_id").alias(other_id), F.col("text_sha256").alias(other_sha)]
    gone = _few(per_key.filter("NOT stays OR n > 1").select(*keys))
    digest = F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), SPACE, " ").cast("binary"), 256)
    marked = docs.withColumn(mine, digest)
    same = F.col("doc_id").eqNullSafe(F.col(other_id)) & (F.col(mine) == F.col(other_sha))
    out = marked.join(gone, same, "left_anti")
    repeated = per_key.filter("stays AND n > 1").select(*keys)
    if repeated.limit(1).count():  # rows that repeat an id and its text: one of them
        out = out.union(marked.join(_few(repeated), same, "left_semi").dropDuplicates(["doc_id", mine]))
    return out.select(*_all(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, and all that have none; rows without a
    doc_id too. The operator's own contract fixes the shingles: four words."""
    row, other = fresh("_row", docs), fresh("_gone", docs)
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "pipeline-near-rows")
    groups = near_dedup.row_groups(rows.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"))
    gone = pin(groups.filter("NOT kept").select(F.col("row").alias(other)))
    return rows.join(_few(gone), F.col(row) == F.col(other), "left_anti").select(*_all(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; rows that repeat a doc_id are
    taken as often as the one taken most."""
    other, copies, copy = (fresh(c, docs) for c in ("_id", "_copies", "_copy"))
    taken = (mixing.mix(docs).groupBy(F.col("doc_id").alias(other)).agg(F.max("copies").alias(copies))
             .filter(F.col(copies) > 0))
    out = docs.join(taken, F.col("doc_id").eqNullSafe(F.col(other)))
    return (out.select(*_all(docs), F.explode(F.sequence(F.lit(1), F.col(copies))).alias(copy))
            .select(*_all(docs)))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns plus ``ids`` and ``n_pieces``."""
    return piece_fst.with_ids(docs).withColumn("n_pieces", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: a trained score, verified near copies and piece ids are not SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written as Parquet to the shared
    folder and read again as the next stage's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
