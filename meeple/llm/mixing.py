"""Operator 8: mix sources to target weights by entropy balancing.

For each source the document rates r nearest to 1 in relative entropy are sought
under ``sum(r * size) = target`` and ``r <= 2``. The dual is convex in one
multiplier per source and gives tilted rates ``min(2, exp(lambda * size / scale))``.
Safeguarded Newton steps on all multipliers run as one distributed aggregation
each. Rates are then rounded into whole copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meeple.llm.common import picked, pin, table, with_gapless_number
from meeple.operators.dense_ids import global_positions

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # of all sizes
MOST = 2.0  # times a source's, and a document's, size
STEPS = 40  # Newton steps at most; about ten are needed
CLOSE = 1e-9  # relative gap to the target at which a source is done
OFFSETS = 64  # starting points tried when rates are rounded

KEY = ["no_source", "src"]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _exact_sum(term: Column) -> Column:
    """A sum that doesn't depend on the order of its terms, so reruns agree."""
    return F.sum(term.cast("decimal(38,10)")).cast("double")


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """(no_source, src, source_size, target) from rows (no_source, src, size).

    Sources in code point order, null last, take the weights in turn. Targets
    are ``min(most * source_size, weight * level)`` with the level that spends
    ``share`` of all sizes; each round fixes the level over the sources that are
    not full yet, from sums over all sources.
    """
    per = sized.groupBy(*KEY).agg(F.sum("size").alias("source_size"))
    per = global_positions(per, KEY, "place", start=0)
    turn = F.col("place") % len(weights)
    weight = F.lit(float(weights[-1]))
    for i, x in list(enumerate(weights))[-2::-1]:
        weight = F.when(turn == i, F.lit(float(x))).otherwise(weight)
    per = pin(per.withColumn("weight", weight).withColumn("full", F.col("source_size") * most))
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while total:
        open_ = F.col("weight") * level < F.col("full") if level else F.lit(True)
        spent, weigh = per.agg(F.sum(F.when(~open_, F.col("full"))).alias("spent"),
                               F.sum(F.when(open_, F.col("weight"))).alias("weigh")).first()
        if not weigh:
            break
        new = (share * total - (spent or 0.0)) / weigh
        if new <= level:
            break
        level = new
    return per.select(*KEY, "source_size",
                      F.least(F.col("full"), F.col("weight") * level).cast("double").alias("target"))


def _rate(lam: Column, x: Column, most: float) -> Column:
    return F.when(lam.isNull(), F.lit(most)).otherwise(
        F.least(F.lit(most), F.exp(F.least(lam * x, F.lit(50.0)))))


def tilts(hist: DataFrame, targets: DataFrame, scale: float, most: float = MOST) -> DataFrame:
    """targets plus ``lam``: the multiplier per source (null: every rate is ``most``).

    hist has a row per (source, size) with n documents: rates depend on nothing
    else, so an aggregation over it is one over all documents.
    """
    x = F.col("size") / F.lit(scale)
    full = F.col("target") >= F.col("source_size") * most * (1 - 1e-12)
    state = pin(targets.withColumn("lam", F.when(full, F.lit(None).cast("double")).otherwise(F.lit(0.0)))
                .withColumn("lo", F.lit(None).cast("double")).withColumn("hi", F.lit(None).cast("double"))
                .withColumn("done", full | (F.col("target") <= 0)))
    for _ in range(STEPS):
        tilt = F.exp(F.least(F.col("lam") * x, F.lit(50.0)))
        tokens = F.col("n") * F.col("size")
        now = (hist.join(state.filter("not done").select(*KEY, "lam"), KEY)
               .groupBy(*KEY)
               .agg(_exact_sum(tokens * F.least(F.lit(most), tilt)).alias("f"),
                    _exact_sum(F.when(tilt < most, tokens * x * tilt).otherwise(F.lit(0.0))).alias("g")))
        gap = F.log(F.col("target") / F.col("f"))
        step = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), gap))
        newton = F.col("lam") + F.when(F.col("g") > 0, gap * F.col("f") / F.col("g")).otherwise(step)
        lo = F.when(gap > 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(gap < 0, F.col("lam")).otherwise(F.col("hi"))
        # a step that leaves the bracket is replaced by its middle, or by doubling
        inside = (newton > F.coalesce(lo, newton - 1)) & (newton < F.coalesce(hi, newton + 1))
        middle = (F.when(lo.isNotNull() & hi.isNotNull(), (lo + hi) / 2)
                  .when(lo.isNotNull(), lo + F.greatest(F.lit(1.0), F.abs(lo)))
                  .otherwise(hi - F.greatest(F.lit(1.0), F.abs(hi))))
        met = (F.abs(gap) < CLOSE) | (F.col("f") <= 0)
        state = pin(
            state.join(now, KEY, "left").select(
                *KEY, "source_size", "target",
                F.when(F.col("done") | F.col("f").isNull() | met, F.col("lam"))
                .when(inside, newton).otherwise(middle).alias("lam"),
                F.when(F.col("f").isNull(), F.col("lo")).otherwise(lo).alias("lo"),
                F.when(F.col("f").isNull(), F.col("hi")).otherwise(hi).alias("hi"),
                (F.col("done") | F.col("f").isNull() | met).alias("done")))
        if not state.filter("not done").limit(1).count():
            break
    else:
        raise ArithmeticError(f"rates of some sources have not met their targets in {STEPS} steps")
    return state.select(*KEY, "source_size", "target", "lam")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per row of docs(doc_id, text, source): doc_id, size, source_size,
    target, taken, rate, copies.

    Null text has size 0; documents of size 0 take nothing. Null sources are one
    source of their own, after all others. Within a source documents stand in
    order of size; their rates are summed along it and a document gets a copy
    where the sum passes a whole number, so the words taken miss the target by at
    most the largest size; the starting point that misses least is kept of 64.
    Equal sizes are told apart by a hash of doc_id. An empty table gives no row.
    """
    docs = picked(docs, "doc_id", "text", "source")
    sized = pin(docs.select(
        "doc_id", F.monotonically_increasing_id().alias("row"), word_count(F.col("text")).alias("size"),
        F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("src")))
    hist = pin(sized.filter("size > 0").groupBy(*KEY, "size").agg(F.count(F.lit(1)).alias("n")))
    scale = hist.agg(F.sum(F.col("n") * F.col("size")) / F.sum("n")).first()[0] or 1.0
    targets = pin(source_targets(sized, weights, share, most))
    solved = tilts(hist, targets, scale, most)

    # a row per (source, size): the running sums are over distinct sizes, at most
    # as many as the longest document has words
    rated = (hist.join(solved, KEY)
             .withColumn("rate", F.when(F.col("target") <= 0, F.lit(0.0)).otherwise(
                 _rate(F.col("lam"), F.col("size") / F.lit(scale), most)))
             .withColumn("upto", F.sum(F.col("n") * F.col("rate")).over(
                 Window.partitionBy(*KEY).orderBy(F.desc("size"))
                 .rowsBetween(Window.unboundedPreceding, 0))))

    def copies(u: Column) -> Column:
        end, start = F.col("upto"), F.col("upto") - F.col("n") * F.col("rate")
        return F.greatest(F.lit(0.0), F.least(F.col("n") * most, F.floor(end + u + 1e-9)
                                              - F.floor(start + u + 1e-9))).cast("long")

    tried = rated.groupBy(*KEY).agg(
        F.first("target").alias("target"),
        *[F.sum(copies(F.lit((i + 0.5) / OFFSETS)) * F.col("size")).alias(f"u{i}") for i in range(OFFSETS)])
    best = tried.select(*KEY, F.array_min(F.array(*[
        F.struct(F.abs(F.col(f"u{i}") - F.col("target")).alias("miss"),
                 F.lit((i + 0.5) / OFFSETS).alias("u")) for i in range(OFFSETS)]))["u"].alias("u"))
    groups = rated.join(best, KEY).select(*KEY, "size", "n", "rate", copies(F.col("u")).alias("take"))

    numbered = with_gapless_number(sized.filter("size > 0"), [*KEY, "size"], "doc_id",
                                   [F.xxhash64("doc_id"), "doc_id", "row"], "k", blocks=64)
    given = (numbered.join(groups, [*KEY, "size"])
             .select("row", "rate", (F.floor((F.col("k") + 1) * F.col("take") / F.col("n"))
                                     - F.floor(F.col("k") * F.col("take") / F.col("n"))).alias("copies")))
    return (sized.join(given, "row", "left").join(targets, KEY)
            .select("doc_id", "size", "source_size", "target",
                    (F.col("size") * F.coalesce("copies", F.lit(0))).cast("long").alias("taken"),
                    F.coalesce("rate", F.lit(0.0)).alias("rate"),
                    F.coalesce("copies", F.lit(0)).cast("int").alias("copies")))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
