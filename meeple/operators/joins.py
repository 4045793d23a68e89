"""Joins whose left side may carry many null keys (signed-out users, users
without a list, rows without a game).

A null key never matches, but a hash shuffle sends every null key to the
same partition: if a third of the rows are signed out, one task gets a third
of the data. Here rows with a null key get a second join key, spread over many
values; on the other side it is always 0. The keys themselves are untouched, so
Spark compares them by its own rules (common type of both sides, decimals and
strings included). One scan, one join, no hot partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NULL_BUCKETS = 4096


def join_spreading_nulls(left: DataFrame, right: DataFrame, on: Sequence[str],
                         how: str = "left", buckets: int = NULL_BUCKETS) -> DataFrame:
    """``left.join(right, on, how)`` for how in left / left_semi / left_anti,
    with null keys of ``left`` spread over ``buckets`` shuffle buckets.

    Output columns are those of ``left.join(right, on, how)``.
    """
    if how not in ("left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    on = list(on)
    any_null = F.lit(False)
    for c in on:
        any_null = any_null | F.col(c).isNull()
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(buckets))
    # 0 on the right as a value of the row: a literal would be folded into a
    # filter on the left and no longer be a join key
    zero = F.pmod(F.xxhash64(*[F.col(c) for c in on]), F.lit(1))
    l2 = left.withColumn("_spread", F.when(any_null, spread).otherwise(F.lit(0).cast("long")))
    r2 = right.withColumn("_spread", zero)
    return l2.join(r2, [*on, "_spread"], how).drop("_spread")
