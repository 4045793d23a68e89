"""R1 and deep pages: exact global positions without a single-partition window.

``row_number() over (order by ...)`` with no partition moves every row into
one task. Instead the rows are range-partitioned on the full order key
(``repartitionByRange`` samples the key, so hot or repeated leading values
are spread as long as the full key is distinct) and sorted inside each
partition. ``monotonically_increasing_id`` then reads as (partition index,
row index in sorted order). That pair is pinned by one checkpoint to the
shared folder; each partition is shifted by the number of rows in the
partitions before it (a table with one row per partition, broadcast).
Work per task stays ~n/B; the result equals the global row_number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ROW_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index


def _as_columns(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c).asc() if isinstance(c, str) else c for c in order]


def global_positions(df: DataFrame, order: Sequence[Column | str], pos_col: str = "pos",
                     start: int = 1, partitions: int | None = None) -> DataFrame:
    """Add ``pos_col`` = start + 0-based position of the row in ``order``.

    ``order`` may hold sort expressions (``F.col('x').desc_nulls_first()``).
    Rows equal in the whole key get consecutive positions in arbitrary order,
    as in row_number; add a unique tie-breaker for a stable result.
    """
    from meeple.session import checkpoint_dir
    spark = df.sparkSession
    checkpoint_dir(spark)
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    cols = _as_columns(order)
    mid = F.monotonically_increasing_id()
    ranged = (df.repartitionByRange(max(1, partitions), *cols)
              .sortWithinPartitions(*cols)
              .withColumn("_mid", mid))
    # the ids depend on the physical layout: pin them once, reliably
    pinned = ranged.checkpoint(eager=True)
    pinned = (pinned.withColumn("_part", F.shiftright("_mid", _ROW_BITS))
                    .withColumn("_rn", F.col("_mid") - F.shiftleft(F.col("_part"), _ROW_BITS)))
    counts = pinned.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: the single-partition window and the broadcast are bounded
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    out = pinned.join(F.broadcast(offsets), "_part")
    return (out.withColumn(pos_col, F.lit(start) + F.col("_offset") + F.col("_rn"))
               .drop("_mid", "_part", "_rn", "_offset"))


def dense_ids(df: DataFrame, order_col: str, id_col: str,
              tie_breakers: Sequence[str] = (), start: int = 0,
              partitions: int | None = None) -> DataFrame:
    """Add int ``id_col`` = start + rank0 of each row by (order_col, *tie_breakers)."""
    order = [F.col(order_col).asc()] + [F.col(c).asc() for c in tie_breakers]
    out = global_positions(df, order, "_pos", start=start, partitions=partitions)
    return out.withColumn(id_col, F.col("_pos").cast("int")).drop("_pos")
