"""Constraint checks declared by the reference's schema, run as jobs (Q1, Q2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The keys the schema declares unique, and its foreign keys.
UNIQUE_KEYS = {
    "users": [("user_id",), ("email",)],
    "games": [("id",)],
    "reviews": [("id", "user_id")],
    "recommendations": [("user_id",)],
}
FOREIGN_KEYS = [
    ("reviews", "id", "games", "id"),
    ("reviews", "user_id", "users", "user_id"),
    ("recommendations", "user_id", "users", "user_id"),
]


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q1: key values held by more than one row, with their count ``n``.

    Rows with a null key part are ignored (a UNIQUE column allows many
    nulls). The count is combined map-side, so a hot key costs one row per
    task in the shuffle.
    """
    present = df.dropna("any", subset=list(keys))
    return (present.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Q2 / F8: child rows whose non-null key has no parent row."""
    p = parent.select(F.col(parent_key).alias(child_key)).filter(F.col(child_key).isNotNull())
    return child.filter(F.col(child_key).isNotNull()).join(p, child_key, "left_anti")


def orphan_counts(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Q2 summary: missing parent key -> number of child rows pointing at it.

    Children are counted per key first (combined map-side), so the join sees one
    row per key instead of the whole child table.
    """
    per_key = (child.filter(F.col(child_key).isNotNull())
               .groupBy(child_key).agg(F.count(F.lit(1)).alias("n")))
    return orphans(per_key, child_key, parent, parent_key)


def drop_duplicate_keys(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Repair of Q1: one row per key, the last in ``order`` (ties: the greatest row).

    ``max`` over a struct is combined map-side; rows with a null key part are
    kept as they are, as a UNIQUE column allows them.
    """
    rest = [c for c in df.columns if c not in keys]
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    first = F.struct(*order, *[c for c in rest if c not in order])
    one = (df.filter(~has_null).groupBy(*keys).agg(F.max(first).alias("_r"))
           .select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns]))
    return one.unionByName(df.filter(has_null))


def constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Q1 + Q2 over every declared key: (check, key, n) per violation.

    ``key`` is the offending key as text (parts joined by ','); ``n`` is the
    number of rows holding a duplicate key, or pointing at a missing parent.
    Tables absent from ``tables`` are skipped.
    """
    parts = []
    for name, keysets in UNIQUE_KEYS.items():
        if name not in tables:
            continue
        for keys in keysets:
            d = duplicate_keys(tables[name], keys)
            parts.append(d.select(
                F.lit(f"{name}({','.join(keys)}) unique").alias("check"),
                F.concat_ws(",", *[F.col(k).cast("string") for k in keys]).alias("key"), "n"))
    for child, ck, parent, pk in FOREIGN_KEYS:
        if child not in tables or parent not in tables:
            continue
        o = orphan_counts(tables[child], ck, tables[parent], pk)
        parts.append(o.select(F.lit(f"{child}.{ck} -> {parent}.{pk}").alias("check"),
                              F.col(ck).cast("string").alias("key"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
