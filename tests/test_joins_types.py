"""join_spreading_nulls equals the plain join for every pair of key types."""

import itertools

import pytest

from meeple.operators.joins import join_spreading_nulls

VALUES = {
    "int": ["5", "7", "null", "0"], "bigint": ["5", "8", "null", "1099511627776"],
    "double": ["5.0D", "5.5D", "null", "7.0D"], "decimal(10,2)": ["5.00", "5.50", "null", "8.00"],
    "string": ["'5'", "'7.0'", "null", "'x'"],
}


def _frame(spark, kind, name):
    rows = ", ".join(f"({i}, CAST({v} AS {kind}))" for i, v in enumerate(VALUES[kind]))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({name}, k)")


@pytest.mark.parametrize("left, right", [*itertools.product(VALUES, VALUES)])
def test_equals_plain_join(spark, left, right):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")  # text that is no number compares as null
    try:
        a, b = _frame(spark, left, "x"), _frame(spark, right, "y")
        for how in ("left", "left_semi", "left_anti"):
            want, got = a.join(b, ["k"], how), join_spreading_nulls(a, b, ["k"], how)
            assert got.columns == want.columns and got.dtypes == want.dtypes
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
