"""JDBC source and sink.

The reference reads the reviews with fixed bounds 1..15,000,000 over 10
partitions while its user ids start at 0 and are dense, so one stride holds
almost every row. Here the database counts its rows by ranges of the key, ranges with
many rows again by smaller ones, and every task gets a range of about as many rows,
whatever gaps the keys have.

The reference empties a table and then fills it; readers see it half done, and a
failure leaves it so. Here all rows go to a table beside it first, and one
transaction puts them in place.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CELLS = 4  # ranges counted for each task wanted
MOST_CELLS = 10_000  # of one count


def _props(properties: dict | None, fetchsize: int) -> dict:
    p = dict(properties or {})
    p.setdefault("fetchsize", str(fetchsize))
    return p


def _quoted(column: str) -> str:
    return column if column.startswith('"') else f'"{column}"'  # ANSI quoting keeps the case


def key_bounds(spark: SparkSession, url: str, table: str, column: str,
               properties: dict | None = None) -> tuple:
    """(min, max, count) of ``column``, computed by the database."""
    c = _quoted(column)
    q = f"(SELECT MIN({c}) AS lo, MAX({c}) AS hi, COUNT(*) AS n FROM {table}) b"
    row = spark.read.jdbc(url, q, properties=_props(properties, 1000)).first()
    return row[0], row[1], row[2]


def counted_ranges(spark: SparkSession, url: str, table: str, column: str, lo: int, hi: int, most: int,
                   cells: int, properties: dict | None = None) -> list[tuple[int, int, int]]:
    """(start, end, rows) ranges of an integer key, in order, none with more than ``most``
    rows unless it holds one key. The database counts by equal ranges, then again
    within those that hold too many: a query per such range, few rows each."""
    c, todo, done = _quoted(column), [(lo, hi + 1)], []
    while todo:
        start, end = todo.pop()
        width = max(1, -(-(end - start) // min(cells, MOST_CELLS)))
        q = (f"(SELECT cell, COUNT(*) AS n FROM (SELECT CAST(FLOOR(CAST({c} - ({start}) AS DOUBLE PRECISION) / {width}) "
             f"AS BIGINT) AS cell FROM {table} WHERE {c} >= {start} AND {c} < {end}) k GROUP BY cell) b")
        for cell, n in sorted((int(r[0]), int(r[1])) for r in
                              spark.read.jdbc(url, q, properties=_props(properties, 1000)).collect()):
            s = start + cell * width
            e = min(end, s + width)
            if n > most and 1 < e - s < end - start:
                todo.append((s, e))
            else:
                done.append((s, e, n))
    return sorted(done)


def even_predicates(column: str, ranges: list[tuple[int, int, int]], most: int) -> list[str]:
    """Predicates that cut a table into parts of about ``most`` rows: neighbouring ranges
    are joined while they fit. Together they hold every row once, null keys and keys
    outside the ranges included."""
    c, cuts, rows = _quoted(column), [], 0
    for start, _, n in ranges:
        if rows and rows + n > most:
            cuts.append(start)
            rows = 0
        rows += n
    if not cuts:
        return ["1 = 1"]
    return ([f"{c} < {cuts[0]} OR {c} IS NULL"]
            + [f"{c} >= {a} AND {c} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)] + [f"{c} >= {cuts[-1]}"])


def read_partitioned(spark: SparkSession, url: str, table: str, column: str,
                     properties: dict | None = None, *, rows_per_partition: int = 1_000_000,
                     max_partitions: int | None = None, fetchsize: int = 1000) -> DataFrame:
    """A read in ranges of an integer key that hold about as many rows each.

    The number of tasks follows the row count, so a task's share stays the same;
    ``max_partitions`` caps it only where the database allows no more readers. Uneven
    keys (gaps, dense spots) make uneven ranges, not uneven tasks; a key that is
    itself more than a share stays in one task. Null keys go with the first range.
    """
    lo, hi, n = key_bounds(spark, url, table, column, properties)
    props = _props(properties, fetchsize)
    if lo is None or hi is None or n == 0 or hi <= lo:
        return spark.read.jdbc(url, table, properties=props)
    parts = max(1, -(-int(n) // rows_per_partition))
    if max_partitions:
        parts = min(max_partitions, parts)
    most = -(-int(n) // parts)
    if parts == 1:
        return spark.read.jdbc(url, table, properties=props)
    ranges = counted_ranges(spark, url, table, column, int(lo), int(hi), max(1, most // 2), CELLS * parts, properties)
    return spark.read.jdbc(url, table, predicates=even_predicates(column, ranges, most), properties=props)


def _connection(spark: SparkSession, url: str, properties: dict | None):
    """A connection of the driver's own, for what Spark's writer cannot do in one
    transaction."""
    jvm = spark._jvm
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        if k == "driver":
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(v)
        else:
            props.setProperty(k, str(v))
    return jvm.java.sql.DriverManager.getConnection(url, props)


def _execute(connection, *statements: str) -> None:
    for sql in statements:
        s = connection.createStatement()
        try:
            s.execute(sql)
        finally:
            s.close()


def _exists(connection, table: str) -> bool:
    try:
        _execute(connection, f"SELECT * FROM {table} WHERE 1 = 0")
        return True
    except Exception:  # noqa: BLE001  the database's own kind of error
        return False


def write_replace(df: DataFrame, url: str, table: str, properties: dict | None = None,
                  batchsize: int = 10_000) -> None:
    """Replace the table's rows in one step, keeping the table and its constraints.

    The rows are written, in parallel, to a table of their own. Then one transaction
    deletes the old rows and takes over the new ones: readers see the one or the
    other, and if anything fails, a lost task or a broken constraint, the old rows
    stay. A missing table is made first. The table beside it is dropped either way.
    """
    spark, props = df.sparkSession, dict(properties or {})
    stage = f"{table}_stage_{uuid.uuid4().hex[:12]}"
    columns = ", ".join(_quoted(c) for c in df.columns)
    connection = _connection(spark, url, props)
    try:
        if not _exists(connection, table):
            df.limit(0).write.jdbc(url, table, properties=props)
        df.write.option("batchsize", str(batchsize)).jdbc(url, stage, properties=props)
        connection.setAutoCommit(False)
        try:
            _execute(connection, f"DELETE FROM {table}",
                     f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {stage}")
            connection.commit()
        except Exception:
            connection.rollback()
            raise
    finally:
        connection.setAutoCommit(True)
        if _exists(connection, stage):
            _execute(connection, f"DROP TABLE {stage}")
        connection.close()
