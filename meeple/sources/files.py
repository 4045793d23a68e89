"""File sources and sinks.

Raw CSV dumps are read with explicit schemas. Free-text columns (descriptions,
comments) may hold quoted newlines; ``quoted_csv`` finds the records of such a file
in many tasks. ``land`` writes a dump to Parquet once, later work is done from there.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meeple.functions import text
from meeple.sources import quoted_csv

# What the unnamed row-number column of a dump is called in a header.
ROW_NUMBER_NAMES = ("", "_c0", "Unnamed: 0", "_row")


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV header as written (an unnamed column gives '')."""
    first = (spark.read.option("header", "false").option("quote", '"').option("escape", '"')
             .option("inferSchema", "false").csv(path).limit(1).collect())
    return [("" if v is None else v).strip() for v in first[0]] if first else []


def _named_schema(header: list[str], schema: T.StructType) -> T.StructType:
    """The file's full schema: wanted columns under their name and type, all others
    as unread text. A wanted column must be there once; ``_row`` may be missing."""
    wanted = {f.name: f for f in schema.fields}
    place = {}
    for i, h in enumerate(header):
        name = "_row" if "_row" in wanted and i == 0 and h in ROW_NUMBER_NAMES else h
        if name in wanted:
            if name in place:
                raise ValueError(f"column {name!r} appears twice in the header")
            place[name] = i
    missing = [n for n in wanted if n not in place and n != "_row"]
    if missing:
        raise ValueError(f"columns not found in the header: {missing}")
    at = {i: n for n, i in place.items()}
    return T.StructType([T.StructField(at[i], wanted[at[i]].dataType, True) if i in at
                         else T.StructField(f"_unread{i}", T.StringType(), True)
                         for i in range(len(header))])


def read_csv(spark: SparkSession, path: str, schema: T.StructType, *, by_name: bool = True,
             multiline: bool = True, null_tokens: Iterable[str] = ("",),
             position: str | None = None) -> DataFrame:
    """S1 + E2: CSV with a header row as ``schema``.

    Columns are found by their name in the header, so a wider dump or another
    column order reads right and a missing column is an error; columns not asked
    for are never parsed. ``by_name=False`` reads by position (the bulk load S3).
    Quotes are doubled inside quoted fields (``""``), as pandas writes them, and
    quoted newlines are part of the text (a file is cut into splits all the same, see
    ``quoted_csv``) unless ``multiline`` is turned off. ``position`` names a column for
    the order of the records in the file (needs ``multiline``).
    Spark's reader knows one null token (the empty field); further tokens
    (e.g. ``text.PANDAS_NULL_TOKENS``) are applied to the string columns, and a
    number column is null where its text is no number or NaN.
    """
    full = schema
    if by_name:
        header = header_of(spark, path)
        full = _named_schema(header, schema) if header else schema
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    if multiline:
        df = quoted_csv.read(spark, path, full, options, position)
    elif position:
        raise ValueError("positions are known in multiline mode only")
    else:
        df = spark.read.schema(full).options(header="true", **options).csv(path)
    extra = [t for t in null_tokens if t != ""]
    cols = []
    for f in schema.fields:
        if f.name not in df.columns:
            c = F.lit(None).cast(f.dataType)
        elif isinstance(f.dataType, T.StringType) and extra:
            c = text.null_tokens(F.col(f"`{f.name}`"), extra)
        elif isinstance(f.dataType, T.DoubleType):
            c = text.finite(F.col(f"`{f.name}`"))
        else:
            c = F.col(f"`{f.name}`")
        cols.append(c.alias(f.name))
    return df.select(*cols, *([F.col(f"`{position}`")] if position else []))


def land(df: DataFrame, name: str) -> DataFrame:
    """Write once as Parquet to the shared scratch folder and read back."""
    from meeple.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Iterable[str] = ()) -> None:
    """Overwrite a table folder (Parquet by default; CSV with a header)."""
    w = df.write.mode("overwrite")
    parts = list(partition_by)
    if parts:
        w = w.partitionBy(*parts)
    if fmt == "csv":
        w.option("header", "true").option("escape", '"').option("emptyValue", "").option("quoteAll", "false").csv(path)
    else:
        w.format(fmt).save(path)


def _array_literal(col):
    """Array column -> the ``{a,b}`` text form of an array in a CSV dump; elements
    with a comma, quote, backslash, brace or blank, empty ones and the word NULL
    are quoted, null elements are written NULL."""
    def element(x):
        quoted = F.concat(F.lit('"'), F.regexp_replace(x, r'(["\\])', r"\\$1"), F.lit('"'))
        return F.when(x.isNull(), F.lit("NULL")).when(x.rlike(r'^$|[",{}\\\s]|^(?i:null)$'), quoted).otherwise(x)
    return F.concat(F.lit("{"), F.array_join(F.transform(col, element), ","), F.lit("}"))


# one element of array text: quoted (with escapes) or bare
_ELEMENT = r'("(?:[^"\\]|\\.)*"|[^,"{}]+)'


def _parsed_array(col):
    """``{a,"b, c"}`` text -> array: quoted elements lose quotes and escapes, bare
    ones their blanks; a bare NULL is a null element."""
    def element(x):
        inner = F.regexp_replace(F.substring(x, 2, F.length(x) - 2), r"(?s)\\(.)", "$1")
        bare = F.trim(x)
        return F.when(x.startswith('"'), inner).when(F.upper(bare) != "NULL", bare)
    found = F.filter(F.regexp_extract_all(col, F.lit(_ELEMENT), F.lit(1)), lambda x: F.trim(x) != "")
    return F.when(col.isNotNull(), F.transform(found, element))


def load_positional(spark: SparkSession, path: str, target: T.StructType) -> DataFrame:
    """S3: bulk load a CSV with a header into ``target`` columns by position.

    Array columns arrive as ``{a,b}`` text with quoted elements where needed.
    """
    read_schema = T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.ArrayType) else f.dataType, True)
        for f in target.fields])
    df = read_csv(spark, path, read_schema, by_name=False)
    return df.select(*[(_parsed_array(F.col(f"`{f.name}`")).cast(f.dataType) if isinstance(f.dataType, T.ArrayType)
                        else F.col(f"`{f.name}`")).alias(f.name) for f in target.fields])


def write_for_bulk_load(df: DataFrame, path: str) -> None:
    """S2 for the bulk-load path: arrays as ``{a,b}`` text, CSV with header."""
    cols = [(_array_literal(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.ArrayType)
             else F.col(f"`{f.name}`")) for f in df.schema.fields]
    write_table(df.select(*cols), path, fmt="csv")
