"""Helpers shared by the pipeline operators: table reads, words, hot-key-safe
group statistics and gapless numbering."""

from __future__ import annotations

import ctypes
import functools
import gc
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meeple.session import checkpoint_dir, scratch_path

#: Java/RE2 character class of the white space that every contract names
SPACE = r"[\x20\x09-\x0D]+"
SALTS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Rows of whole texts go to Python tasks 500 at a time instead of 10,000, which
    bounds the memory of both sides; results don't depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")


def picked(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns: extra columns of any name never reach an operator."""
    small_batches(df.sparkSession)
    return df.select(*[df[n] for n in names])


def fresh(name: str, df: DataFrame) -> str:
    """``name``, with underscores in front until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def pin(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder: cuts the lineage, survives lost
    executors, and fixes values that a later plan reads more than once."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def words(text: str | None) -> list[bytes]:
    """``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8 (bytes.split uses that very set)."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def salt(*cols: str, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(salts)).cast("int")


def with_group_stats(df: DataFrame, keys: list[str], spread: str,
                     stats: dict[str, tuple[Column, object]], salts: int = SALTS) -> DataFrame:
    """``df`` plus one column per entry of ``stats``, each an aggregate over the
    whole group of ``keys`` (non-null columns).

    ``stats[name] = (partial, merge)``: ``partial`` aggregates rows, ``merge`` is
    a function over the partial column. A group is cut into ``salts`` parts by
    the column ``spread``: parts are aggregated (with map-side combine), merged
    over at most ``salts`` rows per group, and joined back per part, so a group
    that holds a third of all rows is never in one task.
    """
    df = df.withColumn("_salt", salt(spread, salts=salts))
    parts = df.groupBy(*keys, "_salt").agg(*[p.alias(n) for n, (p, _) in stats.items()])
    whole = Window.partitionBy(*keys)
    merged = parts.select(*keys, "_salt",
                          *[m(F.col(n)).over(whole).alias(n) for n, (_, m) in stats.items()])
    return df.join(merged, [*keys, "_salt"]).drop("_salt")


def with_gapless_number(df: DataFrame, group: list[str], spread: str, order: list[str],
                        name: str, blocks: int = 256) -> DataFrame:
    """``df`` plus a number from 0 without gaps inside each group (non-null columns).

    Rows are dealt to ``blocks`` parts of the group by a hash of ``spread``, parts
    are counted (only the columns that decide the part are read), and each row
    gets the count of the parts before its own plus its place in its part. No
    task sees more than one part, so groups may hold any share of the rows.
    """
    df = df.withColumn("_block", salt(spread, salts=blocks))
    counts = df.groupBy(*group, "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, "_block",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(*group, "_block").orderBy(*order))
    return (df.join(offsets, [*group, "_block"])
            .withColumn(name, (F.col("_before") + place - 1).cast("long"))
            .drop("_block", "_before"))


def heaviest(df: DataFrame, count: str, most: int) -> DataFrame:
    """The rows with the highest ``count`` (positive), as many whole steps of 1/16 of
    a power of two as make ``most`` rows at most. A histogram of the steps, at most
    about a thousand rows, decides: no task sorts or gathers the table."""
    step = F.floor(F.log2(F.col(count).cast("double")) * 16)
    sizes = df.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, total = None, 0
    for r in sorted(sizes, key=lambda r: -r.step):
        total += r.n
        if total > most:
            break
        least = r.step
    return df.filter(step >= least) if least is not None else df.limit(0)


def smallest_hashes(df: DataFrame, column: str, most: int) -> DataFrame:
    """The ``most`` rows with the smallest hash of ``column``: a sample that doesn't
    depend on layout. Rows beyond twice the expected bound are filtered out first,
    so that the final ordering sees few rows whatever the number of tasks."""
    total = df.count()
    place = F.pmod(F.xxhash64(column), F.lit(1 << 40))
    if total > 4 * most:
        df = df.filter(place < int((1 << 40) * 2.0 * most / total))
    return df.orderBy(place, column).limit(most)


def crc_of_id(doc_id: Column | str = "doc_id") -> Column:
    """crc32 of the id as text, the contracts' fold number (null id: crc of '')."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))


@functools.cache
def tokenizer_path(name: str) -> str:
    """Where the public tokenizer files are; the name is a parameter everywhere."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches in smaller pieces, so that few long texts are Python objects at once."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def worker_state(owner: str, key: str, make):
    """A value kept for the life of a Python worker (tasks of one worker share it).

    Functions are shipped by value, so module globals start anew in each task;
    tokenizers and bounded caches are kept here instead. A worker keeps the values
    of one owner: when another operator (or another run of a model) asks, the ones
    before are let go.
    """
    store = sys.__dict__.setdefault("_meeple_worker_state", {})
    if owner not in store:
        if store:
            store.clear()
            give_back()
        store[owner] = {}
    if key not in store[owner]:
        store[owner][key] = make()
    return store[owner][key]


def give_back() -> None:
    """Memory that is free in this worker goes back to the machine: workers outlive
    their tasks, and the allocators keep what a task used at most."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def let_go() -> None:
    """For tasks that keep nothing: drop what other operators left in this worker."""
    store = sys.__dict__.setdefault("_meeple_worker_state", {})
    if store:
        store.clear()
        give_back()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: for
    wide or long rows, which a checkpoint would keep uncompressed."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
