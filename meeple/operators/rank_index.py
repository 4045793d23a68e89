"""A ranking kept as an index of range files.

The rows of a ranking stand in files by their place in the order, a bounded number in
each; a manifest keeps the files' first keys and row counts. A page is found by adding
up counts, and reads the one or two files that hold it, however deep it lies. After a
merge only the files that rows leave or enter are written anew, under a new version;
a file that has grown too much is cut. There is no global sort after the first.

    path/log/v=<version>/            manifest: a row per file
    path/data/<folder>/file=<n>/     rows of one range, sorted
"""

from __future__ import annotations

import uuid
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meeple.operators.catalog import GAMES_PER_PAGE, _page_number
from meeple.operators.dense_ids import global_positions

ROWS_PER_FILE = 100_000
MANIFEST = "place int, folder string, file long, n long, k0 int, k1 double, k2 long, v long"
KEY = ["_k0", "_k1", "_k2"]


@dataclass
class Part:
    folder: str
    file: int
    n: int
    first: tuple  # the key (null place, value, id) from which on rows belong here


class RankIndex:
    """Rows (id, <metric>, ...) in the order of the metric, ties by id."""

    def __init__(self, spark: SparkSession, path: str, schema: str, metric: str, descending: bool = True,
                 nulls_first: bool = True, rows_per_file: int = ROWS_PER_FILE):
        self.spark, self.path, self.schema, self.metric = spark, path.rstrip("/"), schema, metric
        self.descending, self.nulls_first, self.most = descending, nulls_first, rows_per_file

    def _keyed(self, df: DataFrame) -> DataFrame:
        """The order as three columns that all ascend and hold no null."""
        m = F.col(self.metric).cast("double")
        null = F.when(m.isNull(), 0 if self.nulls_first else 1).otherwise(1 if self.nulls_first else 0)
        value = F.coalesce(-m if self.descending else m, F.lit(0.0))
        # -0.0 and 0.0 are one value
        return df.select("*", null.cast("int").alias("_k0"), (value + F.lit(0.0)).alias("_k1"),
                         F.col("id").cast("long").alias("_k2"))

    def parts(self, version: int | None = None) -> list[Part]:
        """The files of a version, by default the last, in order: the driver holds a row
        per file."""
        try:
            log = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/log")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        if version is None:
            version = log.agg(F.max("v")).first()[0]
        rows = log.filter((F.col("v") == version) & (F.col("n") > 0)).orderBy("place").collect()
        return [Part(r.folder, r.file, r.n, (r.k0, r.k1, r.k2)) for r in rows]

    def version(self) -> int:
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/log").agg(F.max("v")).first()[0] or 0
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0

    def _read(self, parts: list[Part]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/data/{p.folder}/file={p.file}" for p in parts])

    def _write(self, rows: DataFrame, file: Column) -> list[Part]:
        """Keyed rows as files by number; the new parts in order."""
        folder = uuid.uuid4().hex  # an attempt that failed is never read
        columns = [c for c in rows.columns if c not in KEY and c != "_f"]
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions", "200"))  # few bytes are many files
        numbered = rows.withColumn("file", file.cast("long")).repartition(tasks, "file")
        numbered.sortWithinPartitions("file", *KEY).select(*columns, "file").write.partitionBy("file").parquet(
            f"{self.path}/data/{folder}")
        try:
            back = self.spark.read.parquet(f"{self.path}/data/{folder}")
        except AnalysisException as e:
            if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            return []
        found = self._keyed(back).groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*KEY)).alias("k")).collect()
        return sorted((Part(folder, r.file, r.n, tuple(r.k)) for r in found), key=lambda p: p.first)

    def _commit(self, parts: list[Part]) -> int:
        number = self.version() + 1
        rows = [(i, p.folder, p.file, p.n, *p.first) for i, p in enumerate(parts)] or [(0, "", 0, 0, 0, 0.0, 0)]
        (self.spark.createDataFrame(rows, ", ".join(MANIFEST.split(", ")[:-1])).coalesce(1)
         .write.mode("errorifexists").parquet(f"{self.path}/log/v={number}"))
        return number

    def build(self, rows: DataFrame) -> int:
        """The first version: the one global order, cut into files of ROWS_PER_FILE."""
        placed = global_positions(self._keyed(rows), KEY, "_place", start=0)
        files = placed.withColumn("_f", F.floor(F.col("_place") / F.lit(self.most))).drop("_place")
        return self._commit(self._write(files, F.col("_f")))

    def _with_part(self, df: DataFrame, parts: list[Part], name: str, values: list[int] | None = None) -> DataFrame:
        """Keyed rows with the place of the part that their key belongs to (parts whose first
        key is not above it, less one), or with the value of that part. A search by halves
        of the files' first keys."""
        def rank(key):  # Spark's order: nulls first, NaN last
            return tuple((0, 0) if x is None else (2, 0) if x != x else (1, x) for x in key)
        firsts = [rank(p.first) for p in parts[1:]]
        values = list(range(len(parts))) if values is None else values

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                keys = zip(*[b.column(c).to_pylist() for c in KEY], strict=True)
                found = pa.array([values[bisect_right(firsts, rank(k))] for k in keys], pa.int64())
                yield pa.RecordBatch.from_arrays([*b.columns, found], names=[*b.schema.names, name])
        return df.mapInArrow(place, T.StructType([*df.schema.fields, T.StructField(name, T.LongType())]))

    def update(self, old: DataFrame, new: DataFrame) -> int:
        """Rows that a merge changed: ``old`` as they stood (none for new ids), ``new`` as they
        are now (none for removed ids); both batch-sized. Files that no row leaves or
        enters are kept as they are."""
        parts = self.parts()
        if not parts:
            return self.build(new)
        leaves = self._with_part(self._keyed(old), parts, "part").select("id", "part")
        enters = self._with_part(self._keyed(new), parts, "part")
        touched = sorted({r.part for r in leaves.select("part").union(enters.select("part")).distinct().collect()})
        if not touched:
            return self.version()
        kept = self._keyed(self._read([parts[i] for i in touched]))
        kept = kept.join(leaves.select("id").distinct(), "id", "left_anti").select(*kept.columns)
        now = kept.unionByName(enters.drop("part"))
        # rows go to the part of their key; a part of more than twice its size is cut
        now = self._with_part(now, parts, "_p")
        w = Window.partitionBy("_p").orderBy(*KEY)
        size = F.count(F.lit(1)).over(Window.partitionBy("_p"))
        piece = F.when(size > 2 * self.most, F.floor((F.row_number().over(w) - 1) / F.lit(self.most))).otherwise(F.lit(0))
        files = now.withColumn("_f", F.col("_p") * F.lit(1 << 16) + piece).drop("_p")
        fresh = self._write(files, F.col("_f"))
        rest = [p for i, p in enumerate(parts) if i not in set(touched)]
        return self._commit(sorted(rest + fresh, key=lambda p: p.first))

    # --- reading ------------------------------------------------------------------------

    def page(self, page_no: int, per_page: int = GAMES_PER_PAGE, version: int | None = None) -> DataFrame:
        """One page with its 1-based ``pos``, from the files that hold it."""
        low = (_page_number(page_no) - 1) * per_page
        before, wanted, skipped = 0, [], 0
        for p in self.parts(version):
            if before + p.n <= low:
                skipped = before + p.n
            elif before < low + per_page:
                wanted.append(p)
            before += p.n
        rows = self._keyed(self._read(wanted)).orderBy(*KEY).offset(low - skipped).limit(per_page)
        pos = F.lit(low) + F.row_number().over(Window.orderBy(*KEY))
        return rows.withColumn("pos", pos.cast("int")).drop(*KEY)

    def total(self) -> int:
        """A10 without a scan."""
        return sum(p.n for p in self.parts())

    def ranking(self) -> DataFrame:
        """All rows with ``pos``: a file's rows are numbered on their own."""
        parts = self.parts()
        if not parts:
            return self.spark.createDataFrame([], self.schema).withColumn("pos", F.lit(0).cast("long"))
        offsets, before = [], 0
        for p in parts:
            offsets.append(before)
            before += p.n
        keyed = self._with_part(self._keyed(self._read(parts)), parts, "_start", offsets)
        out = keyed.withColumn("pos", F.col("_start") + F.row_number().over(Window.partitionBy("_start").orderBy(*KEY)))
        return out.drop(*KEY, "_start")
