"""A keyed table that takes batches without being written anew.

Rows are dealt to buckets by a hash of the key. A batch writes its own rows only, as
new files ("deltas") of the buckets it touches; a bucket whose deltas have grown to a
share of its rows is written anew ("base"). What is live is told by a manifest, one
small file per version, written last: readers resolve it and see a batch whole or not
at all, and a job that fails leaves the version before. Every version remembers its
batch, so a batch that comes again changes nothing.

    path/log/v=<version>/        manifest: a row per live folder of a bucket
    path/data/<folder>/bucket=<b>/   rows, with the version that wrote them
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMPACT = 0.5  # a bucket is written anew when its deltas hold more than this share of its base
MANIFEST = "bucket int, folder string, base boolean, rows long, batch string, v long"


@dataclass
class Version:
    """A manifest: live folders per bucket, oldest first, and the batch that made it."""

    number: int
    batch: str
    folders: dict[int, list[tuple[str, bool, int]]]  # bucket -> (folder, base, rows)


class VersionedTable:
    """Rows of ``schema``, unique by ``keys``, under ``path`` (a shared folder)."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self.schema = schema
        self.stored = T.StructType([*schema.fields, T.StructField("_v", T.LongType())])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    # --- versions ---------------------------------------------------------------------

    def _log(self) -> DataFrame:
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/log")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], MANIFEST)

    def batches(self) -> dict[str, int]:
        """batch -> version, of all versions (each manifest has one row without a bucket)."""
        return {r.batch: r.v for r in self._log().filter("bucket = -1").select("batch", "v").collect()}

    def version(self, number: int | None = None) -> Version:
        """A version, by default the last one; the empty version 0 before any batch."""
        applied = self.batches()
        number = max(applied.values(), default=0) if number is None else number
        folders: dict[int, list[tuple[str, bool, int]]] = {}
        rows = self._log().filter(F.col("v") == number).collect() if number else []
        for r in sorted(rows, key=lambda r: (not r.base, r.folder)):
            if r.bucket >= 0:
                folders.setdefault(r.bucket, []).append((r.folder, r.base, r.rows))
        return Version(number, next((b for b, v in applied.items() if v == number), ""), folders)

    def before(self, batch: str) -> Version:
        """The version a batch was or will be applied to."""
        applied = self.batches()
        return self.version(applied[batch] - 1 if batch in applied else None)

    # --- reading ----------------------------------------------------------------------

    def _files(self, folders: dict[int, list[tuple[str, bool, int]]], base: bool) -> DataFrame | None:
        paths = [f"{self.path}/data/{f}/bucket={b}" for b, fs in folders.items() for f, is_base, _ in fs
                 if is_base == base]
        return self.spark.read.schema(self.stored).parquet(*paths) if paths else None

    def _resolved(self, folders: dict[int, list[tuple[str, bool, int]]]) -> DataFrame:
        """The latest row of each key. Deltas are reduced among themselves and take their
        keys out of the base rows, which are neither shuffled nor sorted while the
        deltas' keys are few enough for a broadcast."""
        columns = self.schema.fieldNames()
        base, deltas = self._files(folders, True), self._files(folders, False)
        empty = self.spark.createDataFrame([], self.schema)
        if deltas is None:
            return empty if base is None else base.select(*columns)
        others = [c for c in columns if c not in self.keys]
        last = (deltas.groupBy(*self.keys).agg(F.max_by(F.struct(*others), "_v").alias("_r"))
                .select(*self.keys, "_r.*").select(*columns))
        if base is None:
            return last
        return base.select(*columns).join(last.select(*self.keys), self.keys, "left_anti").select(*columns).unionByName(last)

    def read(self, version: Version | None = None) -> DataFrame:
        return self._resolved((version or self.version()).folders)

    def lookup(self, keys: DataFrame, version: Version | None = None) -> DataFrame:
        """The rows of some keys; only their buckets' files are read."""
        version = version or self.version()
        wanted = keys.select(*self.keys).distinct()
        touched = {r.b for r in wanted.select(self.bucket().alias("b")).distinct().collect()}  # <= buckets
        return self._resolved({b: f for b, f in version.folders.items() if b in touched}).join(
            wanted, self.keys, "left_semi").select(*self.schema.fieldNames())

    # --- writing ----------------------------------------------------------------------

    def _write(self, rows: DataFrame, number: int) -> tuple[str, dict[int, int]]:
        """Rows as a new folder, one file per bucket; (folder, rows per bucket)."""
        folder = f"{number:012d}-{uuid.uuid4().hex}"  # an attempt that failed is never read
        (rows.select(*self.schema.fieldNames(), F.lit(number).cast("long").alias("_v"), self.bucket().alias("bucket"))
         .repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/{folder}"))
        try:
            back = self.spark.read.parquet(f"{self.path}/data/{folder}")
        except AnalysisException as e:
            if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            return folder, {}  # no rows
        return folder, {r.bucket: r["count"] for r in back.groupBy("bucket").count().collect()}

    def _commit(self, number: int, batch: str, folders: dict[int, list[tuple[str, bool, int]]]) -> Version:
        """One file, written last; a second writer of the same version fails."""
        rows = [(-1, "", False, 0, batch)] + [(b, f, base, n, batch) for b, fs in folders.items() for f, base, n in fs]
        (self.spark.createDataFrame(rows, ", ".join(MANIFEST.split(", ")[:-1])).coalesce(1)
         .write.mode("errorifexists").parquet(f"{self.path}/log/v={number}"))
        return Version(number, batch, folders)

    def merge(self, rows: DataFrame, batch: str) -> Version:
        """Apply rows (one per key) as one batch: new keys are added, known ones replaced.

        A batch id that was applied before changes nothing. Bytes written grow with the
        batch; a bucket is written anew only after deltas of COMPACT of its size, so each
        row is written a few times over its life however large the table grows.
        """
        applied = self.batches()
        if batch in applied:
            return self.version()
        now = self.version()
        number = now.number + 1
        folder, counts = self._write(rows, number)
        folders = {b: list(fs) for b, fs in now.folders.items()}
        for b, n in counts.items():
            folders.setdefault(b, []).append((folder, False, n))
        full = {b: fs for b, fs in folders.items() if b in counts
                and sum(n for _, base, n in fs if not base) > COMPACT * sum(n for _, base, n in fs if base)}
        if full:
            folder, counts = self._write(self._resolved(full), number)
            folders.update({b: [(folder, True, n)] for b, n in counts.items()})
        return self._commit(number, batch, folders)
