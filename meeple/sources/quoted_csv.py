"""Quoted CSV read by many tasks, also from one file.

A line break inside quotes doesn't end a record, so a split of a file cannot tell by
itself where its records begin. Quotes can: outside a quoted field their number so
far is even. Pass one counts the quotes of every split (the text reader cuts files
into byte ranges that end at line breaks); the running parity over the splits of a
file says which of them begin inside quotes. Pass two walks the lines of each split
from that state and joins those of one record; pieces of records that run across a
split's end are put together in a small shuffle. No split waits for another, and a
record's position (number of its split, place in the split) is its order in the file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLACES = 33  # bits of a position that count within a split
WHOLE, OPENING, CONTINUED = 0, 1, 2  # a record, the first piece of one, a later piece
RECORDS = "file string, pos bigint, piece int, record string"


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, start): lines of text files, with the split they begin in."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select("value", F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("start")))


HEADER = -1  # the position of each file's first record


def split_states(lines: DataFrame) -> dict[str, dict[int, tuple[int, bool, bool]]]:
    """file -> start -> (number of the split over all files, whether it begins inside
    quotes, whether the file's header begins in it).

    One row per split reaches the driver, as many as the file listing it holds has.
    A file whose quotes don't pair up is an error: its records cannot be told apart.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    filled = F.max(~F.col("value").isin("", "\r"))
    rows = (lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd"), filled.alias("filled"))
            .orderBy("file", "start").collect())
    found: dict[str, dict[int, tuple[int, bool, bool]]] = {}
    inside: dict[str, bool] = {}
    headed: set[str] = set()
    for number, r in enumerate(rows):
        before = inside.get(r.file, False)
        found.setdefault(r.file, {})[r.start] = number, before, r.filled and r.file not in headed
        inside[r.file] = before != bool(r.odd)
        if r.filled:
            headed.add(r.file)
    for file, still in inside.items():
        if still:
            raise ValueError(f"quotes in {file} don't pair up: not a quoted CSV file")
    return found


class _Split:
    """The lines of one split so far, cut into records."""

    def __init__(self, number: int, inside: bool, headed: bool):
        # place 0 of a split that begins inside quotes is the rest of an earlier record
        self.base, self.place, self.inside, self.headed = number << PLACES, 0, inside, headed
        self.piece = CONTINUED if inside else WHOLE
        self.held: list[str] = []

    def position(self) -> int:
        return HEADER if self.headed and not self.place else self.base + self.place

    def take(self, lines: pa.Array) -> tuple[list[int], list[int], list[str]]:
        odd = pc.bit_wise_and(pc.count_substring(lines, '"'), 1).to_numpy(zero_copy_only=False)
        after = (np.cumsum(odd) + self.inside) % 2
        values, ends = lines.to_pylist(), np.flatnonzero(after == 0)
        pos, piece, records, at = [], [], [], 0
        for end in ends.tolist():
            self.held += values[at:end + 1]
            at = end + 1
            record = "\n".join(self.held).removesuffix("\r")
            if record or self.piece != WHOLE:  # blank lines between records are none
                pos.append(self.position())
                piece.append(self.piece)
                records.append(record)
                self.place += 1
            self.held, self.piece = [], WHOLE
        self.held += values[at:]
        self.inside = bool(after[-1])
        return pos, piece, records

    def rest(self) -> tuple[list[int], list[int], list[str]]:
        """What is still open at the end of the split."""
        if not self.held:
            return [], [], []
        return ([self.position()], [CONTINUED if self.piece == CONTINUED else OPENING], ["\n".join(self.held)])


def _aligned(states: dict[str, dict[int, tuple[int, bool, bool]]]):
    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(file, found):
            pos, piece, records = found
            return pa.RecordBatch.from_arrays(
                [pa.array([file] * len(pos), pa.string()), pa.array(pos, pa.int64()), pa.array(piece, pa.int32()),
                 pa.array(records, pa.string())], names=[f.split()[0] for f in RECORDS.split(", ")])

        split, now = None, None
        for b in batches:
            if not b.num_rows:
                continue
            start = b.column("start").to_numpy()
            file = b.column("file")
            new = np.ones(b.num_rows, bool)
            new[1:] = start[1:] != start[:-1]
            if b.num_rows > 1:
                new[1:] |= pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False)
            cuts = [*np.flatnonzero(new).tolist(), b.num_rows]
            for at, end in zip(cuts, cuts[1:], strict=False):
                key = (file[at].as_py(), int(start[at]))
                if key != now:
                    if split is not None:
                        yield out(now[0], split.rest())
                    now = key
                    split = _Split(*states[key[0]][key[1]])
                yield out(key[0], split.take(b.column("value")[at:end]))
        if split is not None:
            yield out(now[0], split.rest())
    return aligned


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos, record): the records of quoted CSV files, headers included, quoted
    line breaks kept; ``pos`` orders the data records of all files, headers have HEADER."""
    lines = lines_of(spark, path)
    states = split_states(lines)
    found = lines.mapInArrow(_aligned(states), RECORDS)
    pieces = found.filter(F.col("piece") > WHOLE)  # two a split at most
    opened = F.sum((F.col("piece") == OPENING).cast("int")).over(Window.partitionBy("file").orderBy("pos"))
    joined = (pieces.withColumn("n", opened).groupBy("file", "n").agg(
        F.min("pos").alias("pos"), F.array_sort(F.collect_list(F.struct("pos", "record"))).alias("parts"))
        .select("file", "pos", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record")))
    return found.filter(F.col("piece") == WHOLE).select("file", "pos", "record").unionByName(joined)


def read(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str],
         position: str | None = None) -> DataFrame:
    """The data records (the first of each file is its header) as ``schema``, by place,
    and their position if a name is given for it."""
    data = records(spark, path).filter(F.col("pos") != HEADER)
    ddl = ", ".join("`{}` {}".format(f.name.replace("`", "``"), f.dataType.simpleString()) for f in schema.fields)
    row = F.from_csv("record", ddl, {**options, "multiLine": "true", "maxCharsPerColumn": "-1"}).alias("_r")
    if position is None:
        return data.select(row).select("_r.*")
    return data.select(row, F.col("pos").alias(position)).select("_r.*", F.col(f"`{position}`"))
