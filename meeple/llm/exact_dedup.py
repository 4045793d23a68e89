"""Operator 4: exact duplicates by deterministic block naming.

Every text is cut into blocks of a fixed size. Equal blocks get one integer
name (their place in sort order), then adjacent names are paired and named
again, until a document has one name left. Names are given by comparing the
blocks themselves, so two texts share a name exactly when they are equal: no
hash decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meeple.llm.common import SPACE, let_go, picked, pin, slices, stored, table, with_group_stats

BLOCK_BYTES = 4096
GATHER_BYTES = 12 << 20  # of blocks compared inside a task before they are sent


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= GATHER_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _coded(refs: pa.StructType):
    """(refs..., block) rows -> each distinct block of a gather once, as (gather, code,
    block), and each row's other columns as (gather, code, refs)."""
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gather = TaskContext.get().partitionId() << 32
        for t in _gathered(batches):
            if not t.num_rows:
                continue
            found = t["block"].combine_chunks().cast(pa.large_binary()).dictionary_encode()
            names, n = found.dictionary.cast(pa.binary()), len(found.dictionary)
            for i in range(0, n, 2048):
                part = names[i:i + 2048]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), gather)), pa.array(np.arange(i, i + len(part), dtype=np.int64)), part,
                     pa.nulls(len(part), refs)], names=CODED)
            held = [c.combine_chunks() for c in t.drop_columns(["block"]).columns]
            holders = pa.StructArray.from_arrays(held, fields=list(refs))
            codes = found.indices.cast(pa.int64())
            for i in range(0, t.num_rows, 20_000):
                part = codes[i:i + 20_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), gather)), part, pa.nulls(len(part), pa.binary()), holders[i:i + 20_000]],
                    names=CODED)
            gather += 1
            del found, names, held, holders, codes, t
            pa.default_memory_pool().release_unused()  # the worker lives on in other stages
    return coded


CODED = ["gather", "code", "block", "refs"]


def _name_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in sort order -> the number of the block among those of this task,
    after the names of all tasks before it."""
    name, last = (TaskContext.get().partitionId() << 40) - 1, None
    for b in batches:
        if not b.num_rows:
            continue
        block = b.column("block")
        new = np.ones(b.num_rows, dtype=np.int64)
        if b.num_rows > 1:
            new[1:] = pc.not_equal(block[1:], block[:-1]).to_numpy(zero_copy_only=False)
        new[0] = last is None or block[0].as_py() != last
        names = name + np.cumsum(new)
        name, last = int(names[-1]), block[b.num_rows - 1].as_py()
        yield pa.RecordBatch.from_arrays([b.column("gather"), b.column("code"), pa.array(names)], ["gather", "code", "name"])


def integer_names(df: DataFrame) -> DataFrame:
    """Replace the binary column ``block`` by a bigint ``name``, equal for equal blocks.

    A task numbers the distinct blocks of each gather (GATHER_BYTES) and writes them
    apart from the rows that hold them. Blocks alone are shuffled, sorted and named:
    a block in a third of all rows arrives once per gather, without its holders. The
    names go back by (gather, code), so rows that hold one block stay spread over as
    many keys as there are gathers.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    refs = T.StructType([f for f in df.schema.fields if f.name != "block"])
    coded = stored(df.mapInArrow(_coded(to_arrow_type(refs)), T.StructType(
        [T.StructField("gather", T.LongType()), T.StructField("code", T.LongType()),
         T.StructField("block", T.BinaryType()), T.StructField("refs", refs)])), "block-names")
    named = (coded.filter("block IS NOT NULL").select("gather", "code", "block").repartition("block")
             .sortWithinPartitions("block").mapInArrow(_name_sorted, "gather bigint, code bigint, name bigint"))
    # a merge join deals both sides by (gather, code); a broadcast of the holders would let
    # those of a frequent block come out of the one task that named it
    return (coded.filter("refs IS NOT NULL").select("gather", "code", "refs")
            .join(named.hint("merge"), ["gather", "code"]).select("refs.*", "name"))


BLOCK_ROWS = T.StructType([
    T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()),
    T.StructField("sha", T.BinaryType()), T.StructField("n", T.LongType()),
    T.StructField("pos", T.LongType()), T.StructField("block", T.BinaryType())])


def _cut(size: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        let_go()
        for b in slices(batches):
            out: dict[str, list] = {f: [] for f in BLOCK_ROWS.names}
            held = 0

            def batch(out=out):
                return pa.RecordBatch.from_arrays(
                    [pa.array(out["row"], pa.int64()), pa.array(out["doc_id"], pa.int64()),
                     pa.array(out["sha"], pa.binary()), pa.array(out["n"], pa.int64()),
                     pa.array(out["pos"], pa.int64()), pa.array(out["block"], pa.binary())],
                    names=BLOCK_ROWS.names)
            for row, doc_id, data in zip(*(b.column(c).to_pylist() for c in ("row", "doc_id", "data")),
                                         strict=True):
                n = max(1, -(-len(data) // size))
                sha = hashlib.sha256(data).digest()
                for pos in range(n):
                    out["row"].append(row)
                    out["doc_id"].append(doc_id)
                    out["sha"].append(sha if pos == 0 else None)
                    out["n"].append(n)
                    out["pos"].append(pos)
                    out["block"].append(data[pos * size:(pos + 1) * size])
                    held += size
                    if held >= 8 << 20:
                        yield batch()
                        held = 0
                        for c in out.values():
                            c.clear()
            yield batch()
    return cut


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(row, doc_id, sha, level, name) of every row of docs(doc_id, data binary):
    equal data <=> equal (level, name). ``row`` tells rows with one doc_id apart."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "data")
    state = pin(integer_names(rows.mapInArrow(_cut(block_bytes), BLOCK_ROWS)))
    most = state.agg(F.max("n")).first()[0] or 1
    level, done = 0, []
    while True:
        done.append(state.filter("n = 1").select("row", "doc_id", "sha",
                                                 F.lit(level).alias("level"), "name"))
        if most <= 1:
            break
        # adjacent names become the block of the next level; an odd end pairs with -1
        at = F.col("pos") % 2
        pairs = (state.filter("n > 1")
                 .groupBy("row", F.shiftright("pos", 1).alias("pos"))
                 .agg(F.max("doc_id").alias("doc_id"),
                      F.max(F.when(F.col("pos") == 0, F.col("sha"))).alias("sha"),
                      F.max(F.shiftright(F.col("n") + 1, 1)).alias("n"),
                      F.max(F.when(at == 0, F.col("name"))).alias("a"),
                      F.coalesce(F.max(F.when(at == 1, F.col("name"))), F.lit(-1)).alias("b"))
                 .select("row", "doc_id", "sha", "n", F.col("pos").cast("long").alias("pos"),
                         F.concat(F.unhex(F.lpad(F.hex("a"), 16, "0")),
                                  F.unhex(F.lpad(F.hex("b"), 16, "0"))).alias("block")))
        state = pin(integer_names(pairs))
        most, level = (most + 1) // 2, level + 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def exact_groups(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are compared after each run of ``[\\x20\\x09-\\x0D]`` became one space.
    Null text counts as empty; all empty texts are one group. The row with the
    smallest doc_id stays (null ids come last); of rows that repeat that doc_id,
    one stays. An empty table gives no row.
    """
    docs = picked(docs, "doc_id", "text")
    data = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), SPACE, " ").cast("binary")
    named = identities(docs.select(F.col("doc_id").cast("long").alias("doc_id"), data.alias("data")),
                       block_bytes)
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    out = with_group_stats(named, ["level", "name"], "row", {
        "first": (F.min(rank), F.min), "group_size": (F.count(F.lit(1)), F.sum)})
    return out.select("doc_id", F.col("first.doc_id").alias("keep_id"),
                      F.col("group_size").cast("long").alias("group_size"),
                      (F.col("row") == F.col("first.row")).alias("kept"),
                      F.lower(F.hex("sha")).alias("text_sha256"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
  FROM documents),
g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.body) AS text_sha256
FROM t JOIN g ON t.body = g.body
"""
