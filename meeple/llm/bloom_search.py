"""Operator 11: ranked lexical search over bit-sliced Bloom signatures.

``build_index`` writes one row per block of documents of like size. A block has a
Bloom signature per document, stored as slices: slice ``i`` is a bitmap over the
block's documents that have bit ``i`` set. A document enters its terms once for
each power of two its count reaches ("occurs", "occurs twice", "four times", ...), so
the AND of a term's slices is a bitmap that overestimates in which documents the
term occurs that often. Beside the slices a block keeps its exact postings.

``search`` adds the weighted slices of a query up: for every level the sum of the
weights of the terms present, times what a count of that level can add at most, is
an upper bound on each document's score. A task walks the documents of its blocks in
falling order of the bound and scores them exactly until the bound of the next is
below the tenth best score found; so every document not provably excluded is scored.
Queries go through in blocks bounded in bytes; a task sends ten rows a query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meeple.llm.common import let_go, picked, slices, stored, table

TOP = 10
ROWS = 4  # slices that a term sets
LEVELS = 8  # counts of 1, 2, 4, ... 128; the last one has no upper end
FILL = 0.25  # share of a document's bits that are set, at most
BLOCK_DOCS = 1024
CHUNK_BYTES, CHUNK_DOCS = 2 << 20, 4096  # texts from which blocks are made at once
MATRIX_CELLS = 1 << 25  # bits times documents of a block, at most
QUERY_BYTES = 4 << 20  # terms of the queries that go through together
PAIR_BATCH = 16  # documents scored before the bound is looked at again

# A-Z become a-z, all other ASCII but digits and a-z become a space: what is left
# between spaces are the maximal runs of the contract's class
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
             for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text, repeats included."""
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def hashes(terms: list[bytes]) -> np.ndarray:
    import xxhash
    return np.fromiter((xxhash.xxh3_64_intdigest(t) for t in terms), np.uint64, len(terms))


def bits_of(term_hash: np.ndarray, level: int, width: int) -> np.ndarray:
    """(terms, ROWS): the slices of a term at a level, in signatures of ``width`` bits."""
    start = _mixed(term_hash + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2 ** 64 - 1)))
    step = _mixed(start) | np.uint64(1)
    at = start[:, None] + step[:, None] * np.arange(ROWS, dtype=np.uint64)
    return (at % np.uint64(width)).astype(np.int64)


def level_of(tf: np.ndarray) -> np.ndarray:
    """The highest level a count reaches."""
    return np.minimum(np.log2(tf).astype(np.int64), LEVELS - 1)


# --- the index --------------------------------------------------------------------

# one row per block: numbers as packed bytes, terms joined by spaces (no term holds one)
INDEX = ("n_docs bigint, n_terms bigint, width bigint, doc_ids binary, no_id binary, lengths binary, terms binary,"
         " df binary, starts binary, codes binary, tfs binary, slices binary")
KINDS = {"doc_ids": np.int64, "no_id": np.bool_, "lengths": np.int64, "df": np.int32, "starts": np.int32,
         "codes": np.int32, "tfs": np.int32, "slices": np.uint8}


def _read(b: pa.RecordBatch, row: int, *names: str) -> list:
    out = []
    for name in names:
        data = b.column(name)[row].as_py()
        out.append(pa.array(data.split(b" "), pa.binary()) if name == "terms" else np.frombuffer(data, KINDS[name]))
    return out


def _block(ids: list, doc: np.ndarray, code: np.ndarray, tf: np.ndarray, names: pa.Array) -> pa.RecordBatch:
    """One block from the postings (document 0.., code, tf), sorted by document and code."""
    n = len(ids)
    used, code = np.unique(code, return_inverse=True)
    terms = names.take(pa.array(used))
    level = level_of(tf)
    entries = np.bincount(doc, weights=level + 1, minlength=n).max()
    width = max(64, -(-int(entries * ROWS / -math.log(1 - FILL)) // 64) * 64)
    term_hash = hashes(terms.to_pylist())
    matrix = np.zeros((width, n), np.uint8)
    for at_least in range(int(level.max()) + 1):
        has = level >= at_least
        matrix[bits_of(term_hash, at_least, width)[code[has]], doc[has][:, None]] = 1
    starts = np.searchsorted(doc, np.arange(n + 1))
    lengths = np.bincount(doc, weights=tf, minlength=n).astype(np.int64)
    row = {"n_docs": n, "n_terms": int(lengths.sum()), "width": width,
           "doc_ids": np.array([i or 0 for i in ids]), "no_id": np.array([i is None for i in ids]),
           "lengths": lengths, "terms": b" ".join(terms.to_pylist()), "df": np.bincount(code, minlength=len(used)),
           "starts": starts, "codes": code, "tfs": tf, "slices": np.packbits(matrix, axis=1)}
    columns = []
    for name in (f.split()[0] for f in INDEX.split(", ")):
        v = row[name].astype(KINDS[name]).tobytes() if name in KINDS else row[name]
        columns.append(pa.array([v], pa.binary() if isinstance(v, bytes) else pa.int64()))
    return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in INDEX.split(", ")])


def _blocks(ids: list, texts: list) -> Iterator[pa.RecordBatch]:
    found = [terms_of(t) for t in texts]
    n = np.fromiter(map(len, found), np.int64, len(found))
    coded = pa.array([t for f in found for t in f], pa.binary()).dictionary_encode()
    names, size = coded.dictionary, max(1, len(coded.dictionary))
    key = np.repeat(np.arange(len(found)), n) * size + coded.indices.to_numpy()
    key, tf = np.unique(key, return_counts=True)
    doc, code = key // size, key % size
    entries = np.bincount(doc, weights=level_of(tf) + 1, minlength=len(found))
    order = [int(i) for i in np.argsort(entries, kind="stable") if n[i]]  # texts without terms are left out
    at = 0
    while at < len(order):
        # documents of like size share a block, so that no signature is much too wide or too full
        least, end = entries[order[at]], at
        while end < len(order) and end - at < BLOCK_DOCS:
            most = entries[order[end]]
            if most > 1.5 * least + 32 or most * ROWS * 4 * (end - at + 1) > MATRIX_CELLS and end > at:
                break
            end += 1
        mine = np.array(order[at:end])
        place = np.full(len(found), -1)
        place[mine] = np.arange(len(mine))
        keep = place[doc] >= 0
        d, c, t = place[doc[keep]], code[keep], tf[keep]
        by = np.lexsort((c, d))
        yield _block([ids[i] for i in mine], d[by], c[by], t[by], names)
        at = end


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    ids, texts, held = [], [], 0
    for b in slices(batches):
        for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
            ids.append(i)
            texts.append(t)
            held += len(t or "")
            if held >= CHUNK_BYTES or len(ids) >= CHUNK_DOCS:
                yield from _blocks(ids, texts)
                ids, texts, held = [], [], 0
                pa.default_memory_pool().release_unused()  # the worker lives on in other stages
    if ids:
        yield from _blocks(ids, texts)


def build_index(docs: DataFrame) -> DataFrame:
    """The index of docs(doc_id, text), written to the shared folder: INDEX rows.

    Whole texts; null texts and texts without a term have no entry, since no query
    can find them. Repeated rows have an entry each.
    """
    docs = picked(docs, "doc_id", "text")
    return stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                  .mapInArrow(_indexed, INDEX), "search-index")


# --- queries ------------------------------------------------------------------------

def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        found = [list(dict.fromkeys(terms_of(t))) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("item"), b.column("item_id"),
                                          pa.array(found, pa.list_(pa.binary()))], names=["item", "item_id", "terms"])


def _query_blocks(items: DataFrame) -> Iterator[list]:
    """Rows (item, item_id, terms) in blocks of QUERY_BYTES of terms (one item at least)."""
    held, size = [], 0
    for r in items.toLocalIterator():
        if r.terms:
            held.append((r.item, [bytes(t) for t in r.terms]))
            size += sum(map(len, held[-1][1])) + 64 * len(held[-1][1])
        if size >= QUERY_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _document_counts(sent):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = sent.value
        df = np.zeros(len(names) + 1, np.int64)
        for b in batches:
            for r in range(b.num_rows):
                terms, counts = _read(b, r, "terms", "df")
                np.add.at(df, pc.index_in(terms, names).fill_null(len(names)).to_numpy(), counts)
        seen = np.flatnonzero(df[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int64)), pa.array(df[seen])], names=["term", "df"])
    return counted


class _Plan:
    """What all tasks get: terms of the block of queries, their weights and hashes,
    and per query its number and the places of its terms."""

    def __init__(self, queries: list, names: pa.Array, df: np.ndarray, n: int, length: int):
        self.names, self.n, self.length = names, n, length
        self.weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) if d else 0 for d in df],
                               np.int64)
        place = {t: i for i, t in enumerate(names.to_pylist())}
        self.hashes = hashes(list(place))
        self.queries = [(item, np.array([place[t] for t in terms if df[place[t]]], np.int64))
                        for item, terms in queries]
        # sums of weights are exact in 32-bit floats below 2^24
        most = max((int(self.weight[t].sum()) for _, t in self.queries), default=0)
        self.kind = np.float32 if most < 1 << 24 else np.float64

    def m(self, lengths: np.ndarray) -> np.ndarray:
        return 100 - 90 + (90 * lengths * self.n) // self.length


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _bounds(plan: _Plan, width: int, bitmaps: np.ndarray, lengths: np.ndarray, m: np.ndarray):
    """Per query the upper bounds of all documents of a block (None: nothing present)."""
    n = len(lengths)
    place, present, sums = np.arange(len(plan.names)), None, []
    for level in range(LEVELS):
        found = np.bitwise_and.reduce(bitmaps[bits_of(plan.hashes[place], level, width)], axis=1)
        if present is not None:
            found &= present  # a count reaches a level only if it reaches the one below
        some = found.any(axis=1)
        place, present = place[some], found[some]
        if not len(place):
            break
        # at most this count: below the next level, and not above the document's length
        most = np.minimum(lengths, 2 ** (level + 1) - 1) if level < LEVELS - 1 else lengths
        where = np.full(len(plan.names), -1)
        where[place] = np.arange(len(place))
        sums.append((where, np.unpackbits(present, axis=1)[:, :n].astype(plan.kind), gain(most, m)))

    def bound(terms: np.ndarray):
        total, before = None, 0
        for where, bits, most in sums:
            at = where[terms]
            here = at >= 0
            if not here.any():
                break
            part = (plan.weight[terms[here]].astype(plan.kind) @ bits[at[here]]).astype(np.float64) * (most - before)
            total, before = part if total is None else total + part, most
        return total
    return bound


def _exact(docs: np.ndarray, weights: np.ndarray, starts: np.ndarray, known: np.ndarray,
           tfs: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Scores of some documents; ``weights`` by term of the plan, 0 for all but the query's."""
    n = starts[docs + 1] - starts[docs]
    at = np.repeat(starts[docs] - np.cumsum(n) + n, n) + np.arange(n.sum())
    w = weights[known[at]]
    part = np.where(w > 0, w * gain(tfs[at], np.repeat(m[docs], n)), 0)
    return np.add.reduceat(part, np.cumsum(n) - n)


def _searched(sent, top: int):
    def order(score, doc_id):
        return np.lexsort((np.where(doc_id.mask, np.iinfo(np.int64).max, doc_id.data), doc_id.mask, -score))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        plan: _Plan = sent.value
        best = [(np.zeros(0, np.int64), np.ma.masked_array(np.zeros(0, np.int64), np.zeros(0, bool)))
                for _ in plan.queries]
        weights = np.zeros(len(plan.names) + 1, np.int64)
        for b in batches:
            for r in range(b.num_rows):
                lengths, starts, codes, tfs, bitmaps, ids, no_id, terms = _read(
                    b, r, "lengths", "starts", "codes", "tfs", "slices", "doc_ids", "no_id", "terms")
                starts, tfs = starts.astype(np.int64), tfs.astype(np.int64)
                width, m = b.column("width")[r].as_py(), plan.m(lengths)
                bitmaps, ids = bitmaps.reshape(width, -1), np.ma.masked_array(ids, no_id)
                known = pc.index_in(terms, plan.names).fill_null(len(plan.names)).to_numpy()[codes]
                bound = _bounds(plan, width, bitmaps, lengths, m)
                for q, (_, terms) in enumerate(plan.queries):
                    upper = bound(terms)
                    if upper is None:
                        continue
                    scores, found = best[q]
                    least = scores[top - 1] if len(scores) >= top else 1
                    left = np.flatnonzero(upper >= least)
                    left = left[np.argsort(-upper[left], kind="stable")]
                    weights[terms] = plan.weight[terms]
                    while len(left):
                        now, left = left[:PAIR_BATCH], left[PAIR_BATCH:]
                        got = _exact(now, weights, starts, known, tfs, m)
                        keep = got >= least
                        if keep.any():
                            scores = np.concatenate([scores, got[keep]])
                            found = np.ma.concatenate([found, ids[now[keep]]])
                            by = order(scores, np.ma.masked_array(found.data, np.ma.getmaskarray(found)))[:top]
                            scores, found = scores[by], found[by]
                            if len(scores) >= top:
                                least = scores[top - 1]
                                left = left[upper[left] >= least]
                    weights[terms] = 0
                    best[q] = scores, found
        item = np.repeat(np.array([i for i, _ in plan.queries], np.int64), [len(s) for s, _ in best])
        if len(item):
            ids = np.ma.concatenate([f for _, f in best])
            yield pa.RecordBatch.from_arrays(
                [pa.array(item), pa.array(ids.data, pa.int64(), mask=np.ma.getmaskarray(ids)),
                 pa.array(np.concatenate([s for s, _ in best]))], names=["item", "doc_id", "score"])
    return searched


def search(index: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` best documents of each row of queries(item_id, text): item_id, rank
    (from 1), doc_id, score.

    Scores are the contract's integers and above 0; equal scores rank by doc_id, null
    ids last. A query without a term that occurs (null and empty texts too) has no
    row; rows that repeat an item_id are queries of their own. An empty index or no
    queries give an empty result.
    """
    spark = index.sparkSession
    items = stored(picked(queries, "item_id", "text")
                   .select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
                   .mapInArrow(_items, f"item bigint, item_id {dict(queries.dtypes)['item_id']}, terms array<binary>"),
                   "search-items")
    size = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    found = spark.createDataFrame([], "item bigint, doc_id bigint, score bigint")
    for block in _query_blocks(items) if size.n else ():
        names = pa.array(sorted({t for _, terms in block for t in terms}), pa.binary())
        df = np.zeros(len(names), np.int64)
        for r in (index.select("terms", "df").mapInArrow(
                _document_counts(spark.sparkContext.broadcast(names)), "term bigint, df bigint")
                .groupBy("term").agg(F.sum("df").alias("df")).collect()):  # as many rows as terms at most
            df[r.term] = r.df
        plan = spark.sparkContext.broadcast(_Plan(block, names, df, size.n, size.l))
        found = found.union(index.mapInArrow(_searched(plan, top), "item bigint, doc_id bigint, score bigint"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return (found.withColumn("rank", rank).filter(F.col("rank") <= top)
            .join(items.select("item", "item_id"), "item")
            .select("item_id", "rank", "doc_id", "score"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


_TERMS = r"""unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"""

OP11_SQL = f"""
WITH words AS (SELECT doc_id, {_TERMS} FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
len AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
total AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS l FROM len),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
asked AS (SELECT DISTINCT item_id, {_TERMS} FROM benchmark),
w AS (SELECT item_id, term, floor(1000 * ln((2.0 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM asked JOIN df USING (term), total),
m AS (SELECT doc_id, 100 - 90 + ((90 * n * n_docs) // l) AS m FROM len, total),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM w JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY ALL),
r AS (SELECT item_id, doc_id, score,
             row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank
      FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
