"""Operator 9: a hashed maximum-entropy language model.

The probability of a word is that of its class given hashed features of the words
before it, times its smoothed share of the class:

* features: the previous word (bigram), the word before that (skip), and both
  together (trigram); whole words are hashed, into a space that grows with the
  square root of the training tokens, so the weights stay far smaller than the corpus;
* classes: a softmax over ``CLASSES`` classes of whole words by hash, so that unseen
  words have a class too;
* training: word counts are exact; the softmax weights are trained by distributed
  gradient updates. Every update reads its own share of the training documents, all
  of them together read each document once. Tasks sum both sides of the gradient,
  what was seen and what the model expects, and Spark adds the tasks' sums up; the
  driver gets one sum per weight however many tasks there are.

Scoring works on batches of token arrays. Counts of frequent words go to all tasks in
one table bounded in bytes; counts of other words are joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meeple.llm.common import crc_of_id, heaviest, let_go, picked, stored, table

CLASSES = 32
FREQUENT, LONGEST = 50_000, 64  # words at most whose counts all tasks get, and their bytes at most
BLOCK_BYTES = 4 << 20  # texts whose words are made distinct together
HELD = 400_000  # distinct words a task holds before it sends them
UPDATES = 6
TOKENS_A_WEIGHT_ROW = 25  # a task sums over so many tokens for each row of weights it sends
SHRINK = 1.0  # pseudo-count on both sides of an update: rare features stay near zero
STEP = 0.5  # of the log ratio; scaling over four features at a time is monotone at 1/4
SMOOTHING = 0.1
END = b" "  # no word holds a space
PART = 1 << 13  # tokens whose class scores are in memory at once
ROWS_SENT = 1 << 12  # rows of weights in one sent piece


def tokens(data: bytes) -> list[bytes]:
    return [*data.lower().split(), END]  # bytes.lower changes A-Z only


class Space:
    """Sizes of the feature space and the rows of features in one weight matrix: bias,
    bigram, skip, trigram, one below the other."""

    def __init__(self, n_tokens: int):
        bigram = 1 << max(6, int(np.ceil(np.log2(2 * np.sqrt(max(1, n_tokens))))))
        self.sizes = (1, bigram, bigram // 2, bigram)
        self.rows = sum(self.sizes)

    def features(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows for the hashes of the previous word and of the one before it."""
        _, a, b, c = (np.uint64(s) for s in self.sizes)
        both = _mixed(first * np.uint64(0x9E3779B97F4A7C15) + second)
        return ((first % a).astype(np.int64) + 1, (second % b).astype(np.int64) + 1 + int(a),
                (both % c).astype(np.int64) + 1 + int(a + b))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of an array of binaries: a polynomial over the bytes, mixed."""
    n = len(words)
    _, offsets, data = words.buffers()
    if not n:
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(offsets, np.int32)[words.offset:words.offset + n + 1].astype(np.int64)
    size = np.diff(offsets)
    body = np.frombuffer(data or b"", np.uint8)[offsets[0]:offsets[-1]].astype(np.uint64)
    starts = offsets[:-1] - offsets[0]
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(size.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
        total = size.astype(np.uint64)
        if len(body):
            place = np.arange(len(body)) - np.repeat(starts, size)
            full = size > 0
            total[full] += np.add.reduceat((body + np.uint64(1)) * powers[place], starts[full])
    return _mixed(total)


def class_of(word_hash: np.ndarray, is_end: np.ndarray) -> np.ndarray:
    """The end is a class of its own, all words share the others."""
    out = 1 + (word_hash >> np.uint64(40)) % np.uint64(CLASSES - 1)
    return np.where(is_end, 0, out.astype(np.int64))


IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _split(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of lower-cased texts as one array of binaries, and their number per
    text; what ``tokens`` gives without the ends, without an object per word."""
    data = np.frombuffer(b"\n".join([*texts, b""]).lower(), np.uint8)
    inside = ~IS_SPACE[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False))  # every text ends in white space
    starts, size = edges[::2], edges[1::2] - edges[::2]
    offsets = np.zeros(len(size) + 1, np.int32)
    np.cumsum(size, out=offsets[1:])
    words = pa.Array.from_buffers(pa.binary(), len(size),
                                  [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    ends = np.cumsum([len(t) + 1 for t in texts])
    return words, np.diff(np.searchsorted(starts, ends), prepend=0)


class Block:
    """The tokens of some texts: ``words`` (distinct, the end last), their hashes and
    classes, ``at`` (place of each token's word), ``size`` of each text."""

    def __init__(self, texts: list[bytes]):
        found, count = _split(texts)
        coded = found.dictionary_encode()
        end = len(coded.dictionary)
        self.words = pa.concat_arrays([coded.dictionary, pa.array([END], pa.binary())])
        self.size = count + 1
        last = np.zeros(len(found) + len(texts), bool)
        last[np.cumsum(self.size) - 1] = True
        self.at = np.full(len(last), end, np.int64)
        self.at[~last] = coded.indices.to_numpy()
        self.hash = hashes(self.words)
        self.cls = class_of(self.hash, np.arange(end + 1) == end)

    def contexts(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the word before each token and of the one before that (0: none)."""
        h, n = self.hash[self.at], len(self.at)
        start = np.zeros(n, bool)
        start[np.cumsum(self.size) - self.size] = True
        first, second = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        first[1:] = h[:-1]
        first[start] = 0
        second[1:] = first[:-1]
        second[start] = 0
        return first, second


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, Block]]:
    """Rows in groups of about BLOCK_BYTES of the column ``data``."""
    held, size = [], 0
    for whole in batches:
        for at in range(0, whole.num_rows, 128):
            b = whole.slice(at, 128)
            held.append(b)
            size += b.column("data").nbytes
            if size >= BLOCK_BYTES:
                t = pa.Table.from_batches(held)
                yield t, Block(t["data"].to_pylist())
                held, size = [], 0
    if sum(b.num_rows for b in held):
        t = pa.Table.from_batches(held)
        yield t, Block(t["data"].to_pylist())


# --- counts -----------------------------------------------------------------------------

def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    held, rows = [], 0

    def merged():
        t = pa.concat_tables(held).group_by(["word", "class"]).aggregate([("n", "sum")])
        return pa.table({"word": t["word"], "class": t["class"], "n": t["n_sum"]})
    for _, b in blocks(batches):
        held.append(pa.table({"word": b.words, "class": pa.array(b.cls.astype(np.int32)),
                              "n": pa.array(np.bincount(b.at, minlength=len(b.words)))}))
        rows += len(b.words)
        if rows > 2 * HELD:
            held = [merged()]
            rows = held[0].num_rows
            if rows > HELD:
                yield from held[0].to_batches(max_chunksize=50_000)
                held, rows = [], 0
    if held:
        yield from merged().to_batches(max_chunksize=50_000)
    pa.default_memory_pool().release_unused()


def corpus_counts(texts: DataFrame) -> DataFrame:
    """(word, class, n): exact counts of all words of texts(data)."""
    return stored(texts.mapInArrow(_counted, "word binary, class int, n bigint")
                  .groupBy("word", "class").agg(F.sum("n").alias("n")), "lm-counts")


# --- training -----------------------------------------------------------------------------

def log_softmax(weights: np.ndarray, rows: tuple[np.ndarray, ...]) -> np.ndarray:
    """(contexts, CLASSES): natural logs of the classes' probabilities."""
    x = weights[rows[0]]
    for r in rows[1:]:
        x += weights[r]
    x += weights[0]
    x -= x.max(axis=1, keepdims=True)
    x -= np.log(np.exp(x).sum(axis=1, keepdims=True))
    return x


def _add_rows(total: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """total[rows[i]] += values[i], rows repeating."""
    order = np.argsort(rows)
    rows = rows[order]
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    total[rows[first]] += np.add.reduceat(values[order], first, axis=0)


def gradient_sides(space: Space, weights: np.ndarray, block: Block, seen: np.ndarray, expected: np.ndarray) -> None:
    """Add what a block's tokens show and what the weights expect there, per feature
    row and class."""
    first, second = block.contexts()
    cls = block.cls[block.at]
    for k in range(0, len(cls), PART):
        c = cls[k:k + PART]
        rows = space.features(first[k:k + PART], second[k:k + PART])
        p = np.exp(log_softmax(weights, rows))
        for r in rows:
            np.add.at(seen.reshape(-1), r * CLASSES + c, np.float32(1))
            _add_rows(expected, r, p)
        seen[0] += np.bincount(c, minlength=CLASSES)
        expected[0] += p.sum(axis=0)


def _gradients(space: Space, sent):
    def gradients(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        sides = np.zeros((2, space.rows, CLASSES), np.float32)
        some = False
        for _, block in blocks(batches):
            gradient_sides(space, sent.value, block, sides[0], sides[1])
            some = True
        for piece in range(0, space.rows if some else 0, ROWS_SENT):
            yield pa.RecordBatch.from_arrays(
                [pa.array([piece // ROWS_SENT], pa.int32()),
                 pa.array([sides[:, piece:piece + ROWS_SENT].tobytes()], pa.binary())], names=["piece", "sums"])
    return gradients


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of one piece after another (rows come in the order of pieces) added up."""
    now, total = None, None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                          names=["piece", "sums"])
    for b in batches:
        for r in range(b.num_rows):
            piece, sums = b.column("piece")[r].as_py(), np.frombuffer(b.column("sums")[r].as_py(), np.float32)
            if piece == now:
                total += sums
            else:
                if now is not None:
                    yield out()
                now, total = piece, sums.copy()
    if now is not None:
        yield out()


def train_classes(texts: DataFrame, space: Space, n_tokens: int, mass: np.ndarray,
                  updates: int = UPDATES) -> np.ndarray:
    """Weights (rows of features, CLASSES) from texts(share, data): ``updates`` damped
    steps of iterative scaling, each over its share of the texts. ``mass`` counts the
    classes' training tokens: the bias starts from them."""
    weights = np.zeros((space.rows, CLASSES), np.float32)
    weights[0] = np.log((mass + SMOOTHING) / (mass + SMOOTHING).sum())
    sc = texts.sparkSession.sparkContext
    tasks = max(1, round(n_tokens / updates / (TOKENS_A_WEIGHT_ROW * space.rows)))
    for u in range(updates if n_tokens else 0):
        sent = sc.broadcast(weights)
        sums = (texts.filter(F.col("share") == u).select("data").coalesce(tasks)
                .mapInArrow(_gradients(space, sent), "piece int, sums binary")
                .repartition("piece").sortWithinPartitions("piece").mapInArrow(_added, "piece int, sums binary"))
        for r in sums.toLocalIterator():  # a row per piece of the weights
            seen, expected = np.frombuffer(r.sums, np.float32).reshape(2, -1, CLASSES)
            at = slice(r.piece * ROWS_SENT, r.piece * ROWS_SENT + len(seen))
            weights[at] += STEP * np.log((seen + SHRINK) / (expected + SHRINK))
        sent.unpersist()
    return weights


# --- scoring ------------------------------------------------------------------------------

SCORED = ("row bigint, doc_id {id}, held_out boolean, n_tokens bigint, n_known bigint, words double,"
          " classes double, word binary, tf bigint")


def class_scores(space: Space, weights: np.ndarray, offset: np.ndarray, block: Block) -> np.ndarray:
    """Per token log10 of its class's probability, less the log10 mass of the class."""
    first, second = block.contexts()
    cls = block.cls[block.at]
    out = np.zeros(len(cls))
    for k in range(0, len(cls), PART):
        c = cls[k:k + PART]
        log_p = log_softmax(weights, space.features(first[k:k + PART], second[k:k + PART]))
        out[k:k + PART] = log_p[np.arange(len(c)), c] / np.log(10) - offset[c]
    return out


def _scored(sent):
    """Texts -> a row per text with the sums over its frequent words, and a row per
    other word with its count in the text. A text's row has a key no word equals."""
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        space, weights, offset, frequent, logs = sent.value
        logs = np.concatenate([logs, [np.nan]])
        for t, b in blocks(batches):
            place = pc.index_in(b.words, frequent).fill_null(len(logs) - 1).to_numpy()
            got = logs[place][b.at]
            lacks = np.isnan(got)
            starts = np.cumsum(b.size) - b.size
            doc = np.repeat(np.arange(len(b.size)), b.size)
            known = np.add.reduceat(~lacks, starts, dtype=np.int64)
            words = np.add.reduceat(np.where(lacks, 0, got), starts)
            classes = np.add.reduceat(class_scores(space, weights, offset, b), starts)
            row, n = t["row"].combine_chunks(), len(starts)
            keys = pa.array([b" %d" % r for r in row.to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [row, t["doc_id"].combine_chunks(), t["held_out"].combine_chunks(), pa.array(b.size), pa.array(known),
                 pa.array(words), pa.array(classes), keys, pa.nulls(n, pa.int64())], names=names)
            pair, tf = np.unique(doc[lacks] * len(b.words) + b.at[lacks], return_counts=True)
            for k in range(0, len(pair), 50_000):
                part = pair[k:k + 50_000]
                m = len(part)
                yield pa.RecordBatch.from_arrays(
                    [row.take(pa.array(part // len(b.words))), pa.nulls(m, t["doc_id"].type), pa.nulls(m, pa.bool_()),
                     pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64()),
                     pa.nulls(m, pa.float64()), b.words.take(pa.array(part % len(b.words))),
                     pa.array(tf[k:k + 50_000].astype(np.int64))], names=names)
        pa.default_memory_pool().release_unused()
    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "words", "classes", "word", "tf"]
    return scored


def score(docs: DataFrame) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score.

    Rows whose crc32(doc_id as text) % 10 is 0 are held out of all counts and updates.
    Whole texts of any length are scored; a null text counts as empty: one token, the
    end. Without training rows every word is unknown. Repeated rows give a row each;
    an empty table gives none.
    """
    docs = picked(docs, "doc_id", "text")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                       (crc_of_id() % 10 == 0).alias("held_out"),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data"))
    training = rows.filter("NOT held_out")
    counts = corpus_counts(training.select("data"))
    per_class = {r["class"]: (r.n, r.v) for r in counts.groupBy("class").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()}  # at most CLASSES rows
    mass = np.array([per_class.get(c, (0, 0)) for c in range(CLASSES)], float)
    n_all, v_all = int(mass[:, 0].sum()), int(mass[:, 1].sum())

    space = Space(n_all)
    # rows with one id may share an update; null ids take the first
    share = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(UPDATES)), F.lit(0)).cast("int")
    weights = train_classes(training.select(share.alias("share"), "data"), space, n_all, mass[:, 0])
    offset = np.log10(mass[:, 0] + SMOOTHING * (mass[:, 1] + 1))
    short = counts.filter(F.octet_length("word") <= LONGEST)
    frequent = sorted((bytes(r.word), r.log) for r in heaviest(short, "n", FREQUENT).select(
        "word", F.log10(F.col("n") + SMOOTHING).alias("log")).collect())  # FREQUENT * LONGEST bytes at most
    sent = docs.sparkSession.sparkContext.broadcast(
        (space, weights, offset, pa.array([w for w, _ in frequent], pa.binary()), np.array([x for _, x in frequent])))

    kind = dict(rows.dtypes)["doc_id"]
    parts = rows.mapInArrow(_scored(sent), SCORED.format(id=kind)).join(
        counts.select("word", "n"), "word", "left")
    other = F.col("tf") * F.log10(F.coalesce(F.col("n"), F.lit(0)) + SMOOTHING)
    sums = parts.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"),
        F.max("n_tokens").alias("n_tokens"),
        (F.max("n_known") + F.coalesce(F.sum(F.when(F.col("n").isNotNull(), F.col("tf"))), F.lit(0)))
        .alias("n_known"),
        (F.max("words") + F.coalesce(F.sum(other), F.lit(0.0))).alias("words"),
        F.max("classes").alias("classes"))
    norm = float(np.log10(n_all + SMOOTHING * (v_all + 1)))
    return sums.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("words") - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        (F.col("words") + F.col("classes")).alias("score"))


def op9_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
