"""Operator 10: SentencePiece encoding and decoding as a weighted transducer.

The model file is compiled into parts that are composed lazily with each input:

* the normaliser: a leading space if the model asks for it, spaces written as
  U+2581, all other characters kept;
* the lexicon: a trie of the pieces, each path giving one piece id;
* byte fallback: a character that is no piece gives the ids of its UTF-8 bytes;
* the merge order: a two-piece automaton. Its arc from piece u to piece v weighs
  0 if merging pair by pair turns the string uv into exactly u, v, and infinity
  if not. A sequence of pieces is the one the merges give exactly when all its
  neighbours are such pairs, so of the finite paths there is one.

Encoding is the shortest path in the tropical semiring (the least sum of
weights) through input o lexicon o byte fallback o merge order; decoding is the
inverse relation. States of the composition are (position, last piece id). Distances
are found in the order of positions: the least over the arcs that end there of the
distance of the state they come from plus their weight. As merging a prefix has one
outcome, one state of each position has a finite distance, so an arc is weighed
against one state only. The parts are compiled to integer tables: a trie of
the pieces that merging can make, and the weights of (piece, piece) arcs by number.
No piece holds a space after another character, nor a letter beside another kind of
character (both are checked when a model is compiled), so the composition falls apart
there, and the paths of words are kept in a cache bounded in bytes.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meeple.llm.common import picked, slices, small_batches, table, tokenizer_path, worker_state

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
HELD_BYTES = 32 << 20  # of words and their ids that a worker holds at once, about
ENTRY_BYTES = 180  # what an entry takes besides its characters and ids
HELD_PAIRS = 500_000  # arcs of the merge order held at once
TOGETHER = 1 << 18  # characters whose words are looked up together
NONE = -2  # no state of a position has a finite distance (so far)
UNKNOWN = -1  # a character that no piece holds, or the start: an arc from it is never infinite
LONGEST_HELD = 64  # characters of a word that is held


def parts_of(inside: set[str]) -> re.Pattern:
    """Cuts a text where no merge can cross, given the pairs of characters that stand
    side by side in pieces: before spaces, and between runs of letters and of others.
    Characters that stand beside the other kind in some piece count as no letters."""
    letter = re.compile(r"[^\W\d_]")
    odd: set[str] = set()
    while True:
        kind = lambda c: bool(letter.fullmatch(c)) and c not in odd
        new = {c for b in inside for c in b if b[0] != SPACE and kind(b[0]) != kind(b[1]) and kind(c)}
        if not new:
            break
        odd |= new
    odd_ = re.escape("".join(sorted(odd)))
    return re.compile(rf" *[^\W\d_{odd_}]+| *(?:[\W\d_{odd_}](?<! ))+| +")


class IntMap:
    """Integer keys (0 and above) to small integers, looked up whole arrays at a time."""

    def __init__(self, kind, size: int = 1 << 12):
        self.kind, self.n = kind, 0
        self._clear(size)

    def _clear(self, size: int) -> None:
        self.keys, self.values = np.full(size, -1, np.int64), np.zeros(size, self.kind)
        self.shift, self.n = np.uint64(64 - size.bit_length() + 1), 0

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """New distinct keys."""
        if 2 * (self.n + len(keys)) > len(self.keys):
            had = self.keys >= 0
            keys, values = np.concatenate([self.keys[had], keys]), np.concatenate([self.values[had], values])
            self._clear(1 << (4 * len(keys)).bit_length())
        self.n += len(keys)
        at, last = self._slot(keys), len(self.keys) - 1
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]  # of several keys for a slot the last one gets it
            won = self.keys[at] == keys
            self.values[at[won]] = values[won]
            keys, values, at = keys[~won], values[~won], (at[~won] + 1) & last

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 where a key isn't held."""
        at, last = self._slot(keys), len(self.keys) - 1
        there = self.keys[at]
        out = np.where(there == keys, self.values[at], -1)
        left = np.flatnonzero((there != keys) & (there >= 0))
        at = at[left]
        while len(left):
            at = (at + 1) & last
            there, wanted = self.keys[at], keys[left]
            hit = there == wanted
            out[left[hit]] = self.values[at[hit]]
            go = ~hit & (there >= 0)
            left, at = left[go], at[go]
        return out


class Paths:
    """Words and their ids in two generations of HELD_BYTES / 2: what was asked for since
    the young one began survives when the old one is let go."""

    def __init__(self, held: int | None = None):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.most, self.size = (HELD_BYTES if held is None else held) // 2, 0

    def put(self, word: str, ids: bytes) -> None:
        if len(word) > LONGEST_HELD:
            return
        if self.size >= self.most:
            self.old, self.young, self.size = self.young, {}, 0
        self.young[word] = ids
        self.size += len(word) + len(ids) + ENTRY_BYTES


class PieceFst:
    """Compiled transducer of one model file with byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb
        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm = model.normalizer_spec
        if (model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback
                or norm.precompiled_charsmap or norm.remove_extra_whitespaces
                or not norm.escape_whitespaces):
            raise ValueError("needs merge pieces with byte fallback and the identity normaliser")
        self.prefix = " " if norm.add_dummy_prefix else ""
        kinds = model.trainer_spec, model.pieces
        normal = {p.piece: i for i, p in enumerate(kinds[1]) if p.type == 1}
        self.score = {p.piece: p.score for p in kinds[1] if p.type == 1}
        self.lexicon = normal
        self.byte_id = {int(p.piece[3:5], 16): i for i, p in enumerate(kinds[1]) if p.type == 6}
        self.names = {i: p for p, i in normal.items()}
        self.inside = {p[k:k + 2] for p in normal for k in range(len(p) - 1)}
        if any(b[1] == SPACE != b[0] for b in self.inside):
            raise ValueError("pieces that run across spaces are not supported")
        # decoding: what each id writes
        self.written = [b""] * len(kinds[1])
        for p, i in normal.items():
            self.written[i] = p.replace(SPACE, " ").encode()
        for byte, i in self.byte_id.items():
            self.written[i] = bytes([byte])
        self.width = len(kinds[1])
        self.split: dict[str, tuple[str, str] | None] = {}
        self.edges: tuple[dict, dict] = ({}, {})
        # merges run in the order of scores if no piece outranks the parts it is made of
        self.ordered = all(
            parts is None or all(len(x) == 1 or self.score[x] >= self.score[p] for x in parts)
            for p, parts in ((p, self.halves(p)) for p in normal if len(p) > 1))
        # the trie as integers: (node, character) -> node, node -> piece. Pieces that
        # merging never makes have infinite weight everywhere and are left out
        made = {p: i for p, i in normal.items() if len(p) == 1 or self.halves(p) is not None}
        letters = {c: k for k, c in enumerate(sorted({c for p in made for c in p}), 1)}
        self.code = np.zeros(0x110000, np.int32)
        self.code[[ord(c) for c in letters]] = list(letters.values())
        self.letters, nodes, piece_at = len(letters) + 1, {}, [-1]
        for p, i in made.items():
            node = 0
            for c in p:
                key = node * self.letters + letters[c]
                node = nodes.setdefault(key, len(piece_at))
                if node == len(piece_at):
                    piece_at.append(-1)
            piece_at[node] = i
        self.nodes, self.piece_at = IntMap(np.int32), np.array(piece_at, np.int32)
        self.nodes.put(np.array(list(nodes), np.int64), np.array(list(nodes.values()), np.int32))
        self.pairs = IntMap(np.int8)  # arcs of the merge order, by u * width + v: finite or not
        self.packed = [struct.pack("<i", i) for i in range(self.width)]
        self.parts, self.longest = parts_of(self.inside), max(map(len, normal))

    def merged(self, text: str) -> list[str]:
        """The definition: merge the best-scored neighbours (leftmost of equals)."""
        at = list(text)
        while len(at) > 1:
            best, where = None, -1
            for i in range(len(at) - 1):
                s = self.score.get(at[i] + at[i + 1])
                if s is not None and (best is None or s > best):
                    best, where = s, i
            if best is None:
                break
            at[where:where + 2] = [at[where] + at[where + 1]]
        return at

    def halves(self, piece: str) -> tuple[str, str] | None:
        """The last merge that makes a piece; None if merging doesn't end in it."""
        if piece not in self.split:
            at = list(piece)
            while len(at) > 2:
                scores = [self.score.get(x + y, -np.inf) for x, y in zip(at, at[1:], strict=False)]
                i = scores.index(max(scores))
                if scores[i] == -np.inf:
                    break
                at[i:i + 2] = [at[i] + at[i + 1]]
            self.split[piece] = (at[0], at[1]) if len(at) == 2 else None
        return self.split[piece]

    def edge(self, piece: str, side: int) -> list[tuple[str, float]]:
        """Parts that stand at the left (0) or right (1) end of a piece while it is
        merged, each with the score of the merge that takes it up; the piece itself
        is never taken up."""
        got = self.edges[side].get(piece)
        if got is None:
            got, taken, x = [], -np.inf, piece
            while True:
                got.append((x, taken))
                parts = self.halves(x) if len(x) > 1 else None
                if parts is None:
                    break
                taken, x = self.score[x], parts[side]
            self.edges[side][piece] = got
        return got

    def follows(self, u: str, v: str) -> bool:
        """Whether the merge order has a finite arc from piece u to piece v.

        It has none if a part at the end of u and one at the start of v merge with
        each other before either is taken up inside its own piece (of equal scores
        the left merge goes first).
        """
        if len(v) > 1 and self.halves(v) is None:
            return False
        if u[-1] + v[0] not in self.inside:
            return True
        if u[-1] == v[0] == SPACE or not self.ordered:
            return self.merged(u + v) == [u, v]
        merges = self.score.get
        for x, cx in self.edge(u, 1):
            for y, cy in self.edge(v, 0):
                s = merges(x + y)
                if s is not None and s > cx and s >= cy:
                    return False
        return True

    def finite(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Whether the arcs from pieces u to v (numbers; UNKNOWN u: all) have finite weight."""
        key = np.where(u < 0, 0, u).astype(np.int64) * self.width + v
        known = np.where(u < 0, 1, self.pairs.get(key))
        new = np.unique(key[known < 0])
        if len(new):
            if self.pairs.n + len(new) > HELD_PAIRS:
                self.pairs = IntMap(np.int8)
            found = np.array([self.follows(self.names[k // self.width], self.names[k % self.width])
                              for k in new.tolist()], np.int8)
            self.pairs.put(new, found)
            lacks = known < 0
            known[lacks] = found[np.searchsorted(new, key[lacks])]
        return known > 0

    def shortest_paths(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The least paths of many strings: (pieces, sizes). Row r of pieces holds the
        piece numbers of string r from its end to its start (UNKNOWN: a character that
        is no piece), sizes their count, 0 if no path is finite.

        All strings go through their positions side by side. ``last[r, i]`` is the piece
        of the one state at position i whose distance from the start is finite, ``came``
        where its arc began.
        """
        n = np.fromiter(map(len, words), np.int64, len(words))
        wide = int(n.max(initial=1))
        codes = self.code[np.array(words, f"U{wide}").view(np.uint32).reshape(len(words), wide)]
        last = np.full((len(words), wide + 1), NONE, np.int32)
        came = np.zeros((len(words), wide + 1), np.int32)
        last[:, 0] = UNKNOWN

        def enter(rows, end, pieces, start):
            free = last[rows, end] == NONE
            last[rows[free], end], came[rows[free], end] = pieces[free], start

        for i in range(wide):
            rows = np.flatnonzero((n > i) & (last[:, i] != NONE))
            u, node, alone = last[rows, i], np.zeros(len(rows), np.int64), rows
            for k in range(1, min(self.longest, wide - i) + 1):
                c = codes[rows, i + k - 1]
                child = self.nodes.get(node * self.letters + c)
                goes = (child > 0) & (c > 0) & (n[rows] >= i + k)
                rows, u, node = rows[goes], u[goes], child[goes].astype(np.int64)
                if not len(rows):
                    break
                piece = self.piece_at[node]
                ends = piece >= 0
                if k == 1:  # characters that are no piece take the arc of their bytes
                    alone = np.setdiff1d(alone, rows[ends], assume_unique=True)
                good = np.flatnonzero(ends)
                good = good[self.finite(u[good], piece[good])]
                enter(rows[good], i + k, piece[good], i)
            enter(alone, i + 1, np.full(len(alone), UNKNOWN, np.int32), i)
        at, row = n.copy(), np.arange(len(words))
        sizes = np.zeros(len(words), np.int64)
        pieces = np.full((len(words), wide), NONE, np.int32)
        left = np.flatnonzero((last[row, n] != NONE) & (n > 0))
        for step in range(wide):
            if not len(left):
                break
            pieces[left, step] = last[left, at[left]]
            at[left] = came[left, at[left]]
            sizes[left] = step + 1
            left = left[at[left] > 0]
        return pieces, sizes

    def cuts(self, word: str) -> list[str]:
        """The word's parts between characters that no piece holds side by side: no
        merge crosses there, so their paths are independent."""
        inside, at, out = self.inside, 0, []
        for i in range(1, len(word)):
            if word[i - 1:i + 1] not in inside:
                out.append(word[at:i])
                at = i
        out.append(word[at:])
        return out

    def ids(self, words: list[str]) -> list[bytes]:
        """Ids of strings without cuts, as 32-bit little-endian numbers."""
        out: list[bytes] = [b""] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        at = 0
        while at < len(order):  # strings of like length together, in arrays of bounded size
            end = at
            while end < len(order) and (end == at or len(words[order[end]]) <= 1.5 * len(words[order[at]]) + 4) and (
                    end - at + 1) * (len(words[order[end]]) + 1) <= 1 << 20:
                end += 1
            mine = order[at:end]
            pieces, sizes = self.shortest_paths([words[i] for i in mine])
            odd = set(np.flatnonzero((sizes == 0) | (pieces == UNKNOWN).any(axis=1)).tolist())
            used = np.arange(pieces.shape[1])[::-1] < sizes[:, None]
            packed = pieces[:, ::-1][used].astype("<i4").tobytes()
            ends = (4 * np.cumsum(sizes)).tolist()
            for k, (i, start, stop) in enumerate(zip(mine, [0, *ends], ends, strict=False)):
                out[i] = (packed[start:stop] if k not in odd
                          else self._with_bytes(words[i], pieces[k, :sizes[k]][::-1].tolist()))
            at = end
        return out

    def _with_bytes(self, word: str, path: list[int]) -> bytes:
        if word and not path:  # not seen: merging always ends in pieces whose arcs are finite
            return b"".join(self.packed[self.lexicon[p]] if p in self.lexicon else self._bytes(p)
                            for p in self.merged(word))
        out, at = [], 0
        for p in path:
            out.append(self.packed[p] if p >= 0 else self._bytes(word[at]))
            at += len(self.names[p]) if p >= 0 else 1
        return b"".join(out)

    def _bytes(self, c: str) -> bytes:
        return b"".join(self.packed[self.byte_id[b]] for b in c.encode())

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of parts of texts; those that are no short run of letters are cut further."""
        spaced = [w.replace(" ", SPACE) for w in words]
        cut = [[w] if w[-1].isalpha() and len(w) <= LONGEST_HELD else self.cuts(w) for w in spaced]
        single = list(dict.fromkeys(c for cs in cut for c in cs))
        ids = dict(zip(single, self.ids(single), strict=True))
        return [b"".join([ids[c] for c in cs]) for cs in cut]

    def encode_all(self, texts: list[str | None], cache: Paths) -> list[np.ndarray]:
        """Ids of texts: their words are looked up together, what isn't held is searched
        together."""
        out: list[np.ndarray] = []
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end] or "") <= TOGETHER):
                size += len(texts[end] or "")
                end += 1
            words = [self.parts.findall(self.prefix + t.replace(SPACE, " ")) if t else [] for t in texts[at:end]]
            found = [list(map(cache.young.get, ws)) for ws in words]
            lacks = list(dict.fromkeys(w for ws, fs in zip(words, found, strict=True) if None in fs
                                       for w, f in zip(ws, fs, strict=True) if f is None))
            if lacks:
                fresh = {w: cache.old.get(w) for w in lacks}
                new = [w for w, got in fresh.items() if got is None]
                fresh.update(zip(new, self._word_ids(new), strict=True))
                for w, got in fresh.items():
                    cache.put(w, got)
                found = [[fresh[w] if f is None else f for w, f in zip(ws, fs, strict=True)] if None in fs else fs
                         for ws, fs in zip(words, found, strict=True)]
            out += [np.frombuffer(b"".join(fs), "<i4") for fs in found]
            at = end
        return out

    def encode(self, text: str, cache: Paths) -> np.ndarray:
        return self.encode_all([text], cache)[0]

    def decode(self, ids: np.ndarray) -> str:
        out = b"".join(map(self.written.__getitem__, ids.tolist()))
        if self.prefix and out.startswith(b" "):
            out = out[1:]
        return out.decode("utf-8", "replace")


def _fst(path: str) -> PieceFst:
    return worker_state(path, "fst", lambda: PieceFst(path))


def _encoded(path: str):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst, cache = _fst(path), worker_state(path, "words", Paths)
        for b in slices(batches):
            ids = fst.encode_all(b.column("text").to_pylist(), cache)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.list_(pa.int32()))],
                                             names=[*b.schema.names, "ids"])
    return encoded


def _decoded(path: str):
    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = _fst(path)
        for b in slices(batches):
            texts = [None if x is None else fst.decode(np.array(x, np.int32)) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())],
                                             names=[*b.schema.names, "decoded"])
    return decoded


def _kinds(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def with_ids(docs: DataFrame, model: str | None = None) -> DataFrame:
    """All columns of docs(text, ...) plus ``ids`` array<int> (replaced if present);
    null and empty texts have no ids."""
    small_batches(docs.sparkSession)
    docs = docs.drop("ids")
    return docs.mapInArrow(_encoded(model or tokenizer_path(MODEL)), f"{_kinds(docs)}, ids array<int>")


def with_text(docs: DataFrame, model: str | None = None) -> DataFrame:
    """All columns of docs(ids, ...) plus ``decoded`` string (replaced if present)."""
    docs = docs.drop("decoded")
    return docs.mapInArrow(_decoded(model or tokenizer_path(MODEL)), f"{_kinds(docs)}, decoded string")


def _digest(path: str):
    names = ["doc_id", "n_bytes", "n_pieces", "n_fallback", "ids_sha256", "round_trip"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst, cache = _fst(path), worker_state(path, "words", Paths)
        is_byte = np.zeros(len(fst.written), bool)
        is_byte[list(fst.byte_id.values())] = True
        for b in slices(batches):
            out: list[list] = [[] for _ in names[2:]]
            texts = b.column("text").to_pylist()
            for t, ids in zip(texts, fst.encode_all(texts, cache), strict=True):
                row = (len(ids), int(is_byte[ids].sum()), hashlib.sha256(ids.tobytes()).hexdigest(),
                       fst.decode(ids) == (t or "").replace(SPACE, " "))
                for o, v in zip(out, row, strict=True):
                    o.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_bytes"), pa.array(out[0], pa.int64()),
                 pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array(out[3], pa.bool_())],
                names=names)
    return digest


def piece_digest(docs: DataFrame, model: str | None = None) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, n_bytes, n_pieces, n_fallback (ids that
    are bytes), ids_sha256 (of the ids as 32-bit little-endian numbers) and
    round_trip (decoding gives the text back, U+2581 read as a space).

    Null text counts as empty: no pieces. Repeated rows give a row each; an empty
    table gives none. Begin and end tokens are not added.
    """
    docs = picked(docs, "doc_id", "text")
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "text")
    return rows.mapInArrow(_digest(model or tokenizer_path(MODEL)),
                           f"doc_id {kind}, n_bytes bigint, n_pieces bigint, n_fallback bigint,"
                           " ids_sha256 string, round_trip boolean")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digest(table(spark, sf_dir, "documents"))
