import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_data import documents, empty, frame

from meeple.llm import maxent_lm as lm


def fold(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0


def brute(rows):
    counts = Counter()
    for d, t, *_ in rows:
        if not fold(d):
            counts.update(lm.tokens((t or "").encode()))
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, t, *_ in rows:
        ts = lm.tokens((t or "").encode())
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ts)
        out.append((str(d), fold(d), len(ts), sum(counts[w] > 0 for w in ts), n, round(base, 4)))
    return sorted(out)


@pytest.mark.parametrize("frequent, held, block", [(150_000, 400_000, 2 << 20), (5, 30, 500)])
def test_counts_and_base(spark, monkeypatch, frequent, held, block):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    monkeypatch.setattr(lm, "HELD", held)
    monkeypatch.setattr(lm, "BLOCK_BYTES", block)
    rows = documents()
    out = lm.score(frame(spark, rows)).collect()
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in out)
    assert got == brute(rows)


def plain_scores(rows, shares):
    """The model by its definition, one token after another, without Spark: shares gives
    the update that reads each training row."""
    texts = [lm.tokens((t or "").encode()) for _, t, *_ in rows]
    words = sorted({w for ts in texts for w in ts})
    hashed = lm.hashes(pa.array(words, pa.binary()))
    h = dict(zip(words, hashed.tolist(), strict=True))
    cls = dict(zip(words, lm.class_of(hashed, np.array([w == lm.END for w in words])).tolist(), strict=True))
    train = [i for i, r in enumerate(rows) if not fold(r[0])]
    counts = Counter(w for i in train for w in texts[i])
    mass, kinds = np.zeros(lm.CLASSES), np.zeros(lm.CLASSES)
    for w, n in counts.items():
        mass[cls[w]] += n
        kinds[cls[w]] += 1
    space = lm.Space(int(mass.sum()))
    weights = np.zeros((space.rows, lm.CLASSES))
    weights[0] = np.log((mass + 0.1) / (mass + 0.1).sum())

    def rows_of(ts, j):
        first, second = (np.array([h[ts[j - k]] if j >= k else 0], np.uint64) for k in (1, 2))
        return [0, *(int(r[0]) for r in space.features(first, second))]

    def log_p(ts, j):
        x = weights[rows_of(ts, j)].sum(axis=0)
        return x - np.log(np.exp(x).sum())
    for u in range(lm.UPDATES):
        seen, expected = np.zeros_like(weights), np.zeros_like(weights)
        for i in train:
            if shares[i] == u:
                for j, w in enumerate(texts[i]):
                    p = np.exp(log_p(texts[i], j))
                    for r in rows_of(texts[i], j):
                        seen[r, cls[w]] += 1
                        expected[r] += p
        weights += lm.STEP * np.log((seen + lm.SHRINK) / (expected + lm.SHRINK))
    return [sum(log_p(ts, j)[cls[w]] / np.log(10) + math.log10((counts[w] + 0.1) / (mass[cls[w]] + 0.1 * (kinds[cls[w]] + 1)))
                for j, w in enumerate(ts)) for ts in texts]


def test_scores_equal_the_plain_model(spark, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(lm, "PART", 50)
    monkeypatch.setattr(lm, "ROWS_SENT", 40)
    rows = [r for r in documents(n=40) if r[0] is not None and len(r[1] or "") < 3000]
    rows = list({r[0]: r for r in rows}.values())
    df = frame(spark, rows)
    shares = {r.doc_id: r.s for r in df.selectExpr("doc_id", f"pmod(xxhash64(doc_id), {lm.UPDATES}) AS s").collect()}
    want = plain_scores(rows, [shares[r[0]] for r in rows])
    got = {r.doc_id: r.score for r in lm.score(df.repartition(3)).collect()}
    for r, w in zip(rows, want, strict=True):
        assert got[r[0]] == pytest.approx(w, rel=2e-3, abs=2e-2)


def paired(seed, ending=""):
    """Words of which each is followed by one of two partners."""
    r = random.Random(seed)
    heads = ["".join(r.choice("klmnop") for _ in range(4)) + ending for _ in range(60)]
    pairs = {w: ["".join(r.choice("qrstuv") for _ in range(4)) + ending for _ in range(2)] for w in heads}
    rows = []
    for i in range(400):
        ts = []
        for _ in range(60):
            w = r.choice(heads)
            ts += [w, r.choice(pairs[w])]
        rows.append((i, " ".join(ts), "en", "a", 0, 1, 1.0, 1))
    return rows


@pytest.mark.parametrize("ending", ["", "same"])
def test_learns_pairs_of_words(spark, ending):
    """Also where the words' endings tell nothing: the truth is about -1.04 a token, words
    alone give -2.2."""
    held = [x for x in lm.score(frame(spark, paired(4, ending))).collect() if x.held_out]
    assert len(held) > 20
    n = sum(x.n_tokens for x in held)
    assert sum(x.base_score for x in held) / n < -2.1
    assert sum(x.score for x in held) / n > -1.75


def test_blocks_hold_the_tokens():
    r = random.Random(7)
    texts = [b"", b" ", b"one", b"A\x00b C\x1cd\x85e", b" x\ty\n", "É漢 ß É".encode(), b"w" * 70_000, b"a a\x0b\x0cA"]
    texts += ["".join(r.choice("ab \n\té") for _ in range(r.randint(0, 40))).encode() for _ in range(200)]
    for part in (texts, texts[:1], [b"", b""], texts[2:3]):
        b = lm.Block(part)
        names = b.words.to_pylist()
        got = [names[i] for i in b.at]
        assert got == [w for t in part for w in lm.tokens(t)]
        assert b.size.tolist() == [len(lm.tokens(t)) for t in part]
        assert b.hash.tolist() == [lm.hashes(pa.array([w], pa.binary()))[0] for w in names]
        assert len(set(b.hash.tolist())) == len(names)
        assert [c == 0 for c in b.cls] == [w == lm.END for w in names]


def test_space_grows_with_the_tokens():
    sizes = [lm.Space(n).rows for n in (0, 10 ** 4, 10 ** 6, 10 ** 8, 10 ** 10)]
    assert sizes == sorted(sizes) and sizes[-1] > 80 * sizes[1]
    assert all(lm.Space(n).rows * lm.CLASSES * 4 < 3000 * math.sqrt(n) for n in (10 ** 6, 10 ** 8, 10 ** 12))


def test_probabilities_sum_to_one():
    rng = np.random.RandomState(0)
    space = lm.Space(1000)
    weights = rng.randn(space.rows, lm.CLASSES).astype(np.float32)
    first, second = rng.randint(0, 1 << 60, (2, 500)).astype(np.uint64)
    p = np.exp(lm.log_softmax(weights, space.features(first, second)))
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5)
    # classes share out their words' counts and one unknown word each
    counts = {b"a": 3, b"b": 5}
    cls = lm.class_of(lm.hashes(pa.array(list(counts), pa.binary())), np.zeros(2, bool))
    for c in range(lm.CLASSES):
        mine = [n for n, k in zip(counts.values(), cls, strict=True) if k == c]
        total = sum(mine) + 0.1 * (len(mine) + 1)
        assert sum((n + 0.1) / total for n in mine) + 0.1 / total == pytest.approx(1)


def test_empty_and_no_training(spark):
    assert lm.score(empty(spark)).collect() == []
    d = next(i for i in range(100) if fold(i))
    out = lm.score(frame(spark, [(d, "a b", None, None, None, 1, 1.0, 1)])).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in out] == [(3, 0, 0)]
    assert out[0].base_score == pytest.approx(0.0)
