import hashlib
import random

import numpy as np
import pytest
from llm_data import documents, empty, frame

from meeple.llm import piece_fst
from meeple.llm.common import tokenizer_path


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(piece_fst.MODEL))


@pytest.fixture(scope="module")
def fst():
    return piece_fst.PieceFst(tokenizer_path(piece_fst.MODEL))


def test_matches_the_library(fst, library):
    r = random.Random(1)
    parts = list("aeiou tnrslhd  ▁\n\té漢字😀.<0x>s/1230==--") + ["the ", "ing", "    ", "return ", "<s>", "<0x0A>", "\0"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(3000)]
    texts += [" " * k for k in range(70)] + ["a" + " " * k + "b" for k in range(40)] + [t or "" for _, t, *_ in documents()]
    cache = piece_fst.Paths(20_000)  # a small one: words come and go
    for t in texts:
        ids = fst.encode(t, cache)
        assert ids.tolist() == library.encode(t)
        assert fst.decode(ids) == t.replace("▁", " ")


def test_merge_order_is_the_definition(fst):
    r = random.Random(2)
    pieces = [p for p in fst.lexicon if len(p) < 8]
    for _ in range(5000):
        u, v = r.choice(pieces), r.choice(pieces)
        assert fst.follows(u, v) == (fst.merged(u + v) == [u, v])
    for _ in range(300):
        word = "▁" + "".join(r.choice("etaoinshr") for _ in range(r.randint(1, 40)))
        assert path_of(fst, word) == fst.merged(word)


def path_of(fst, word):
    """Pieces, or characters that are none, of the least path."""
    pieces, sizes = fst.shortest_paths([word])
    out, at = [], 0
    for p in pieces[0, :sizes[0]][::-1].tolist():
        out.append(fst.names[p] if p >= 0 else word[at])
        at += len(out[-1])
    return out


def test_the_path_is_the_only_finite_one(fst):
    """All paths through the composition, weighted by the definition: one is finite."""
    r = random.Random(3)

    def paths(word):
        if not word:
            yield []
        for k in range(1, len(word) + 1):
            if word[:k] in fst.lexicon:
                for rest in paths(word[k:]):
                    yield [word[:k], *rest]
    for _ in range(150):
        word = "▁" + "".join(r.choice("etaoinsh") for _ in range(r.randint(1, 7)))
        finite = [p for p in paths(word) if all(fst.merged(u + v) == [u, v] for u, v in zip(p, p[1:], strict=False))
                  and all(fst.merged(u) == [u] for u in p)]
        assert finite == [path_of(fst, word)]


def test_strings_of_few_letters_and_without_pieces(fst):
    r = random.Random(4)
    words = ["".join(r.choice("=- \n.az\0漢\ue000"[:r.randint(2, 10)]).replace(" ", "▁") for _ in range(r.randint(1, 60)))
             for _ in range(2000)]
    parts = [p for w in words for p in fst.cuts(w)]
    want = [b"".join(fst.packed[fst.lexicon[p]] if p in fst.lexicon else fst._bytes(p) for p in fst.merged(x))
            for x in parts]
    assert fst.ids(parts) == want


def test_integer_map():
    m = piece_fst.IntMap(np.int32)
    r = np.random.default_rng(0)
    keys = r.choice(1 << 40, 20_000, replace=False)
    for i in range(0, 20_000, 1700):
        m.put(keys[i:i + 1700], np.arange(i, min(i + 1700, 20_000)))
    assert (m.get(keys) == np.arange(20_000)).all()
    assert (m.get(keys + (1 << 41)) == -1).all()


def test_query_rows(spark, library):
    out = piece_fst.piece_digest(frame(spark)).collect()
    want = []
    for d, t, *_ in documents():
        ids = np.array(library.encode(t or ""), "<i4")
        want.append((str(d), len((t or "").encode()), len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), True))
    assert sorted(want) == sorted((str(r.doc_id), r.n_bytes, r.n_pieces, r.ids_sha256, r.round_trip) for r in out)
    both = piece_fst.with_text(piece_fst.with_ids(frame(spark))).collect()
    assert all(r.decoded == (r.text or "").replace("▁", " ") for r in both)
    assert piece_fst.piece_digest(empty(spark)).collect() == []
