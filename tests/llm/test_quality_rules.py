import random
from collections import Counter

import numpy as np
from llm_data import documents, empty, frame
from llm_data import sentence as llm_sentence

from meeple.llm import quality_rules as q


def brute(text):
    t = text or ""
    w = t.encode().split()
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    seen = Counter(windows)
    hit = {i + k for i, x in enumerate(windows) if seen[x] > 1 for k in range(5)}
    lines, dup = set(), 0
    for line in t.split("\n"):
        if line.encode().split():
            dup += line in lines
            lines.add(line)
    return (len(w), sum(len(x.decode()) for x in w), sum(t.count(c) for c in "#*$%&|<>"), dup, len(hit))


def test_base_counts(spark):
    rows = documents() + [(900, "a b\na b\n\n\n a b\n# x|<>&\na b c d e a b c d e f", "en", "a", 1, 1, 1.0, 1)]
    out = q.quality(frame(spark, rows)).collect()
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out)
    assert got == sorted((str(d), *brute(t)) for d, t, *_ in rows)
    for r in out:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_verdict(spark):
    r = random.Random(5)
    en, de = q.COMMON["en"].split(), q.COMMON["de"].split()
    more = ["".join(r.choice("etaoinshrdlu") for _ in range(r.randint(3, 9))) for _ in range(3000)]

    def prose(common, n):
        w = [r.choice(common) if r.random() < 0.45 else r.choice(more) for _ in range(n)]
        return ". ".join(" ".join(w[i:i + 9]).capitalize() for i in range(0, n, 9)) + "."
    good = [(i, prose(en if i % 2 else de, r.randint(80, 600)), "en" if i % 2 else "de", "s", 0, 1, 1.0, 1) for i in range(120)]
    junk = [(1000 + i, " | ".join(r.choice(more).upper() + "###" for _ in range(200)), "en", "s", 0, 1, 1.0, 1) for i in range(20)]
    out = {x.doc_id: x for x in q.quality(frame(spark, good + junk)).collect()}
    assert all(out[i].kept for i in range(120))
    assert not any(out[1000 + i].kept or out[1000 + i].base_failed for i in range(20))


def test_distances_do_not_depend_on_the_layout(spark, monkeypatch):
    r = random.Random(6)
    rows = [(i, llm_sentence(r, r.randint(40, 90)) + "." * r.randint(0, 9), r.choice(["en", "de", "xx", "yy", None]), "s", 0, 1, 1.0, 1)
            for i in range(150)]
    got = []
    for parts, block in ((1, 256), (7, 256), (3, 2)):  # the last one holds the languages two at a time
        monkeypatch.setattr(q, "LANGUAGES", block)
        out = q.quality(frame(spark, rows).repartition(parts)).collect()
        got.append(sorted((x.doc_id, x.kept, x.char_distance, x.word_distance) for x in out))
    assert got[0] == got[1] == got[2]


def test_medians(spark):
    df = spark.createDataFrame([("a", [1, 3]), ("a", [1, 1]), ("a", [3, 1]), ("b", [0, 5])], "lang string, chars array<bigint>")
    got = {(x.lang, x["at"]): x.share for x in q.medians(df).collect()}
    assert got == {("a", 0): 0.5, ("a", 1): 0.5, ("b", 0): 0.0, ("b", 1): 1.0}


def test_distance():
    p = np.array([[1.0, 0, 0], [1, 1, 2]])
    assert np.allclose(q.js_distance(p, np.array([0, 0.5, 0.5]))[0], 1.0)
    assert np.allclose(q.js_distance(p, np.array([0.25, 0.25, 0.5]))[1], 0.0)


def test_empty(spark):
    assert q.quality(empty(spark)).collect() == []
