"""Operator 11 against a brute-force ranking."""

import math
import re
from collections import Counter

import llm_data
import pytest

from meeple.llm import bloom_search as bs

RUN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, top=10):
    tf = [(i, Counter(RUN.findall((t or "").translate(LOWER)))) for i, t in docs]
    tf = [(i, c) for i, c in tf if c]
    n, total = len(tf), sum(sum(c.values()) for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in tf:
            m = 100 - 90 + (90 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in set(RUN.findall((text or "").translate(LOWER))) if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r, f[3], -f[0]) for r, f in enumerate(sorted(found, key=lambda f: f[:3])[:top], 1)]
    return sorted(out, key=str)


ITEMS = [(1, "one two ONE"), (2, None), (3, ""), (4, "tick tick"), (5, "naïve café 漢字"), (6, "zzzzzzz nowhere"),
         (7, "changed ab cd"), (None, "no id")]


def test_equals_brute_force(spark):
    docs = llm_data.documents()
    items = ITEMS + [(20 + i, docs[i][1]) for i in range(12)] + [(40, docs[-10][1])]
    found = bs.search(bs.build_index(llm_data.frame(spark, docs)),
                      spark.createDataFrame(items, "item_id int, text string"))
    assert sorted(map(tuple, found.collect()), key=str) == brute([(r[0], r[1]) for r in docs], items)


def test_small_blocks_and_queries_in_blocks_change_nothing(spark, monkeypatch):
    docs = llm_data.documents()
    items = [(i, docs[i][1]) for i in range(15)]
    for name, value in (("QUERY_BYTES", 500), ("BLOCK_DOCS", 5), ("CHUNK_DOCS", 23)):
        monkeypatch.setattr(bs, name, value)
    found = bs.search(bs.build_index(llm_data.frame(spark, docs).repartition(7)),
                      spark.createDataFrame(items, "item_id int, text string"), top=3)
    assert sorted(map(tuple, found.collect()), key=str) == brute([(r[0], r[1]) for r in docs], items, 3)


def test_ties_rank_by_id_and_empty_tables_give_nothing(spark):
    docs = spark.createDataFrame([(i, "same words here") for i in range(40, 0, -1)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "words")], "item_id int, text string")
    got = bs.search(bs.build_index(docs.repartition(3)), items).collect()
    assert [(r["rank"], r.doc_id) for r in got] == [(i, i) for i in range(1, 11)]
    assert bs.search(bs.build_index(llm_data.empty(spark)), items).count() == 0
    assert bs.search(bs.build_index(docs), items.limit(0)).count() == 0


@pytest.mark.parametrize("level", range(3))
def test_signatures_never_miss(level):
    import numpy as np
    names = [b"t%d" % i for i in range(50)]
    tf = np.full(50, 2 ** level)
    import pyarrow as pa
    b = bs._block([7], np.zeros(50, np.int64), np.arange(50), tf, pa.array(names))
    width = b.column("width")[0].as_py()
    bitmap = bs._read(b, 0, "slices")[0].reshape(width, -1)
    for at in range(level + 1):
        assert (np.bitwise_and.reduce(bitmap[bs.bits_of(bs.hashes(names), at, width)], axis=1) == 128).all()


def test_few_documents_are_scored(spark, monkeypatch):
    """The bounds do their work: far fewer documents are scored than hold a query term."""
    import numpy as np
    import pyarrow as pa
    import random
    r = random.Random(2)
    words = ["w%d" % int(r.paretovariate(0.6)) for _ in range(20_000)]
    texts = [" ".join(r.choices(words, k=r.randint(20, 120))) for _ in range(1500)]
    index = list(bs._blocks(list(range(1500)), texts))
    names = pa.array(sorted({t for x in texts[:5] for t in bs.terms_of(x)}))
    df = np.zeros(len(names), np.int64)
    for b in index:
        at = {t: i for i, t in enumerate(names.to_pylist())}
        terms, counts = bs._read(b, 0, "terms", "df")
        for t, n in zip(terms.to_pylist(), counts, strict=True):
            if t in at:
                df[at[t]] += n
    plan = bs._Plan([(i, sorted(set(bs.terms_of(texts[i])))) for i in range(5)], names, df, 1500,
                    sum(len(bs.terms_of(x)) for x in texts))
    scored = []
    exact = bs._exact
    monkeypatch.setattr(bs, "_exact", lambda docs, *a: (scored.append(len(docs)), exact(docs, *a))[1])

    class Sent:
        value = plan
    list(bs._searched(Sent, 10)(iter(index)))
    assert sum(scored) < 0.5 * 5 * 1500
