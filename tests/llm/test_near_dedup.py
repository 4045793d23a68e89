import random
from collections import defaultdict

import numpy as np
from llm_data import documents, empty, frame, sentence

from meeple.llm import near_dedup as nd


def brute(rows, width=4, percent=80):
    """(shingles, component id, kept) of each row; kept is a count for rows without any
    id in their component, of which one stays."""
    sets = []
    for _, t, *_ in rows:
        w = [x.lower() for x in (t or "").encode().split()]
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def link(x, y):
        a, b = sorted((find(x), find(y)))
        parent[b] = a
    holders, by_id = defaultdict(list), {}
    for i, (d, *_) in enumerate(rows):
        common = defaultdict(int)
        for s in sets[i]:
            for e in holders[s]:
                common[e] += 1
            holders[s].append(i)
        for e, n in common.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[e]) - n):
                link(i, e)
        if d is not None and sets[i]:
            link(i, by_id.setdefault(d, i))
    least = defaultdict(list)
    for i, (d, *_) in enumerate(rows):
        least[find(i)].append(d)
    name = {k: min((d for d in ds if d is not None), default=None) for k, ds in least.items()}
    return [(len(sets[i]), d if not sets[i] else name[find(i)]) for i, (d, *_) in enumerate(rows)]


def near_copies(seed=2, groups=12, size=9):
    """Chains of copies that drift apart, so that ends of a component are no link."""
    r = random.Random(seed)
    rows, i = [], 5000
    shared = sentence(r, 60)  # a passage that all documents share
    for _ in range(groups):
        w = sentence(r, r.randint(60, 200)).split()
        for _ in range(size):
            for _ in range(r.randint(0, 3)):
                w[r.randint(0, len(w) - 1)] = sentence(r, 1)
            rows.append((i, shared + " " + " ".join(w), "en", "a", 0, 1, 1.0, 1))
            i += 1
    return rows


def no_ids():
    """Equal and near copies of which some or all have no id."""
    r = random.Random(8)
    w, v = sentence(r, 80), sentence(r, 90)
    near = w.split()
    near[40] = "changed"
    texts = [(None, w), (None, w), (None, " ".join(near)), (None, v), (7000, v), (None, v), (None, None), (None, ""),
             (7001, w + " x y z"), (7002, "one two three four five"), (7002, sentence(r, 30))]
    return [(d, t, "en", "a", 0, 1, 1.0, 1) for d, t in texts]


def test_matches_brute_force(spark, monkeypatch):
    rows = documents() + near_copies() + no_ids()
    want = sorted(((d, *w) for (d, *_), w in zip(rows, brute(rows), strict=True)), key=str)
    for large, partners in ((256, 512), (2, 2)):  # with and without splitting of large buckets and hubs
        monkeypatch.setattr(nd, "LARGE", large)
        monkeypatch.setattr(nd, "PARTNERS", partners)
        out = nd.near_groups(frame(spark, rows)).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str) == want
        assert all(r.kept == (r.doc_id == r.component_id) for r in out if r.doc_id is not None)


def test_rows_without_ids_are_compared(spark):
    rows = [r for r in no_ids() if r[0] is None and r[1]]
    out = nd.near_groups(frame(spark, rows)).collect()
    assert sorted((r.n_shingles, r.component_id, r.kept) for r in out) == [
        (77, None, False), (77, None, False), (77, None, True), (87, None, False), (87, None, True)]


def test_parts_of_large_buckets_change_nothing(spark, monkeypatch):
    r = random.Random(9)
    rows = []
    for g in range(6):  # pairs about the bound, many with one band in common only
        shared = sentence(r, 60)
        rows += [(100 * g + i, shared + " " + sentence(r, r.randint(20, 60)), "en", "a", 0, 1, 1.0, 1)
                 for i in range(40)]
    r.shuffle(rows)
    got = []
    for large in (10_000, 2):
        monkeypatch.setattr(nd, "LARGE", large)
        got.append(sorted(tuple(x) for x in nd.near_groups(frame(spark, rows), percent=55).collect()))
    assert got[0] == got[1]
    assert 6 < len({x[2] for x in got[0]}) < len(rows)


def test_sketch_estimates_and_filter():
    rng = np.random.RandomState(1)
    a, b = nd._constants(nd.SAMPLES, 1), nd._constants(nd.SAMPLES, 2)
    bound = nd.most_unlike_bits(80, nd.SAMPLES, nd.SKETCH)
    for j, inside in ((0.8, True), (0.95, True), (0.2, False)):
        n, hit = 400, 0
        for _ in range(60):
            both = int(2 * n * j / (1 + j))
            x = rng.randint(1, 1 << 62, 2 * n - both).astype(np.uint64)
            s = [nd.odd_sketch(nd.samples(nd._mix(p), a, b), nd.SKETCH) for p in (x[:n], x[n - both:])]
            unlike = np.unpackbits((s[0] ^ s[1]).view(np.uint8)).sum()
            hit += (unlike <= bound) == inside
        assert hit == 60


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (10, 9), (9, 8), (20, 21)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r.id: r.component for r in nd.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert [got[i] for i in (1, 4, 8, 10, 21, 140)] == [1, 1, 8, 8, 20, 100]


def test_empty(spark):
    assert nd.near_groups(empty(spark)).collect() == []
