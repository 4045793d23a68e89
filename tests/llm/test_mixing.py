from collections import defaultdict

import pytest
from llm_data import documents, empty, frame
from pyspark.sql import functions as F

from meeple.llm import mixing


def water(sizes: dict, order: list) -> dict:
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    budget, full = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in full]
        left, w = budget - sum(full.values()), sum(weights[s] for s in open_)
        if not open_:
            return full
        over = [s for s in open_ if left * weights[s] / w > 2 * sizes[s]]
        if not over:
            return full | {s: left * weights[s] / w for s in open_}
        full |= {s: 2.0 * sizes[s] for s in over}


def test_targets_and_rounding(spark):
    rows = documents(n=300)
    out = mixing.mix(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    sizes = defaultdict(int)
    for _, t, _, s, *_ in rows:
        sizes[s] += len((t or "").encode().split())
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    want = water(sizes, order)
    by_id = {r[0]: r for r in rows}
    taken, largest = defaultdict(int), defaultdict(int)
    for r in out:
        s = by_id[r.doc_id][3]
        assert r.size == len((by_id[r.doc_id][1] or "").encode().split())
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert r.taken == r.copies * r.size <= 2 * r.size and 0 <= r.rate <= 2
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]
    again = mixing.mix(frame(spark, rows).repartition(7)).collect()
    key = lambda r: (str(r.doc_id), r.taken, r.target)
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_rates_solve_the_dual(spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 37 + 1).cast("int"))
                                 .alias("text"), F.when(F.col("id") % 5 == 0, "a").when(F.col("id") % 5 < 4, "b")
                                 .otherwise("c").alias("source"))
    out = mixing.mix(df).toPandas()
    for _, g in out.groupby("target"):
        assert (g.rate * g["size"]).sum() == pytest.approx(g.target.iloc[0], rel=1e-6)
        below = g[(g.rate < 2) & (g.rate > 0)]
        if len(below) > 1:  # log rate over size is one multiplier
            import numpy as np
            lam = np.log(below.rate) / below["size"]
            assert lam.max() - lam.min() < 1e-6


def test_empty_and_no_words(spark):
    assert mixing.mix(empty(spark)).collect() == []
    rows = [(1, None, None, None, None, 1, 1.0, 1), (2, " ", None, "a", None, 1, 1.0, 1)]
    assert [(r.size, r.target, r.taken) for r in mixing.mix(frame(spark, rows)).collect()] == [(0, 0.0, 0)] * 2
