"""Pages out of the index equal pages of a sort, after every update."""

import random

import pytest

from meeple.operators import catalog
from meeple.operators.rank_index import RankIndex

SCHEMA = "id int, average double"


def ranked(rows, descending, nulls_first):
    def key(r):
        null = r[1] is None
        return (null != nulls_first, 0 if null else (-r[1] if descending else r[1]), r[0])
    return sorted(rows.items(), key=key)


@pytest.mark.parametrize("descending, nulls_first", [(True, True), (False, False)])
def test_pages_after_updates(spark, tmp_dir, descending, nulls_first):
    r = random.Random(3)

    def value():
        return r.choice([None, 0.0, -0.0, round(r.uniform(-5, 10), 1), 7.0])
    rows = {i: value() for i in range(200)}
    index = RankIndex(spark, f"{tmp_dir}/i", SCHEMA, "average", descending, nulls_first, rows_per_file=17)
    index.build(spark.createDataFrame(list(rows.items()), SCHEMA))
    for n in range(3):
        ids = r.sample(sorted(rows), 12) + [1000 + 10 * n + i for i in range(60 if n == 1 else 5)]
        old = [(i, rows[i]) for i in ids if i in rows]
        new = [(i, value()) for i in ids[2:]]  # the first two are removed
        index.update(spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA))
        for i in ids:
            rows.pop(i, None)
        rows.update(new)
        want = ranked(rows, descending, nulls_first)
        got = sorted(index.ranking().collect(), key=lambda x: x.pos)
        assert [(x.id, x.pos) for x in got] == [(i, p) for p, (i, _) in enumerate(want, 1)]
        assert index.total() == len(rows)
        for page in (1, 5, -(-len(rows) // 10), 99):
            got = sorted(index.page(page).collect(), key=lambda x: x.pos)
            assert [(x.pos, x.id) for x in got] == [(p, i) for p, (i, _) in enumerate(want, 1)][10 * page - 10:10 * page]


def test_a_page_reads_few_files_and_an_update_writes_few(spark, tmp_dir):
    rows = [(i, float(i % 500)) for i in range(2000)]
    index = RankIndex(spark, f"{tmp_dir}/i", SCHEMA, "average", rows_per_file=50)
    index.build(spark.createDataFrame(rows, SCHEMA))
    before = index.parts()
    assert len(before) == 40
    page = index.page(150)
    assert len(page.inputFiles()) <= 2
    want = catalog.page(spark.createDataFrame(rows, SCHEMA), catalog.ordered_by("average", True, True), 150)
    assert sorted(map(tuple, page.select("id", "pos").collect())) == sorted(map(tuple, want.select("id", "pos").collect()))
    one = [r for r in rows if r[0] == 77]
    index.update(spark.createDataFrame(one, SCHEMA), spark.createDataFrame([(77, 499.5)], SCHEMA))
    after = index.parts()
    assert len([p for p in after if p not in before]) == 2  # the file it left, the one it entered
    assert index.page(1).collect()[0].id == 77
    assert [p.n for p in index.parts(1)] == [50] * 40  # the version before is still whole


def test_empty(spark, tmp_dir):
    index = RankIndex(spark, f"{tmp_dir}/i", SCHEMA, "average")
    none = spark.createDataFrame([], SCHEMA)
    assert index.page(1).count() == 0 and index.total() == 0
    index.update(none, none)
    assert index.ranking().count() == 0 and index.page(3).count() == 0
    index.update(none, spark.createDataFrame([(1, None)], SCHEMA))
    assert [tuple(r) for r in index.page(1).collect()] == [(1, None, 1)]


def test_a_row_does_not_meet_every_file(spark, tmp_dir):
    rows = [(i, float(i % 50)) for i in range(300)]
    index = RankIndex(spark, f"{tmp_dir}/i", SCHEMA, "average", rows_per_file=10)
    index.build(spark.createDataFrame(rows, SCHEMA))
    plan = index.ranking()._jdf.queryExecution().analyzed().toString()
    assert "lambdafunction" not in plan
