import hashlib
import re
from collections import defaultdict

import pytest
from llm_data import documents, empty, frame

from meeple.llm import exact_dedup


@pytest.mark.parametrize("block", [16, 4096])
def test_matches_brute_force(spark, block):
    rows = documents()
    norm = [(d, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for d, t, *_ in rows]
    groups = defaultdict(list)
    for d, t in norm:
        groups[t].append(d)
    out = exact_dedup.exact_groups(frame(spark), block).collect()

    def small(ids):
        return min((d for d in ids if d is not None), default=None)
    want = sorted((str(d), str(small(groups[t])), len(groups[t]), hashlib.sha256(t.encode()).hexdigest())
                  for d, t in norm)
    assert want == sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in out)
    kept = [r for r in out if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)


def test_blocks_that_share_all_but_one(spark):
    a, b, c = "a" * 16, "b" * 16, "c" * 16
    texts = [a + b + c, a + b + c, a + c + b, a + b, b + a, a, a + b + c + a, a + b + c + b, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = exact_dedup.exact_groups(df, 16).collect()
    assert {r.doc_id: r.keep_id for r in out} == {i: texts.index(t) for i, t in enumerate(texts)}


def test_empty(spark):
    assert exact_dedup.exact_groups(empty(spark)).collect() == []


def test_a_third_of_equal_rows_is_dealt_out(spark):
    """The holders of one text never meet in a task: their names come back to many."""
    from pyspark.sql import functions as F
    rows = spark.range(0, 9000, 1, 30).selectExpr(
        "id AS row", "cast(if(id % 3 = 0, 'the same text', concat('text ', id)) AS binary) AS block")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    try:
        named = exact_dedup.integer_names(rows)
        by_task = sorted(r["count"] for r in named.groupBy(F.spark_partition_id()).count().collect())
        names = named.groupBy("name").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(r["count"] for r in names) == [1] * 6000 + [3000]
    assert by_task[-1] < 4 * by_task[len(by_task) // 2]
