"""Quoted CSV cut at every byte reads as one task reads it."""

import random

import pytest
from pyspark.sql import types as T

from meeple.sources import files, quoted_csv

SCHEMA = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType()),
                       T.StructField("c", T.StringType())])
TEXTS = [
    'a,b,c\n1,2,3\n"x\ny",4,"p\n\n""q"", r\n"\n,5,\n"",6,""""\nlast,7,end',
    '\n\na,b,c\r\n"one\r\ntwo",1,x\r\n\r\n"3",2,"y"\r\n',
    '"a",b,"c"\n"é\n漢,字\n😀",8,"\n\n\n\n"\nplain,9,z\n',
    'a,b,c\n', '"a",b,"c"\n"' + "\n" * 40 + '",1,x\n',
]


def plain(spark, path):
    return (spark.read.schema(SCHEMA).option("header", "true").option("quote", '"').option("escape", '"')
            .option("multiLine", "true").csv(path))


def key(r):
    return tuple((x is None, x) for x in r)


@pytest.fixture()
def splits(spark):
    """Sets the size of the splits, and puts it back."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in names}

    def cut(size):
        for k, v in zip(names, (size, 1), strict=True):
            spark.conf.set(k, str(v))
    yield cut
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("n", range(len(TEXTS)))
def test_cut_at_every_byte(spark, tmp_path, splits, n):
    path = tmp_path / "t.csv"
    path.write_bytes(TEXTS[n].encode())
    # of a file with \r\n ends, Spark's own reader in this mode leaves the \r to the last field
    want = ([("one\r\ntwo", 1, "x"), ("3", 2, "y")] if "\r" in TEXTS[n]
            else [tuple(r) for r in plain(spark, str(path)).collect()])
    size = len(TEXTS[n].encode())
    for limit in sorted({1, 2, 3, 5, 7, 11, 16, size // 2 + 1, size + 1}):
        splits(limit)
        df = files.read_csv(spark, str(path), SCHEMA, position="at")
        got = sorted(df.collect(), key=lambda r: r["at"])
        assert [tuple(r)[:3] for r in got] == want, limit
        assert len({r["at"] for r in got}) == len(got)
    splits(1)
    lines = quoted_csv.lines_of(spark, str(path))
    assert lines.rdd.getNumPartitions() > 1


def test_random_files_of_many_splits(spark, tmp_path, splits):
    r = random.Random(3)
    rows = ['a,b,c']
    for i in range(400):
        cell = "".join(r.choice(['x', '""', "\n", ",", "é"]) for _ in range(r.randint(0, 12)))
        rows.append(f'"{cell}",{i},"{i}"')
    for name in ("one.csv", "two.csv"):
        (tmp_path / name).write_text("\n".join(rows) + "\n")
    want = sorted(map(tuple, plain(spark, str(tmp_path)).collect()), key=key)
    for limit in (64, 301, 1 << 20):
        splits(limit)
        got = files.read_csv(spark, str(tmp_path), SCHEMA, position="at").collect()
        assert sorted((tuple(x)[:3] for x in got), key=key) == want
        # positions follow each file's order, files one after another
        assert [x["b"] for x in sorted(got, key=lambda x: x["at"])] == [*range(400), *range(400)]


def test_quotes_that_do_not_pair_up_are_an_error(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('a,b,c\n5" tall,1,x\n')
    with pytest.raises(ValueError, match="pair up"):
        files.read_csv(spark, str(tmp_path / "bad.csv"), SCHEMA)


def test_columns_by_name(spark, tmp_path, splits):
    (tmp_path / "t.csv").write_text('z,c,"b",a\n"u\nv",three,2,"one\n1"\n')
    splits(4)
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "t.csv"), SCHEMA).collect()] == [("one\n1", 2, "three")]
