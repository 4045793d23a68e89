"""ST2: late rows correct closed days, each once."""

import datetime as dt
import os
import random

import pytest

from meeple.operators import events as evops
from meeple.plans import fixtures as fx
from meeple.streaming import daily, ledger

SCHEMA = "event_id long, user_id long, event_type string, ts timestamp, value double, props string"


def row(i, day, hour=5):
    kind = "signup" if i % 5 == 0 else "view"
    return (i, i % 9, kind, dt.datetime(2024, 1, day, hour, tzinfo=dt.timezone.utc), 1.0, '{"k": %d}' % (i % 4))


def wanted(spark, rows):
    batch = evops.daily_counts(evops.parse_messages(fx.event_messages(spark.createDataFrame(rows, SCHEMA))))
    return sorted((r.date, r.kind, r.key, r.n) for r in batch.collect())


def put(spark, tmp_dir, n, rows):
    """A landing file, newer than those before it."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_dir}/f{n}")
    part = next(f for f in os.listdir(f"{tmp_dir}/f{n}") if f.endswith(".parquet"))
    os.makedirs(f"{tmp_dir}/in", exist_ok=True)
    os.link(f"{tmp_dir}/f{n}/{part}", f"{tmp_dir}/in/{n}.parquet")
    os.utime(f"{tmp_dir}/in/{n}.parquet", (1_700_000_000 + n, 1_700_000_000 + n))


def run(spark, tmp_dir):
    stream = daily.event_file_stream(spark, f"{tmp_dir}/in", "*.parquet", files_per_batch=1)
    ledger.start(evops.parse_messages(fx.event_messages(stream)), f"{tmp_dir}/out", f"{tmp_dir}/ck").awaitTermination()


def published(spark, tmp_dir):
    return sorted((r.date, r.kind, r.key, r.n) for r in daily.read_counts(spark, f"{tmp_dir}/out/counts").collect())


def test_stream_with_rows_days_late_equals_batch(spark, tmp_dir):
    r = random.Random(1)
    rows = [row(i, r.randint(1, 20), r.randint(0, 23)) for i in range(400)]
    late = [x for x in rows if r.random() < 0.2]
    timely = [x for x in rows if x not in late]
    files = [timely[:200], [x for x in late if x[0] % 2], timely[200:], [x for x in late if not x[0] % 2], [row(999, 30)]]
    for n, part in enumerate(files):
        put(spark, tmp_dir, n, part)
        if n in (1, 4):  # the query ends and starts again from its checkpoint
            run(spark, tmp_dir)
    assert published(spark, tmp_dir) == wanted(spark, rows)  # the 30th is still open
    found = ledger.entries(spark, f"{tmp_dir}/out")
    assert found.filter("late").count() > 0
    ledger.publish(spark, f"{tmp_dir}/out")
    assert published(spark, tmp_dir) == wanted(spark, rows + [row(999, 30)])
    docs = {r.date: r.value for r in spark.read.schema("value string, date string").text(f"{tmp_dir}/out/reports").collect()}
    assert sorted(docs) == sorted({x[0] for x in wanted(spark, rows + [row(999, 30)])})


def counted(spark, rows):
    return evops.countable(evops.parse_messages(fx.event_messages(spark.createDataFrame(rows, SCHEMA))))


def test_a_replayed_batch_counts_once(spark, tmp_dir, monkeypatch):
    base = f"{tmp_dir}/out"
    parts = [[row(i, 3) for i in range(30)], [row(i, 10) for i in range(30, 50)], [row(i, 3) for i in range(50, 60)]]
    ledger.apply_batch(counted(spark, parts[0]), 0, base)
    ledger.apply_batch(counted(spark, parts[1]), 1, base)
    assert published(spark, tmp_dir) == wanted(spark, parts[0])
    with monkeypatch.context() as m:  # lost after the entries were written
        m.setattr(ledger, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            ledger.apply_batch(counted(spark, parts[2]), 2, base)
    assert published(spark, tmp_dir) == wanted(spark, parts[0])
    for _ in range(2):
        ledger.apply_batch(counted(spark, parts[2]), 2, base)
    assert published(spark, tmp_dir) == wanted(spark, parts[0] + parts[2])
    ledger.apply_batch(counted(spark, [row(0, 3)]).limit(0), 3, base)  # an empty batch
    assert published(spark, tmp_dir) == wanted(spark, parts[0] + parts[2])
