import datetime as dt
import json
import os
import time

from pyspark.sql import functions as F

from meeple.operators import events as evops
from meeple.plans import fixtures as fx
from meeple.streaming import daily

EV_SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def _msgs(spark, rows):
    return spark.createDataFrame(rows, "key string, value string, timestamp timestamp")


def test_dead_letters_and_ignored_kinds(spark):
    t = dt.datetime(2024, 1, 1, 12)
    m = _msgs(spark, [("1", "oops", t), ("1", '{"event":"other"}', t), ("1", '{"event":"game_viewed"}', t),
                      ("None", '{"event":"game_viewed","user_id":null,"game_id":7}', t)])
    p = evops.parse_messages(m)
    assert sorted(r["value"] for r in evops.dead_letters(p).collect()) == ['oops', '{"event":"game_viewed"}']
    counted = evops.countable(p).collect()
    assert [(r["kind"], r["key"]) for r in counted] == [("game_viewed", "7")]


def test_view_message_signed_out(spark):
    views = spark.createDataFrame([(None, 7, dt.datetime(2024, 1, 1))], "user_id int, game_id int, ts timestamp")
    r = evops.view_messages(views).first()
    assert r["key"] == "None"
    assert json.loads(r["value"]) == {"event": "game_viewed", "user_id": None, "game_id": 7}


def test_daily_report_document(spark):
    t1, t2 = dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 2, 1)
    m = _msgs(spark, [("3", '{"event":"user_created","user_id":3,"username":"x"}', t1),
                      ("3", '{"event":"game_viewed","user_id":3,"game_id":7}', t1),
                      ("3", '{"event":"game_viewed","user_id":3,"game_id":7}', t1),
                      ("None", '{"event":"game_viewed","user_id":null,"game_id":8}', t2)])
    counts = evops.daily_counts(evops.parse_messages(m))
    docs = {r["date"]: json.loads(r["json"]) for r in evops.report_json(evops.daily_report(counts)).collect()}
    assert docs["2024-01-01"] == {"date": "2024-01-01", "user_counts": {"2024-01-01": 1}, "game_views": {"7": 2}}
    assert docs["2024-01-02"] == {"date": "2024-01-02", "user_counts": {}, "game_views": {"8": 1}}


def _day_rows(start_id, days, per_day=6):
    rows, i = [], start_id
    for d in days:
        for j in range(per_day):
            kind = "view" if j % 3 else "signup"
            rows.append((i, dt.datetime(2024, 1, d, 1 + j), j, kind, 1.0, json.dumps({"k": j % 2})))
            i += 1
    return rows


def test_stream_late_file_does_not_change_emitted_days(spark, tmp_dir):
    src = f"{tmp_dir}/landing"
    os.makedirs(src)
    files = [_day_rows(0, range(1, 20)), _day_rows(1000, range(20, 26)), _day_rows(2000, [1, 2])]
    for n, rows in enumerate(files):
        spark.createDataFrame(rows, EV_SCHEMA).coalesce(1).write.parquet(f"{tmp_dir}/f{n}")
        part = [f for f in os.listdir(f"{tmp_dir}/f{n}") if f.endswith(".parquet")][0]
        os.rename(f"{tmp_dir}/f{n}/{part}", f"{src}/events_{n}.parquet")
        os.utime(f"{src}/events_{n}.parquet", (time.time() + n, time.time() + n))
    stream = daily.event_file_stream(spark, src, file_glob="*.parquet", files_per_batch=1)
    counts = daily.daily_counts_stream(evops.parse_messages(fx.event_messages(stream)))
    q = daily.start_counts_sink(counts, f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    q.awaitTermination()
    out = spark.read.parquet(f"{tmp_dir}/out")
    got = {(str(r["date"]), r["kind"], r["key"]): r["n"] for r in out.collect()}
    # batch counts over the first two files only
    first_two = spark.createDataFrame(files[0] + files[1], EV_SCHEMA)
    batch = evops.daily_counts(evops.parse_messages(fx.event_messages(first_two)))
    want = {(r["date"], r["kind"], r["key"]): r["n"] for r in batch.collect()}
    assert got, "no day was emitted"
    for k, n in got.items():
        assert want[k] == n
    assert ("2024-01-01", "game_viewed", "1") in got
    # days still open at the end (within the watermark) are not emitted
    assert all(k[0] < "2024-01-25" for k in got)


def test_stream_report_sink_writes_one_document_per_day(spark, tmp_dir):
    src = f"{tmp_dir}/landing"
    os.makedirs(src)
    rows = _day_rows(0, range(1, 6))
    spark.createDataFrame(rows, EV_SCHEMA).coalesce(1).write.parquet(f"{tmp_dir}/f0")
    part = [f for f in os.listdir(f"{tmp_dir}/f0") if f.endswith(".parquet")][0]
    os.rename(f"{tmp_dir}/f0/{part}", f"{src}/events_0.parquet")
    stream = daily.event_file_stream(spark, src, file_glob="*.parquet")
    counts = daily.daily_counts_stream(evops.parse_messages(fx.event_messages(stream)))
    q = daily.start_report_sink(counts, f"{tmp_dir}/reports", f"{tmp_dir}/ckpt")
    q.awaitTermination()
    docs = spark.read.text(f"{tmp_dir}/reports").collect()
    parsed = sorted((json.loads(r["value"]) for r in docs), key=lambda d: d["date"])
    assert [d["date"] for d in parsed] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert parsed[0]["user_counts"] == {"2024-01-01": 2}
    assert parsed[0]["game_views"] == {"0": 2, "1": 2}


def test_running_totals_update_mode(spark, tmp_dir):
    src = f"{tmp_dir}/landing"
    os.makedirs(src)
    spark.createDataFrame(_day_rows(0, [3, 4]), EV_SCHEMA).coalesce(1).write.parquet(f"{src}/a")
    stream = daily.event_file_stream(spark, f"{src}/a", file_glob="*.parquet")
    totals = daily.running_totals_stream(evops.parse_messages(fx.event_messages(stream)))
    q = (totals.writeStream.outputMode("update").format("memory").queryName("meeple_totals")
         .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r["kind"], r["key"]): r["n"] for r in spark.sql("SELECT * FROM meeple_totals").collect()}
    assert got[("game_viewed", "0")] == 4 and got[("user_created", "2024-01-03")] == 2


def test_processing_time_days(spark, tmp_dir):
    src = f"{tmp_dir}/landing"
    os.makedirs(src)
    spark.createDataFrame(_day_rows(0, [3]), EV_SCHEMA).coalesce(1).write.parquet(f"{src}/a")
    stream = daily.event_file_stream(spark, f"{src}/a", file_glob="*.parquet")
    msgs = fx.event_messages(stream).withColumn("arrived", F.current_timestamp())
    counts = daily.daily_counts_stream(evops.parse_messages(msgs), "0 seconds", time_col="arrived")
    q = (counts.writeStream.outputMode("update").format("memory").queryName("meeple_proc")
         .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    today = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d")
    dates = {r["date"] for r in spark.sql("SELECT * FROM meeple_proc").collect()}
    assert dates and all(d >= today[:8] for d in dates)


def test_daily_sink_replay_is_idempotent(spark, tmp_dir):
    counts = spark.createDataFrame(
        [("2024-01-01", "game_viewed", "7", 3), ("2024-01-01", "user_created", "2024-01-01", 1),
         ("2024-01-02", "game_viewed", "8", 2)], "date string, kind string, key string, n long")
    for _ in range(2):  # the same micro-batch applied twice
        daily.write_daily(counts, 0, f"{tmp_dir}/c", f"{tmp_dir}/r")
    later = spark.createDataFrame([("2024-01-03", "game_viewed", "9", 1)], counts.schema)
    daily.write_daily(later, 1, f"{tmp_dir}/c", f"{tmp_dir}/r")
    got = sorted((str(r["date"]), r["kind"], r["key"], r["n"]) for r in spark.read.parquet(f"{tmp_dir}/c").collect())
    assert got == [("2024-01-01", "game_viewed", "7", 3), ("2024-01-01", "user_created", "2024-01-01", 1),
                   ("2024-01-02", "game_viewed", "8", 2), ("2024-01-03", "game_viewed", "9", 1)]
    docs = [json.loads(r["value"]) for r in spark.read.text(f"{tmp_dir}/r").collect()]
    assert sorted(d["date"] for d in docs) == ["2024-01-01", "2024-01-02", "2024-01-03"]
