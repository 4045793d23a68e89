"""JDBC source/sink against embedded in-memory Derby (in-process, no server)."""

import uuid

import pytest

from meeple.sources import jdbc

DRIVER = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


@pytest.fixture()
def url():
    return f"jdbc:derby:memory:meeple{uuid.uuid4().hex[:8]};create=true"


def test_partitioned_read_uses_measured_bounds(spark, url):
    df = spark.range(0, 5000).selectExpr("CAST(id AS INT) AS user_id", "CAST(id % 7 AS INT) AS id",
                                         "CAST(id % 10 AS DOUBLE) AS rating")
    df.write.jdbc(url, "reviews", properties=DRIVER)
    back = jdbc.read_partitioned(spark, url, "reviews", "user_id", DRIVER, rows_per_partition=1000)
    assert back.rdd.getNumPartitions() == 5
    assert back.count() == 5000
    sizes = back.rdd.glom().map(len).collect()
    assert max(sizes) <= 1100


def test_uneven_keys_give_even_tasks(spark, url):
    """A gap of 90 % of the key range, a dense spot, one key of many rows, nulls."""
    rows = [(k, "low") for k in range(0, 900)] + [(1_000_000 - k, "high") for k in range(900)]
    rows += [(500_000, "one")] * 300 + [(None, "null")] * 50 + [(-40_000, "far")]
    spark.createDataFrame(rows, "k int, x string").write.jdbc(url, "uneven", properties=DRIVER)
    back = jdbc.read_partitioned(spark, url, "uneven", "k", DRIVER, rows_per_partition=220)
    sizes = back.rdd.glom().map(len).collect()
    assert sum(sizes) == len(rows)
    assert sorted(map(str, back.collect())) == sorted(map(str, spark.createDataFrame(rows, "k int, x string").collect()))
    assert 9 <= len(sizes) <= 14 and max(sizes) <= 350 and sorted(sizes)[len(sizes) // 2] >= 100
    few = jdbc.read_partitioned(spark, url, "uneven", "k", DRIVER, rows_per_partition=10, max_partitions=4)
    assert few.rdd.getNumPartitions() <= 6 and few.count() == len(rows)


def test_even_predicates_hold_every_row_once():
    ranges = [(0, 10, 5), (10, 20, 5), (20, 21, 50), (40, 60, 3)]
    parts = jdbc.even_predicates("k", ranges, 10)
    assert parts == ['"k" < 20 OR "k" IS NULL', '"k" >= 20 AND "k" < 40', '"k" >= 40']
    assert jdbc.even_predicates("k", ranges[:1], 10) == ["1 = 1"]


def _table(spark, url):
    return sorted(tuple(r) for r in spark.read.jdbc(url, "recs", properties=DRIVER).collect())


def test_a_failing_write_leaves_the_old_rows(spark, url):
    from pyspark.sql import functions as F
    schema = "user_id int, pos int, game_id int"
    old = [(1, 1, 1), (2, 1, 2)]
    jdbc.write_replace(spark.createDataFrame(old, schema), url, "recs", DRIVER)
    c = jdbc._connection(spark, url, DRIVER)
    jdbc._execute(c, 'ALTER TABLE recs ADD CONSTRAINT positive CHECK ("pos" > 0)',
                  'CREATE UNIQUE INDEX one_place ON recs ("user_id", "pos")')
    bad = [spark.createDataFrame([(3, 1, 1), (4, 0, 1)], schema),  # breaks the check
           spark.createDataFrame([(3, 1, 1), (3, 1, 2)], schema),  # breaks the unique key
           # a task fails while rows are being written
           spark.range(100).select(F.col("id").cast("int").alias("user_id"), F.lit(1).alias("pos"),
                                   F.when(F.col("id") < 90, 1).otherwise(F.raise_error(F.lit("lost"))).cast("int").alias("game_id"))]
    for df in bad:
        with pytest.raises(Exception):  # noqa: B017
            jdbc.write_replace(df, url, "recs", DRIVER)
        assert _table(spark, url) == old
    new = [(5, 1, 9), (5, 2, 8)]
    jdbc.write_replace(spark.createDataFrame(new, schema), url, "recs", DRIVER)
    assert _table(spark, url) == new
    with pytest.raises(Exception, match="(?i)unique|duplicate"):  # the key is still there
        jdbc._execute(c, "INSERT INTO recs VALUES (5, 1, 1)")
    tables = c.getMetaData().getTables(None, "APP", "RECS%", None)
    names = []
    while tables.next():
        names.append(tables.getString(3))
    assert names == ["RECS"]  # nothing is left beside it
    c.close()


def test_readers_never_see_half(spark, url):
    """A reader between the two statements of the swap waits or sees the old rows."""
    schema = "user_id int, pos int, game_id int"
    jdbc.write_replace(spark.createDataFrame([(1, 1, 1)], schema), url, "recs", DRIVER)
    seen, execute = [], jdbc._execute

    def watched(connection, *statements):
        for sql in statements:
            execute(connection, sql)
            if sql.startswith("DELETE"):
                c = jdbc._connection(spark, url, DRIVER)
                execute(c, "CALL SYSCS_UTIL.SYSCS_SET_DATABASE_PROPERTY('derby.locks.waitTimeout', '1')")
                try:
                    s = c.createStatement()
                    s.executeQuery("SELECT * FROM recs").next()
                    seen.append("rows")
                except Exception as e:  # noqa: BLE001
                    seen.append("waits" if "lock" in str(e) else str(e))
                finally:
                    c.close()
    jdbc._execute = watched
    try:
        jdbc.write_replace(spark.createDataFrame([(2, 1, 1)], schema), url, "recs", DRIVER)
    finally:
        jdbc._execute = execute
    assert seen == ["waits"] and _table(spark, url) == [(2, 1, 1)]


def test_write_replace_keeps_table(spark, url):
    a = spark.createDataFrame([(1, 1, 1), (2, 1, 2)], "user_id int, pos int, game_id int")
    b = spark.createDataFrame([(3, 1, 9)], "user_id int, pos int, game_id int")
    jdbc.write_replace(a, url, "recs", DRIVER)
    jdbc.write_replace(b, url, "recs", DRIVER)
    rows = spark.read.jdbc(url, "recs", properties=DRIVER).collect()
    assert [(r["USER_ID"] if "USER_ID" in r else r["user_id"]) for r in rows] == [3]


def test_kafka_source_needs_connector(spark):
    from pyspark.errors import AnalysisException

    from meeple.sources import kafka
    if spark._jvm.java.lang.Thread.currentThread().getContextClassLoader().getResource(
            "org/apache/spark/sql/kafka010/KafkaSourceProvider.class"):
        pytest.skip("the connector is here; the topic functions need a broker")
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        kafka.read_events(spark, "localhost:1")


def test_recommendation_job_publishes_long_form_over_jdbc(spark, url):
    from meeple.operators import recommend
    from meeple.plans import fixtures as fx, jobs
    from conftest import SF_SMALL
    params = recommend.AlsParams(min_reviews=25, max_iter=3)
    out = jobs.run_recommendations(spark, fx.reviews(spark, SF_SMALL), params,
                                   jdbc_url=url, jdbc_table="recs_long", jdbc_props=DRIVER,
                                   long_form=True)
    back = spark.read.jdbc(url, "recs_long", properties=DRIVER)
    n1 = back.count()
    assert n1 > 0 and out["users"] == back.select(back.columns[0]).distinct().count()
    # a second run replaces the rows instead of appending
    jobs.run_recommendations(spark, fx.reviews(spark, SF_SMALL), params,
                             jdbc_url=url, jdbc_table="recs_long", jdbc_props=DRIVER, long_form=True)
    again = spark.read.jdbc(url, "recs_long", properties=DRIVER)
    assert again.count() == n1
