from meeple.functions import events as ev
from meeple.functions import text


def test_to_number_bad_text_is_null(spark):
    df = spark.createDataFrame([("12",), (" 12 ",), ("Not Ranked",), (None,)], "s string")
    got = [r[0] for r in df.select(text.to_number("s")).collect()]
    assert got == [12.0, 12.0, None, None]


def test_category_list_rules(spark):
    rows = [("['A', 'B']",), ('["Children\'s Game", \'B\']',), ("[]",), (None,)]
    df = spark.createDataFrame(rows, "c string")
    got = [r[0] for r in df.select(text.category_list("c")).collect()]
    assert got == [["A", "B"], ["Childrens Game", "B"], [], []]


def test_null_tokens(spark):
    df = spark.createDataFrame([("",), ("NA",), ("bob",)], "u string")
    assert [r[0] for r in df.select(text.null_tokens("u")).collect()] == [None, "NA", "bob"]
    got = [r[0] for r in df.select(text.null_tokens("u", text.PANDAS_NULL_TOKENS)).collect()]
    assert got == [None, None, "bob"]


def test_display_rules(spark):
    df = spark.createDataFrame([(None,), (5.925,), (7.9,)], "a double")
    rows = df.select(text.two_decimals_text("a").alias("t"), text.int_or_zero("a").alias("i"),
                     text.round_half_up_2("a").alias("r")).collect()
    assert rows[0]["t"] is None and rows[0]["i"] == 0 and rows[0]["r"] is None
    assert rows[1]["t"] in ("5.93", "5.92") and rows[1]["r"] == 5.93
    assert rows[2]["i"] == 7


def test_key_text_and_view_json_keep_null_user(spark):
    df = spark.createDataFrame([(None, 7)], "user_id int, game_id int")
    r = df.select(text.key_text("user_id").alias("k"),
                  ev.game_viewed_json("user_id", "game_id").alias("v")).first()
    assert r["k"] == "None"
    assert r["v"] == '{"event":"game_viewed","user_id":null,"game_id":7}'


def test_parse_event_bad_text_gives_nulls(spark):
    df = spark.createDataFrame([("oops",), ('{"event":"user_created","user_id":3,"username":"x"}',)], "v string")
    rows = df.select(ev.parse_event("v").alias("e")).collect()
    assert rows[0]["e"] is None or rows[0]["e"]["event"] is None
    assert rows[1]["e"]["event"] == "user_created" and rows[1]["e"]["user_id"] == 3
