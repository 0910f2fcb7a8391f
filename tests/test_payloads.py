import base64
import json

from pyspark.sql import functions as F

from kensa.functions import payloads as pl
from kensa.functions import scalar as sc


def test_b64_is_one_line_for_long_input(spark):
    data = bytes(range(256)) * 3
    df = spark.createDataFrame([(bytearray(data),)], "b binary")
    assert df.select(pl.b64("b")).first()[0] == base64.b64encode(data).decode()


def test_chat_request_parts(spark):
    df = spark.createDataFrame([("q1", None), ("q2", bytearray(b"\x01\x02"))], "q string, img binary")
    out = df.select(pl.chat_request(F.col("q"), pl.data_uri(F.col("img"), "image/jpeg")).alias("j")).collect()
    assert json.loads(out[0].j) == [{"type": "text", "text": "q1"}]
    assert json.loads(out[1].j) == [{"type": "text", "text": "q2"},
                                    {"type": "image_url", "image_url": {"url": "data:image/jpeg;base64,AQI="}}]


def test_score_request_shape(spark):
    df = spark.createDataFrame([(bytearray(b"abc"),)], "b binary")
    assert json.loads(df.select(pl.score_request("b")).first()[0]) == {"inputs": {"data": "YWJj"}}


def test_parse_and_first_prediction(spark):
    rows = [(1, '{"predictions":[{"label":"damaged","score":0.7},{"label":"normal","score":0.3}]}'),
            (2, '{"predictions":[]}'), (3, '{"predictions":[{"score":0.5}]}'), (4, '{"predictions":[{"lab')]
    df = spark.createDataFrame(rows, "id int, response string")
    parsed = pl.parse_predictions(df, keep=("id",)).collect()
    assert sorted((r.id, r.label) for r in parsed) == [(1, "damaged"), (1, "normal"), (3, None)]
    first = {r.id: r.prediction for r in pl.first_prediction(df).collect()}
    assert first[1].label == "damaged" and first[2] is None and first[3].label is None and first[4] is None


def test_mime_and_prompt(spark):
    df = spark.createDataFrame([("a/b.JPG",), ("c.png",), ("d.bin",)], "p string")
    assert [r[0] for r in df.select(pl.mime_of("p")).collect()] == ["image/jpeg", "image/png", "application/octet-stream"]
    assert spark.range(1).select(pl.prompt(F.lit("x"))).first()[0] == pl.QUESTION_PREFIX + "x"


def test_boxes_match_python(spark):
    sizes = [(6, 5), (8, 5), (5, 8), (300, 200), (7, 7), (1, 1)]
    df = spark.createDataFrame(sizes, "w int, h int")
    got = df.select("w", "h", sc.margin_box("w", "h").alias("m"), sc.square_box("w", "h").alias("s")).collect()
    for r in got:
        w, h = r.w, r.h
        assert tuple(r.m) == (int(w * 0.1), int(h * 0.1), int(w * (1 - 0.1)), int(h * (1 - 0.1)))
        s = min(w, h)
        assert tuple(r.s) == tuple(int(round(x)) for x in ((w - s) / 2, (h - s) / 2, (w + s) / 2, (h + s) / 2))
    sq = {(r.w, r.h): r.s for r in got}
    assert sq[(6, 5)].right - sq[(6, 5)].left == 6   # rounded box one pixel off square
    assert sq[(8, 5)].right - sq[(8, 5)].left == 4


def test_flag_and_round(spark):
    df = spark.createDataFrame([("true",), ("True",), (None,)], "f string")
    assert [r[0] for r in df.select(sc.flag("f")).collect()] == [True, False, False]
    assert spark.range(1).select(sc.round_ms(F.lit(1.23456))).first()[0] == 1.235


def test_broken_responses_keep_a_row_with_an_error(spark):
    df = spark.createDataFrame([(1, '{"predictions":[{"label":"damaged","score":0.5}]}'), (2, '{"predictions":[]}'),
                                (3, '{"predictions":[{"la'), (4, None)], "id long, response string")
    out = pl.parse_predictions_or_error(df, keep=("id",)).orderBy("id").collect()
    assert [(r.id, r.label, r.error) for r in out] == [
        (1, "damaged", None), (2, None, None), (3, None, "unreadable response"), (4, None, "unreadable response")]


def test_messages_and_answers(spark):
    df = spark.createDataFrame([('a "quoted" line\n', b"\x01"), (None, None), ("", None)], "q string, img binary")
    made = df.select(pl.user_message("q").alias("m"), pl.user_message(pl.chat_request("q", pl.data_uri("img", "image/png")), parts=True).alias("p")).collect()
    assert json.loads(made[0].m) == [{"role": "user", "content": 'a "quoted" line\n'}] and made[1].m is None and json.loads(made[2].m)[0]["content"] == ""
    (message,) = json.loads(made[0].p)
    assert message["role"] == "user" and [c["type"] for c in message["content"]] == ["text", "image_url"]
    rows = ['{"choices":[{"message":{"content":"yes"}}]}', '{"output":[{"content":[{"text":"no"}]}]}', '{"choices":[]}', "broken", None]
    got = pl.answer_or_error(spark.createDataFrame([(r,) for r in rows], "response string")).collect()
    assert [r.answer for r in got] == ["yes", "no", None, None, None] and [r.error is None for r in got] == [True, True, False, False, False]
