"""Registered queries for scalar and payload functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from kensa.functions import payloads as pl
from kensa.functions.scalar import RUN_STAMP_PATTERN
from kensa.functions import scalar as sc
from kensa.operators.encoding import category_codes
from kensa.plans import views as v
from kensa.plans.registry import register
from kensa.sources.tables import table

MIRROR_FROM, MIRROR_TO = "https://", "http://mirror."


@register("C1_run_stamp", v.with_views(["runs"], f"""
SELECT run_key, regexp_extract(path, '{RUN_STAMP_PATTERN}', 1) AS stamp FROM runs"""))
def c1(spark, sf_dir):
    return v.runs(spark, sf_dir).select("run_key", sc.run_stamp("path").alias("stamp"))


@register("C2_parse_stamp", v.with_views(["runs"], f"""
SELECT run_key, try_strptime(regexp_extract(path, '{RUN_STAMP_PATTERN}', 1), '%Y-%m-%d_%H:%M:%S') AS run_ts FROM runs"""))
def c2(spark, sf_dir):
    return v.runs(spark, sf_dir).select("run_key", sc.parse_stamp(sc.run_stamp("path")).alias("run_ts"))


@register("C3_to_day", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def c3(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", sc.to_day("ts").alias("day"))


@register("C4_title_case", """
SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '),
         lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') AS title FROM part""")
def c4(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", sc.title_case("p_name").alias("title"))


@register("C5_content_key", "SELECT doc_id, sha1(text) AS content_key FROM documents")
def c5(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", sc.content_key("text").alias("content_key"))


@register("C6_noise_range", "SELECT event_id, true AS in_range FROM events")
def c6_range(spark, sf_dir):
    noisy = table(spark, sf_dir, "events").select("event_id", sc.noise(42).alias("noise"))
    return noisy.select("event_id", ((F.col("noise") >= 0) & (F.col("noise") < 1)).alias("in_range"))


@register("C6_noise_by_key", "SELECT event_id, CAST(CAST('0x' || substr(md5('42:' || event_id), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 AS noise FROM events")
def c6_key(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", sc.noise(42, "event_id").alias("noise"))


@register("C6_noise")
def c6(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", sc.noise(42).alias("noise"))


@register("C7_with_file_name", "SELECT p_partkey, 'part.parquet' AS file_name FROM part")
def c7(spark, sf_dir):
    # _metadata exists on the file scan itself, so read it here, not through a view.
    return table(spark, sf_dir, "part").select("p_partkey", F.col("_metadata.file_name").alias("file_name"))


@register("C8_b64", "SELECT doc_id, to_base64(encode(text)) AS b64 FROM documents")
def c8(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", pl.b64(F.col("text").cast("binary")).alias("b64"))


@register("C9_data_uri", "SELECT doc_id, 'data:text/plain;base64,' || to_base64(encode(text)) AS uri FROM documents")
def c9(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", pl.data_uri(F.col("text").cast("binary"), "text/plain").alias("uri"))


@register("C10_prompt", v.with_views(["chat"], f"""
SELECT conv_id, turn, '{pl.QUESTION_PREFIX}' || text AS prompt FROM chat WHERE role = 'user'"""))
def c10(spark, sf_dir):
    return v.chat(spark, sf_dir).where(F.col("role") == "user").select(
        "conv_id", "turn", pl.prompt("text").alias("prompt"))


@register("C11_chat_request", v.with_views(["report", "annotation"], f"""
SELECT r.doc_id,
  CASE WHEN a.doc_id IS NULL
       THEN '[' || json_object('type', 'text', 'text', '{pl.QUESTION_PREFIX}' || r.source)::VARCHAR || ']'
       ELSE '[' || json_object('type', 'text', 'text', '{pl.QUESTION_PREFIX}' || r.source)::VARCHAR || ','
                || json_object('type', 'image_url', 'image_url',
                       json_object('url', 'data:image/jpeg;base64,' || to_base64(encode(r.text))))::VARCHAR || ']'
  END AS request
FROM report r LEFT JOIN annotation a ON r.doc_id = a.doc_id"""))
def c11(spark, sf_dir):
    j = v.report(spark, sf_dir).join(
        v.annotation(spark, sf_dir).select("doc_id", F.lit(True).alias("has_image")), "doc_id", "left")
    image = F.when(F.col("has_image"), F.col("text").cast("binary"))
    uri = pl.data_uri(image, "image/jpeg")
    return j.select("doc_id", pl.chat_request(pl.prompt("source"), uri).alias("request"))


@register("C11_user_message", v.with_views(["chat"], f"""
SELECT conv_id, turn, '[' || json_object('role', 'user', 'content', '{pl.QUESTION_PREFIX}' || text)::VARCHAR || ']' AS messages,
       '[{{"role":"user","content":[' || json_object('type', 'text', 'text', text)::VARCHAR || ']}}]' AS with_parts
FROM chat WHERE role = 'user'"""))
def c11_message(spark, sf_dir):
    """Both message forms: a prompt as text, and a content list (here of a text alone)."""
    turns = v.chat(spark, sf_dir).where(F.col("role") == "user")
    parts = pl.chat_request("text", F.lit(None).cast("string"))
    return turns.select("conv_id", "turn", pl.user_message(pl.prompt("text")).alias("messages"), pl.user_message(parts, parts=True).alias("with_parts"))


@register("C13_answer_text", v.with_views(["chat"], """
SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 4 < 2 THEN text END AS answer,
       CASE WHEN (conv_id + turn) % 4 >= 2 THEN 'unreadable response' END AS error
FROM chat WHERE role <> 'user'"""))
def c13_answer(spark, sf_dir):
    """Assistant turns as responses in both forms, as empty ones and cut short, and back."""
    kind, said = (F.col("conv_id") + F.col("turn")) % 4, F.col("text").alias("content")
    chat = F.to_json(F.struct(F.array(F.struct(F.struct(F.lit("assistant").alias("role"), said).alias("message"))).alias("choices")))
    agent = F.to_json(F.struct(F.array(F.struct(F.array(F.struct(F.lit("output_text").alias("type"), F.col("text"))).alias("content"))).alias("output")))
    response = F.when(kind == 0, chat).when(kind == 1, agent).when(kind == 2, F.lit('{"choices":[]}')).otherwise(F.expr("substring(to_json(struct(text)), 1, 9)"))
    turns = v.chat(spark, sf_dir).where(F.col("role") != "user").select("conv_id", "turn", response.alias("response"))
    return pl.answer_or_error(turns).select("conv_id", "turn", "answer", "error")


@register("C12_score_request", """
SELECT doc_id, json_object('inputs', json_object('data', to_base64(encode(text))))::VARCHAR AS request FROM documents""")
def c12(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", pl.score_request(F.col("text").cast("binary")).alias("request"))


@register("C13_parse_predictions", v.with_views(["prediction_json"], """
SELECT item_id, p.label AS label, p.score AS score
FROM (SELECT item_id, unnest(from_json(response, '{"predictions":[{"label":"VARCHAR","score":"DOUBLE"}]}').predictions) AS p
      FROM prediction_json WHERE json_valid(response))"""))
def c13(spark, sf_dir):
    return pl.parse_predictions(v.prediction_json(spark, sf_dir), "response", keep=("item_id",))


@register("C20_prediction_errors", v.with_views(["prediction_json"], """
SELECT item_id, p.label AS label, p.score AS score, CAST(NULL AS VARCHAR) AS error
FROM (SELECT item_id, unnest(from_json(response, '{"predictions":[{"label":"VARCHAR","score":"DOUBLE"}]}').predictions) AS p
      FROM prediction_json WHERE json_valid(response))
UNION ALL
SELECT item_id, NULL AS label, NULL AS score, CASE WHEN NOT json_valid(response) THEN 'unreadable response' END AS error
FROM prediction_json WHERE NOT json_valid(response) OR json_array_length(response, '$.predictions') = 0"""))
def c20(spark, sf_dir):
    return pl.parse_predictions_or_error(v.prediction_json(spark, sf_dir), "response", keep=("item_id",))


@register("C14_base_name", "SELECT page_id, string_split(url, '/')[-1] AS name FROM pages")
def c14(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", sc.base_name("url").alias("name"))


@register("C15_swap_prefix", f"SELECT page_id, replace(url, '{MIRROR_FROM}', '{MIRROR_TO}') AS mirror_url FROM pages")
def c15(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", sc.swap_prefix("url", MIRROR_FROM, MIRROR_TO).alias("mirror_url"))


_FLAG_TEXT_SQL = "CASE event_type WHEN 'view' THEN 'true' WHEN 'error' THEN 'True' WHEN 'click' THEN 'false' END"


@register("C16_flag", f"SELECT event_id, coalesce({_FLAG_TEXT_SQL} = 'true', false) AS flag FROM events")
def c16(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    text = (F.when(F.col("event_type") == "view", "true").when(F.col("event_type") == "error", "True")
             .when(F.col("event_type") == "click", "false"))
    return ev.select("event_id", sc.flag(text).alias("flag"))


@register("C17_round_ms", "SELECT event_id, round(value / 7, 3) AS seconds FROM events")
def c17(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", sc.round_ms(F.col("value") / 7).alias("seconds"))


_SIZES_SQL = "SELECT p_partkey, p_size * 7 + 1 AS w, length(p_name) * 11 + 2 AS h FROM part"


def _sizes(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", (F.col("p_size") * 7 + 1).alias("w"), (F.length("p_name") * 11 + 2).alias("h"))


@register("C18_margin_box", f"""
SELECT p_partkey, CAST(trunc(w * 0.1) AS INTEGER) AS "left", CAST(trunc(h * 0.1) AS INTEGER) AS top,
       CAST(trunc(w * 0.9) AS INTEGER) AS "right", CAST(trunc(h * 0.9) AS INTEGER) AS bottom
FROM ({_SIZES_SQL})""")
def c18(spark, sf_dir):
    return _sizes(spark, sf_dir).select("p_partkey", sc.margin_box("w", "h", 0.1).alias("b")).select("p_partkey", "b.*")


@register("C19_square_box", f"""
SELECT p_partkey, CAST(round_even((w - least(w, h)) / 2, 0) AS INTEGER) AS "left",
       CAST(round_even((h - least(w, h)) / 2, 0) AS INTEGER) AS top,
       CAST(round_even((w + least(w, h)) / 2, 0) AS INTEGER) AS "right",
       CAST(round_even((h + least(w, h)) / 2, 0) AS INTEGER) AS bottom
FROM ({_SIZES_SQL})""")
def c19(spark, sf_dir):
    return _sizes(spark, sf_dir).select("p_partkey", sc.square_box("w", "h").alias("b")).select("p_partkey", "b.*")


@register("C21_category_codes", """
SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS p_type,
       CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS p_brand FROM part""")
def c21(spark, sf_dir):
    return category_codes(table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand"),
                          ["p_type", "p_brand"])
