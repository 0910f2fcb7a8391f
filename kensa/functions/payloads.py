"""Request and response payloads (C8-C13), built with JSON and base64
expressions that run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str

# Fixed value: the question prefix the app puts before a user's text.
QUESTION_PREFIX = "質問: "

PREDICTION_SCHEMA = T.StructType([
    T.StructField("predictions", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()),
        T.StructField("score", T.DoubleType())])))])


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def b64(col: ColumnOrName) -> Column:
    """base64 text on one line.  Spark may wrap lines every 76
    characters (``spark.sql.chunkBase64String.enabled``); the breaks are
    removed here so the result does not depend on that session setting."""
    return F.replace(F.base64(_c(col)), F.lit("\r\n"), F.lit(""))


def data_uri(col: ColumnOrName, mime: ColumnOrName | str) -> Column:
    """``data:<mime>;base64,<bytes>``."""
    m = F.lit(mime) if isinstance(mime, str) and "/" in mime else _c(mime)
    return F.concat(F.lit("data:"), m, F.lit(";base64,"), b64(col))


def mime_of(path: ColumnOrName) -> Column:
    """MIME type from the file suffix (images are passed on as they are)."""
    p = F.lower(_c(path))
    return (F.when(p.rlike(r"\.jpe?g$"), F.lit("image/jpeg"))
             .when(p.endswith(".png"), F.lit("image/png"))
             .otherwise(F.lit("application/octet-stream")))


def prompt(col: ColumnOrName, prefix: str = QUESTION_PREFIX) -> Column:
    """Question text behind a fixed prefix."""
    return F.concat(F.lit(prefix), _c(col))


def chat_request(text: ColumnOrName, image_uri: ColumnOrName) -> Column:
    """C11: the message content list as JSON: a text part, then an image
    part only when there is an image.  Both parts share one struct type;
    ``to_json`` leaves out the null fields of each."""
    part_t = T.StructType([
        T.StructField("type", T.StringType()), T.StructField("text", T.StringType()),
        T.StructField("image_url", T.StructType([T.StructField("url", T.StringType())]))])
    text_part = F.struct(F.lit("text").alias("type"), _c(text).alias("text"),
                         F.lit(None).cast(part_t["image_url"].dataType).alias("image_url"))
    img_part = F.when(_c(image_uri).isNotNull(), F.struct(
        F.lit("image_url").alias("type"), F.lit(None).cast("string").alias("text"),
        F.struct(_c(image_uri).alias("url")).alias("image_url")))
    return F.to_json(F.array_compact(F.array(text_part, img_part)))


def user_message(content: ColumnOrName, parts: bool = False, role: str = "user") -> Column:
    """C11: the message list of a request, one message with a role and its content: a text, or
    (``parts``) a content list as ``chat_request`` gives it.  Null content gives null."""
    c = _c(content)
    if parts:
        return F.concat(F.lit('[{"role":"' + role + '","content":'), c, F.lit("}]"))
    return F.when(c.isNotNull(), F.to_json(F.array(F.struct(F.lit(role).alias("role"), c.alias("content")))))


def answer_text(response: ColumnOrName) -> Column:
    """The text of a model's answer, in the form of a chat completion or of an agent's
    output; null where the response has neither."""
    r = _c(response)
    return F.coalesce(F.get_json_object(r, "$.choices[0].message.content"), F.get_json_object(r, "$.output[0].content[0].text"))


def answer_or_error(df: DataFrame, col: str = "response", out: str = "answer") -> DataFrame:
    """C13 with C20: ``answer_text`` beside an ``error``, never an error text as an answer."""
    text = answer_text(col)
    return df.withColumn(out, text).withColumn("error", F.when(F.col(out).isNull(), F.lit("unreadable response")))


def score_request(col: ColumnOrName) -> Column:
    """``{"inputs": {"data": <base64>}}`` for a scoring endpoint."""
    return F.to_json(F.struct(F.struct(b64(col).alias("data")).alias("inputs")))


def parse_predictions(df: DataFrame, col: str = "response", keep: tuple = ()) -> DataFrame:
    """Response JSON -> one row per prediction ``(label, score)``.
    Broken text parses to null and gives no rows; a missing label stays null."""
    parsed = F.from_json(F.col(col), PREDICTION_SCHEMA)
    return df.select(*keep, F.inline(parsed["predictions"]))


def parse_predictions_or_error(df: DataFrame, col: str = "response", keep: tuple = ()) -> DataFrame:
    """C13 with C20: as ``parse_predictions``, but a response without
    predictions keeps one row, with an ``error`` text when it is broken
    (null for an empty list)."""
    parsed = F.from_json(F.col(col), PREDICTION_SCHEMA)
    error = F.when(parsed["predictions"].isNull(), F.lit("unreadable response"))
    return df.select(*keep, error.alias("error"), F.inline_outer(parsed["predictions"]))


def first_prediction(df: DataFrame, col: str = "response", out: str = "prediction") -> DataFrame:
    """P10: the first prediction of a response, null for an empty list or
    broken text."""
    parsed = F.from_json(F.col(col), PREDICTION_SCHEMA)
    return df.withColumn(out, F.try_element_at(parsed["predictions"], F.lit(1)))
