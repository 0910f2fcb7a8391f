"""Inspection-domain views over the driver tables.

The reference ships no data; these views map the driver tables onto the
tables its questions are about (see FIXTURES.md).  Each view exists twice:
as a Spark DataFrame builder and as DuckDB SQL for the oracle check.  Both
read the whole table; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kensa.sources.tables import table

# Event type -> anomaly kind(s) for the inspection view.
# 'view' -> 'normal', 'error' -> 'bent', 'click' -> 'scratch',
# 'purchase' -> 'melt,scratch', anything else -> 'missing'.
KIND_OF_EVENT = {"view": "normal", "error": "bent", "click": "scratch",
                 "purchase": "melt,scratch"}
OTHER_KIND = "missing"
NUMBER_OF_LINES = 25


def _case(col: Column, mapping: dict, default) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr.otherwise(F.lit(default))


def inspection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection_of(table(spark, sf_dir, "events"))


def inspection_of(ev: DataFrame) -> DataFrame:
    """The inspection mapping on any events DataFrame (batch or streaming)."""
    kind = _case(F.col("event_type"), KIND_OF_EVENT, OTHER_KIND)
    return ev.select(
        F.col("event_id").alias("item_id"), "ts", F.col("user_id").alias("unit_id"),
        F.col("value").alias("score"), kind.alias("kind"),
        F.when(F.col("event_type").eqNullSafe("view"), F.lit("normal"))
         .otherwise(F.lit("damaged")).alias("label"))


def production(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("unit_id"), F.col("c_nationkey").alias("line"))


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", "text", "source", (F.col("doc_id") % NUMBER_OF_LINES).alias("line"))


def annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels")


def chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model input: 64 floats (also an 8x8 one-channel image) and a planted label."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", "embedding", "label",
                      (F.col("embedding")[0] > 0).cast("int").alias("planted"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("run_key"),
        F.when(F.col("event_type").isin("view", "error"), F.lit("EXPERIMENT"))
         .otherwise(F.lit("OTHER")).alias("object_type"),
        F.concat(F.lit("/runs/"), F.col("event_type"), F.lit("/automl_"),
                 F.date_format("ts", "yyyy-MM-dd_HH:mm:ss")).alias("path"))


def _score_text() -> Column:
    return F.col("value").cast("decimal(10,2)").cast("string")


def prediction_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scorer responses as JSON text, one per event: damaged, normal, no label,
    empty list and broken text, chosen by event type."""
    ev = table(spark, sf_dir, "events")
    s = _score_text()
    body = (F.when(F.col("event_type") == "error",
                   F.concat(F.lit('{"predictions":[{"label":"damaged","score":'), s, F.lit("}]}")))
             .when(F.col("event_type") == "view",
                   F.concat(F.lit('{"predictions":[{"label":"normal","score":'), s, F.lit("}]}")))
             .when(F.col("event_type") == "click",
                   F.concat(F.lit('{"predictions":[{"score":'), s, F.lit("}]}")))
             .when(F.col("event_type") == "signup", F.lit('{"predictions":[]}'))
             .otherwise(F.concat(F.lit('{"predictions":[{"label":"damaged","score":'), s)))
    return ev.select(F.col("event_id").alias("item_id"), body.alias("response"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("file_id"), "url")


def image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file listing with image names in several letter cases and other files."""
    page = F.col("page_id") % 4
    name = (F.when(page == 0, "/part.jpg").when(page == 1, "/part.PNG").when(page == 2, "/part.JpeG")
             .otherwise("/part.png.txt"))
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("file_id"), F.concat("url", name).alias("url"))


def chat_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chat with some turns without text: missing, empty, only white space."""
    gap = (F.col("conv_id") + F.col("turn")) % 5
    text = (F.when(gap == 0, F.lit(None).cast("string")).when(gap == 1, "").when(gap == 2, " \t\n")
             .otherwise(F.col("text")))
    return chat(spark, sf_dir).withColumn("text", text)


# DuckDB definitions of the same views, for oracle_sql().
VIEW_SQL = {
    "inspection": """SELECT event_id AS item_id, ts, user_id AS unit_id, value AS score,
        CASE event_type WHEN 'view' THEN 'normal' WHEN 'error' THEN 'bent' WHEN 'click' THEN 'scratch'
             WHEN 'purchase' THEN 'melt,scratch' ELSE 'missing' END AS kind,
        CASE WHEN event_type = 'view' THEN 'normal' ELSE 'damaged' END AS label
      FROM events""",
    "production": "SELECT c_custkey AS unit_id, c_nationkey AS line FROM customer",
    "report": "SELECT doc_id, text, source, doc_id % 25 AS line FROM documents",
    "annotation": "SELECT * FROM labels",
    "chat": "SELECT * FROM conversations",
    "features": "SELECT vec_id, embedding, label, CAST(embedding[1] > 0 AS INTEGER) AS planted FROM embeddings",
    "runs": """SELECT event_id AS run_key,
        CASE WHEN event_type IN ('view', 'error') THEN 'EXPERIMENT' ELSE 'OTHER' END AS object_type,
        '/runs/' || event_type || '/automl_' || strftime(ts, '%Y-%m-%d_%H:%M:%S') AS path
      FROM events""",
    "prediction_json": """SELECT event_id AS item_id,
        CASE event_type
          WHEN 'error' THEN '{"predictions":[{"label":"damaged","score":' || CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) || '}]}'
          WHEN 'view' THEN '{"predictions":[{"label":"normal","score":' || CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) || '}]}'
          WHEN 'click' THEN '{"predictions":[{"score":' || CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) || '}]}'
          WHEN 'signup' THEN '{"predictions":[]}'
          ELSE '{"predictions":[{"label":"damaged","score":' || CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR)
        END AS response
      FROM events""",
    "files": "SELECT page_id AS file_id, url FROM pages",
    "image_files": """SELECT page_id AS file_id, url || CASE page_id % 4 WHEN 0 THEN '/part.jpg' WHEN 1 THEN '/part.PNG'
        WHEN 2 THEN '/part.JpeG' ELSE '/part.png.txt' END AS url FROM pages""",
    "chat_gaps": """SELECT conv_id, turn, role, CASE (conv_id + turn) % 5 WHEN 0 THEN NULL WHEN 1 THEN ''
        WHEN 2 THEN ' ' || chr(9) || chr(10) ELSE text END AS text FROM conversations""",
}


def with_views(names: list[str], body: str) -> str:
    """Prefix a DuckDB query with the named views as CTEs."""
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in names)
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{stripped[5:]}"
    return f"WITH {ctes}\n{body}"
