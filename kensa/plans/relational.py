"""Registered queries for filters, joins, runs, history and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from kensa.functions.scalar import RUN_STAMP_PATTERN, base_name
from kensa.functions.payloads import QUESTION_PREFIX, first_prediction, prompt
from kensa.operators import filters as fl
from kensa.operators import history as hi
from kensa.operators import joins as jn
from kensa.operators import metrics as me
from kensa.operators import runs as rn
from kensa.operators import splits as sp
from kensa.operators import anomalies as an
from kensa.plans import views as v
from kensa.plans.registry import register
from kensa.sources.tables import table

AS_OF = "2024-02-15 00:00:00"


def _labelled_reports(spark, sf_dir):
    return jn.label_images(v.report(spark, sf_dir), v.annotation(spark, sf_dir), "doc_id")


# ---- projections and filters -------------------------------------------------

@register("P1_select_training", v.with_views(["report", "annotation"], """
SELECT r.text AS content, a.quality AS label FROM report r LEFT JOIN annotation a ON r.doc_id = a.doc_id"""))
def p1(spark, sf_dir):
    return fl.select_training(_labelled_reports(spark, sf_dir), "text", "quality")


@register("P2_drop_columns", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def p2(spark, sf_dir):
    return fl.drop_columns(table(spark, sf_dir, "orders"), "o_orderdate", "no_such_column")


@register("P3_drop_datetime", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus FROM lineitem""")
def p3(spark, sf_dir):
    return fl.drop_datetime(table(spark, sf_dir, "lineitem"))


@register("P4_fill_zero", v.with_views(["report", "annotation"], """
SELECT r.doc_id, coalesce(a.quality, 0) AS quality, coalesce(a.toxic, 0) AS toxic
FROM report r LEFT JOIN annotation a ON r.doc_id = a.doc_id"""))
def p4(spark, sf_dir):
    df = _labelled_reports(spark, sf_dir).select("doc_id", "quality", "toxic")
    return fl.fill_zero(df)


@register("P5_take_split", v.with_views(["features"], f"""
SELECT vec_id, planted FROM features WHERE {sp.split_sql('vec_id')} = 'train'"""))
def p5(spark, sf_dir):
    df = sp.assign_split(v.features(spark, sf_dir), "vec_id")
    return fl.take_split(df, "train").select("vec_id", "planted")


@register("P6_filter_runs", v.with_views(["runs"], f"""
SELECT run_key, object_type, path FROM runs
WHERE object_type = 'EXPERIMENT' AND contains(path, 'automl') AND regexp_matches(path, '{RUN_STAMP_PATTERN}')"""))
def p6(spark, sf_dir):
    return rn.filter_runs(v.runs(spark, sf_dir), "EXPERIMENT")


@register("P7_prefix_filter", "SELECT p_partkey, p_name FROM part WHERE p_name IS NOT NULL AND starts_with(p_name, 'red')")
def p7(spark, sf_dir):
    return fl.prefix_filter(table(spark, sf_dir, "part"), "p_name", "red").select("p_partkey", "p_name")


@register("P8_non_blank", v.with_views(["chat_gaps"], r"""
SELECT conv_id, turn, role FROM chat_gaps WHERE text IS NOT NULL AND regexp_matches(text, '\S')"""))
def p8(spark, sf_dir):
    return fl.non_blank(v.chat_gaps(spark, sf_dir), "text").select("conv_id", "turn", "role")


_FIRST_PRED_SQL = """
SELECT item_id, response,
       CASE WHEN json_valid(response)
            THEN from_json(response, '{"predictions":[{"label":"VARCHAR","score":"DOUBLE"}]}').predictions[1]
       END AS p
FROM prediction_json"""


@register("P10_first_prediction", v.with_views(["prediction_json"], f"""
SELECT item_id, p.label AS label, p.score AS score,
       CASE WHEN p IS NOT NULL THEN CASE WHEN coalesce(p.label, 'unknown') = 'damaged' THEN 'anomaly' ELSE 'normal' END END AS verdict,
       CASE WHEN p IS NOT NULL THEN p.label IS NULL END AS is_unknown
FROM ({_FIRST_PRED_SQL})"""))
def p10(spark, sf_dir):
    df = first_prediction(v.prediction_json(spark, sf_dir))
    df = df.select("item_id", F.col("prediction.label").alias("label"),
                   F.col("prediction.score").alias("score"),
                   F.col("prediction").isNotNull().alias("_present"))
    return an.verdict(df, "label", present="_present").drop("_present")


@register("P11_default_prediction", v.with_views(["prediction_json"], f"""
SELECT item_id, CASE WHEN p IS NULL THEN 'normal' ELSE p.label END AS label,
       CASE WHEN p IS NULL THEN 0.85 ELSE p.score END AS score, p IS NULL AS is_default
FROM ({_FIRST_PRED_SQL})"""))
def p11(spark, sf_dir):
    df = fl.with_default_prediction(first_prediction(v.prediction_json(spark, sf_dir)))
    return df.select("item_id", F.col("prediction.label").alias("label"),
                     F.col("prediction.score").alias("score"), "is_default")


@register("P12_check_names", "SELECT c_custkey, c_name FROM customer")
def p12(spark, sf_dir):
    # A reserved-name guard over a column that grows with the data.
    return fl.check_names(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_name")


@register("P12_reserved_names", """
SELECT c_custkey, c_mktsegment, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'reserved name: ' || c_mktsegment END AS error
FROM customer""")
def p12_flagged(spark, sf_dir):
    # Market segments as names, two of them reserved: rows with and without an error.
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return fl.flag_names(df, "c_mktsegment", reserved=("BUILDING", "MACHINERY"))


@register("S4_filter_image_files", v.with_views(["image_files"], r"""
SELECT file_id, url FROM image_files WHERE regexp_matches(url, '\.(jpe?g|png)$', 'i')"""))
def s4(spark, sf_dir):
    return fl.filter_image_files(v.image_files(spark, sf_dir), "url")


@register("S5_filter_manifest", v.with_views(["files"], """
SELECT url FROM files WHERE NOT contains(string_split(url, '/')[-1], 'ref=x')"""))
def s5(spark, sf_dir):
    df = v.files(spark, sf_dir).withColumn("name", base_name("url"))
    return fl.filter_manifest(df, "name", "url", exclude="ref=x")


# ---- joins ------------------------------------------------------------------

@register("J1_label_images", v.with_views(["report", "annotation"], """
SELECT r.doc_id, r.line, a.quality, a.toxic FROM report r LEFT JOIN annotation a ON r.doc_id = a.doc_id"""))
def j1(spark, sf_dir):
    return _labelled_reports(spark, sf_dir).select("doc_id", "line", "quality", "toxic")


@register("J2_with_line", v.with_views(["inspection", "production"], """
SELECT i.item_id, i.kind, p.line FROM inspection i LEFT JOIN production p ON i.unit_id = p.unit_id
WHERE i.label = 'damaged'"""))
def j2(spark, sf_dir):
    return an.with_line(v.inspection(spark, sf_dir), v.production(spark, sf_dir)).select("item_id", "kind", "line")


@register("J3_reports_for", v.with_views(["inspection", "production", "report"], """
WITH by_line AS (
  SELECT p.line, count(*) AS n FROM inspection i LEFT JOIN production p ON i.unit_id = p.unit_id
  WHERE i.label = 'damaged' AND list_contains(string_split(i.kind, ','), 'bent') GROUP BY p.line),
top AS (SELECT line FROM by_line WHERE n = (SELECT max(n) FROM by_line))
SELECT doc_id, line, source FROM report WHERE line IN (SELECT line FROM top)"""))
def j3(spark, sf_dir):
    by_line = an.anomalies_by_line(v.inspection(spark, sf_dir), v.production(spark, sf_dir), kind="bent", distinct_items=False)
    top = an.rank_lines(by_line, "bent").where(F.col("rank") == 1)
    return jn.reports_for(top, v.report(spark, sf_dir)).select("doc_id", "line", "source")


@register("J4_unmatched", v.with_views(["report", "annotation"], """
SELECT doc_id, 'annotation' AS missing_in FROM report WHERE doc_id NOT IN (SELECT doc_id FROM annotation)
UNION ALL
SELECT doc_id, 'report' AS missing_in FROM annotation WHERE doc_id NOT IN (SELECT doc_id FROM report)"""))
def j4(spark, sf_dir):
    return jn.unmatched(v.report(spark, sf_dir), v.annotation(spark, sf_dir), "doc_id",
                        left_name="report", right_name="annotation")


@register("S7_prefer_source", v.with_views(["report", "annotation"], """
SELECT r.doc_id, CASE WHEN a.doc_id IS NOT NULL THEN 'mirror:' || r.text ELSE r.text END AS content,
       CASE WHEN a.doc_id IS NOT NULL THEN 'mirror' ELSE 'origin' END AS source
FROM report r LEFT JOIN annotation a ON r.doc_id = a.doc_id"""))
def s7(spark, sf_dir):
    reports = v.report(spark, sf_dir)
    manifest = reports.select("doc_id")
    mirror = reports.join(v.annotation(spark, sf_dir).select("doc_id"), "doc_id", "left_semi") \
                    .select("doc_id", F.concat(F.lit("mirror:"), "text").alias("content"))
    origin = reports.select("doc_id", F.col("text").alias("content"))
    return jn.prefer_source(manifest, mirror, origin, "doc_id")


# ---- runs -------------------------------------------------------------------

@register("T1_latest_run", v.with_views(["runs"], f"""
SELECT run_key, object_type, path FROM runs
WHERE object_type = 'EXPERIMENT' AND contains(path, 'automl') AND regexp_matches(path, '{RUN_STAMP_PATTERN}')
ORDER BY path DESC, run_key LIMIT 1"""))
def t1(spark, sf_dir):
    return rn.latest_run(rn.filter_runs(v.runs(spark, sf_dir), "EXPERIMENT"))


@register("T2_staleness", v.with_views(["runs"], f"""
SELECT run_key, path, ts AS run_ts,
       CAST(floor(date_diff('microsecond', ts, TIMESTAMP '{AS_OF}') / 86400000000.0) AS BIGINT) AS days,
       floor(date_diff('microsecond', ts, TIMESTAMP '{AS_OF}') / 86400000000.0) > 30 AS is_stale
FROM (SELECT run_key, path, try_strptime(regexp_extract(path, '{RUN_STAMP_PATTERN}', 1), '%Y-%m-%d_%H:%M:%S') AS ts
      FROM runs WHERE object_type = 'EXPERIMENT' AND contains(path, 'automl')
        AND regexp_matches(path, '{RUN_STAMP_PATTERN}'))"""))
def t2(spark, sf_dir):
    df = rn.filter_runs(v.runs(spark, sf_dir), "EXPERIMENT").select("run_key", "path")
    return rn.staleness(df, AS_OF, 30)


# ---- ranking and history ----------------------------------------------------

@register("T4_transcript", v.with_views(["chat"], """
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS position,
       CASE WHEN role = 'user' THEN 'user' ELSE 'assistant' END AS role, text
FROM chat"""))
def t4(spark, sf_dir):
    return hi.transcript(v.chat(spark, sf_dir))


@register("T6_sample_input", v.with_views(["features"], """
SELECT vec_id, label, planted FROM features ORDER BY vec_id LIMIT 1"""))
def t6(spark, sf_dir):
    return hi.sample_input(v.features(spark, sf_dir).select("vec_id", "label", "planted"), "vec_id")


@register("T7_number_turns", v.with_views(["chat"], """
SELECT conv_id, turn, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS position FROM chat"""))
def t7(spark, sf_dir):
    return hi.number_turns(v.chat(spark, sf_dir).select("conv_id", "turn"))


@register("U1_append_turns", v.with_views(["chat"], f"""
SELECT conv_id, turn, role, text FROM chat
UNION ALL
SELECT conv_id, max(turn) + 1 AS turn, 'user' AS role, '{QUESTION_PREFIX}' || arg_min(text, turn) AS text
FROM chat GROUP BY conv_id"""))
def u1(spark, sf_dir):
    history = v.chat(spark, sf_dir)
    new = hi.next_turns(history, "user", prompt("first_text"))
    return hi.append_turns(history, new)


@register("U3_normalise_role", v.with_views(["chat"], """
SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'user' ELSE 'assistant' END AS role FROM chat"""))
def u3(spark, sf_dir):
    return hi.normalise_role(v.chat(spark, sf_dir).select("conv_id", "turn", "role"))


# ---- metrics ----------------------------------------------------------------

@register("A4_is_empty", """
SELECT 'all' AS part, count(*) = 0 AS is_empty FROM conversations
UNION ALL SELECT 'before the first turn' AS part, count(*) = 0 AS is_empty FROM conversations WHERE turn < 0""")
def a4(spark, sf_dir):
    chat = table(spark, sf_dir, "conversations")
    return me.emptiness(chat).select(F.lit("all").alias("part"), "is_empty").unionByName(
        me.emptiness(chat.where("turn < 0")).select(F.lit("before the first turn").alias("part"), "is_empty"))


_F1_SQL = """
WITH d AS (SELECT quality AS label, 1 - toxic AS pred FROM annotation),
cm AS (SELECT label, pred, count(*) AS n FROM d GROUP BY label, pred),
bl AS (SELECT label AS cls, sum(n) AS support, sum(CASE WHEN label = pred THEN n ELSE 0 END) AS tp FROM cm GROUP BY label),
bp AS (SELECT pred AS cls, sum(n) AS predicted FROM cm GROUP BY pred),
j AS (SELECT coalesce(bl.support, 0) AS support, coalesce(bl.tp, 0) AS tp, coalesce(bp.predicted, 0) AS predicted
      FROM bl FULL OUTER JOIN bp ON bl.cls = bp.cls),
pr AS (SELECT support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS p,
              CASE WHEN support > 0 THEN tp / support ELSE 0 END AS r FROM j)
SELECT round(sum(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END * support) / sum(support), 9) AS f1 FROM pr"""


@register("A6_weighted_f1", v.with_views(["annotation"], _F1_SQL))
def a6(spark, sf_dir):
    d = v.annotation(spark, sf_dir).select(F.col("quality").alias("label"),
                                           (1 - F.col("toxic")).alias("pred"))
    return me.weighted_f1(d, "label", "pred").select(F.round("f1", 9).alias("f1"))


@register("A8_split_counts", v.with_views(["features"], f"""
SELECT {sp.split_sql('vec_id')} AS split, count(*) AS n FROM features GROUP BY 1"""))
def a8(spark, sf_dir):
    return me.split_counts(sp.assign_split(v.features(spark, sf_dir), "vec_id"))


@register("M1_assign_split", v.with_views(["features"], f"""
SELECT vec_id, {sp.split_sql('vec_id')} AS split FROM features"""))
def m1(spark, sf_dir):
    return sp.assign_split(v.features(spark, sf_dir), "vec_id").select("vec_id", "split")


@register("M2_holdout", v.with_views(["features"], f"""
SELECT vec_id, {sp.split_sql('vec_id', (('train', 0.9), ('test', 0.1)))} AS split FROM features"""))
def m2(spark, sf_dir):
    return sp.holdout(v.features(spark, sf_dir), "vec_id", 0.1).select("vec_id", "split")
