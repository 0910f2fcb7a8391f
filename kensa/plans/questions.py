"""The analyst questions: anomaly shares, kinds, lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from kensa.operators import anomalies as an
from kensa.operators import joins as jn
from kensa.plans import views as v
from kensa.plans.registry import register


@register("A1_anomaly_share", v.with_views(["inspection"], """
SELECT 'bent' AS kind,
       CAST(count(*) FILTER (WHERE list_contains(list_transform(string_split(kind, ','), lambda k: trim(k)), 'bent')) AS BIGINT) AS n_kind,
       CAST(count(*) AS BIGINT) AS n_anomalies,
       CAST(count(*) FILTER (WHERE list_contains(list_transform(string_split(kind, ','), lambda k: trim(k)), 'bent')) AS DOUBLE)
             / nullif(count(*), 0) AS share
FROM inspection WHERE label = 'damaged'"""))
def a1(spark, sf_dir):
    return an.anomaly_share(v.inspection(spark, sf_dir), "bent")


@register("A2_anomaly_counts", v.with_views(["inspection"], """
SELECT k AS kind, CAST(count(*) AS BIGINT) AS n
FROM (SELECT trim(unnest(string_split(kind, ','))) AS k FROM inspection WHERE label = 'damaged')
WHERE k <> 'bent' GROUP BY k"""))
def a2(spark, sf_dir):
    """The kinds other than bent."""
    return an.anomaly_counts(v.inspection(spark, sf_dir), exclude=["bent"])


_BY_LINE_SQL = """
SELECT p.line, a.kind, count(*) AS n_anomalies, count(DISTINCT a.item_id) AS n_items,
       CAST(count(DISTINCT coalesce(a.unit_id, -1)) AS BIGINT) AS n_units
FROM (SELECT item_id, unit_id, trim(unnest(string_split(kind, ','))) AS kind FROM inspection WHERE label = 'damaged') a
LEFT JOIN production p ON a.unit_id = p.unit_id
GROUP BY p.line, a.kind"""


@register("A3_anomalies_by_line", v.with_views(["inspection", "production"], _BY_LINE_SQL))
def a3(spark, sf_dir):
    return an.anomalies_by_line(v.inspection(spark, sf_dir), v.production(spark, sf_dir))


# Three inspections in a row are of one item, so an item may stand under several units of a line.
@register("A3_items_of_several_units", v.with_views(["inspection", "production"], f"""
{_BY_LINE_SQL}""".replace("FROM inspection", "FROM (SELECT * REPLACE (item_id // 3 AS item_id) FROM inspection)")))
def a3_shared(spark, sf_dir):
    shared = v.inspection(spark, sf_dir).withColumn("item_id", F.floor(F.col("item_id") / 3))
    return an.anomalies_by_line(shared, v.production(spark, sf_dir))


@register("T5_rank_lines", v.with_views(["inspection", "production"], f"""
SELECT line, kind, n_anomalies, n_units, CAST(dense_rank() OVER (ORDER BY n_anomalies DESC) AS INTEGER) AS rank
FROM ({_BY_LINE_SQL}) WHERE kind = 'bent'"""))
def t5(spark, sf_dir):
    by_line = an.anomalies_by_line(v.inspection(spark, sf_dir), v.production(spark, sf_dir), kind="bent", distinct_items=False)
    return an.rank_lines(by_line, "bent")


@register("P9_verdict", v.with_views(["inspection"], """
SELECT item_id, label, CASE WHEN coalesce(label, 'unknown') = 'damaged' THEN 'anomaly' ELSE 'normal' END AS verdict,
       label IS NULL AS is_unknown
FROM inspection"""))
def p9(spark, sf_dir):
    return an.verdict(v.inspection(spark, sf_dir).select("item_id", "label"))


def flagship(spark, sf_dir):
    """Which lines made the bent items, ranked (answers the first three questions)."""
    return t5(spark, sf_dir)


# ---- T3: report passages for the lines -----------------------------------------

from kensa.operators import retrieval as rt  # noqa: E402

# Query terms for the maintenance question (the report texts are invented, so
# common words stand in for the topic).
TOPIC_TERMS = ["the", "bent", "line"]
TOP_K = 5
# A fixed query vector: +1/8 and -1/8 alternating (exact in binary).
QUERY_VECTOR = [0.125 if i % 2 == 0 else -0.125 for i in range(64)]


@register("T3_top_passages", v.with_views(["report"], r"""
SELECT line, doc_id, CAST(passage_no AS INTEGER) AS passage_no, passage, score, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY line ORDER BY score DESC, doc_id, passage_no) AS rank
      FROM (SELECT line, doc_id, passage_no, passage,
                   CAST(len(list_filter(string_split_regex(lower(passage), '[^\p{L}\p{N}_]+'),
                                        lambda w: w IN ('the', 'bent', 'line'))) AS BIGINT) AS score
            FROM (SELECT doc_id, line, unnest(string_split(text, chr(10))) AS passage,
                         unnest(range(len(string_split(text, chr(10))))) AS passage_no FROM report))
      WHERE score > 0)
WHERE rank <= 5"""))
def t3(spark, sf_dir):
    return rt.top_passages(v.report(spark, sf_dir), TOPIC_TERMS, TOP_K)


# Invented words that some reports hold and most do not.
WORST_TERMS = ["oning", "thing", "erble"]


@register("J3_T3_worst_line_passages", v.with_views(["inspection", "production", "report"], rf"""
WITH by_line AS ({_BY_LINE_SQL}),
worst AS (SELECT line FROM by_line WHERE kind = 'bent'
          AND n_anomalies = (SELECT max(n_anomalies) FROM by_line WHERE kind = 'bent')),
passages AS (SELECT doc_id, line, unnest(string_split(text, chr(10))) AS passage,
                    unnest(range(len(string_split(text, chr(10))))) AS passage_no
             FROM report WHERE line IN (SELECT line FROM worst)),
scored AS (SELECT *, CAST(len(list_filter(string_split_regex(lower(passage), '[^\p{{L}}\p{{N}}_]+'),
                                          lambda w: w IN ('oning', 'thing', 'erble'))) AS BIGINT) AS score FROM passages)
SELECT line, doc_id, CAST(passage_no AS INTEGER) AS passage_no, passage, score, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY line ORDER BY score DESC, doc_id, passage_no) AS rank
      FROM scored WHERE score > 0)
WHERE rank <= 5"""))
def worst_line_passages(spark, sf_dir):
    """Why one line has so many bent items: the worst line, its reports, their best passages."""
    by_line = an.anomalies_by_line(v.inspection(spark, sf_dir), v.production(spark, sf_dir), kind="bent", distinct_items=False)
    worst = an.rank_lines(by_line, "bent").where(F.col("rank") == 1)
    return rt.top_passages(jn.reports_for(worst, v.report(spark, sf_dir)), WORST_TERMS, TOP_K)


_QVEC_SQL = "[" + ", ".join(repr(x) for x in QUERY_VECTOR) + "]"


@register("T3_top_vectors", v.with_views(["features"], f"""
SELECT vec_id, planted, score, CAST(rank AS INTEGER) AS rank
FROM (SELECT vec_id, planted, score, row_number() OVER (PARTITION BY planted ORDER BY score DESC, vec_id) AS rank
      FROM (SELECT vec_id, planted,
                   list_reduce(list_transform(range(1, 65), lambda i: CAST(embedding[i] AS DOUBLE) * ({_QVEC_SQL})[i]),
                               lambda a, b: a + b) AS score
            FROM features))
WHERE rank <= {TOP_K}"""))
def t3v(spark, sf_dir):
    df = v.features(spark, sf_dir).select("vec_id", "planted", "embedding")
    return rt.top_vectors(df, "embedding", QUERY_VECTOR, TOP_K, ["planted"], "vec_id").drop("embedding")
