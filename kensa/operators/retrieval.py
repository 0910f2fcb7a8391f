"""Most relevant report passages for a line and topic.

Reports are split into passages (their text lines); every passage of every
report is scored, whole.  Two scores:

* term form: number of tokens equal to one of the query terms, tokens being
  runs of Unicode letters, digits and ``_`` after lower-casing;
* embedding form: dot product of a vector column with a literal query
  vector -- a per-row expression, so no join and no pair-wise comparison.

Top-k per group uses ``row_number() <= k``; Spark plans a partial
``WindowGroupLimit`` before the shuffle, so each task sends at most k rows
per group however skewed the groups are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kensa.operators.partitioning import spread

TOKEN_SPLIT = r"[^\p{L}\p{N}_]+"


def passages(reports: DataFrame, text: str = "text", keep: tuple = ("doc_id", "line")) -> DataFrame:
    """One row per text line: ``keep..., passage_no (0-based), passage``."""
    return reports.select(*keep, F.posexplode(F.split(F.col(text), "\n")).alias("passage_no", "passage"))


def term_score(text: Column, terms: list[str]) -> Column:
    """Occurrences of the (lower-case) ``terms`` among the text's tokens."""
    wanted = [t.lower() for t in terms]
    tokens = F.split(F.lower(text), TOKEN_SPLIT)
    return F.size(F.filter(tokens, lambda w: w.isin(*wanted))).cast("bigint")


def dot_score(vec: Column, query: list[float]) -> Column:
    """Dot product with a literal query vector, summed left to right."""
    q = F.array(*[F.lit(float(x)) for x in query])
    prods = F.zip_with(vec.cast("array<double>"), q, lambda a, b: a * b)
    return F.aggregate(prods, F.lit(0.0), lambda acc, x: acc + x)


def top_k(df: DataFrame, score: str, k: int, by: list[str], tie: list[str]) -> DataFrame:
    """Rows with the ``k`` highest scores per ``by`` group (ties broken by
    ``tie`` ascending), with their ``rank``."""
    w = Window.partitionBy(*by).orderBy(F.desc(score), *[F.asc(c) for c in tie])
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_passages(reports: DataFrame, terms: list[str], k: int, by: list[str] = ("line",)) -> DataFrame:
    """T3, term form: the ``k`` best passages with at least one hit, per group."""
    by = list(by)
    p = passages(spread(reports), keep=("doc_id", *by))
    scored = p.withColumn("score", term_score(F.col("passage"), terms))
    # Zero scores sort last, so dropping them after the top-k gives the same
    # rows as before it -- and the tokens are computed once, not copied into
    # a pushed-down filter.
    return top_k(scored, "score", k, by, ["doc_id", "passage_no"]).where(F.col("score") > 0)


def top_vectors(df: DataFrame, vec: str, query: list[float], k: int, by: list[str],
                key: str) -> DataFrame:
    """T3, embedding form: the ``k`` rows nearest to ``query`` by dot product
    per group."""
    scored = df.withColumn("score", dot_score(F.col(vec), query))
    return top_k(scored, "score", k, list(by), [key])
