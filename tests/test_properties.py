"""Randomised properties: skew-safe numbering equals Spark's window numbering;
splits are complete and disjoint."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from kensa.operators import splits as sp
from kensa.operators.numbering import number_rows

rows_strategy = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 50)), min_size=0, max_size=300, unique=True)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_strategy, parts=st.integers(1, 6))
def test_numbering_equals_window(spark, rows, parts):
    df = spark.createDataFrame(rows, "g int, o int").repartition(parts)
    got = number_rows(df, ["g"], ["o"], out="n", num_partitions=parts + 1)
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    assert sorted(map(tuple, got.select("g", "o", "n").collect())) == sorted(map(tuple, want.collect()))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(n=st.integers(0, 3000), seed=st.integers(0, 1000), test=st.floats(0.05, 0.5))
def test_holdout_complete_and_disjoint(spark, n, seed, test):
    df = spark.range(0, n).withColumnRenamed("id", "k")
    out = sp.holdout(df, "k", test, seed)
    counts = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert sum(counts.values()) == n and set(counts) <= {"train", "test"}
    assert out.select("k").distinct().count() == n
