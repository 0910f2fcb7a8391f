from pyspark.sql import Window
from pyspark.sql import functions as F

from kensa.operators.numbering import dense_codes, number_rows


def test_numbers_match_window_on_skewed_groups(spark):
    # one conversation holds a third of all rows
    rows = [(0, t) for t in range(3000)] + [(c, t) for c in range(1, 601) for t in range(10)]
    df = spark.createDataFrame(rows, "conv long, turn long").repartition(7)
    got = number_rows(df, ["conv"], ["turn"], out="pos")
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("conv").orderBy("turn")))
    assert got.select("conv", "turn", "pos").exceptAll(want.select("conv", "turn", "pos")).count() == 0
    assert got.count() == len(rows)


def test_hot_group_is_spread_over_partitions(spark):
    rows = [(0, t) for t in range(4000)] + [(1, t) for t in range(10)]
    df = spark.createDataFrame(rows, "conv long, turn long")
    ranged = df.repartitionByRange(8, "conv", "turn")
    sizes = ranged.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in sizes) < 4000  # range cut splits the hot group


def test_ties_are_numbered_once_each(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 5, "c"), (2, 1, "x")], "g int, o int, v string")
    got = sorted((r.g, r.n) for r in number_rows(df, ["g"], ["o"], out="n").collect())
    assert got == [(1, 1), (1, 2), (1, 3), (2, 1)]


def test_global_numbering_without_groups(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "v").repartition(5)
    got = number_rows(df, [], ["v"], out="n")
    assert got.where(F.col("n") != F.col("v") + 1).count() == 0


def test_dense_codes_skip_nulls(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("c",)], "s string")
    assert {r.s: r.code for r in dense_codes(df, "s").collect()} == {"a": 0, "b": 1, "c": 2}


def test_empty_input(spark):
    df = spark.createDataFrame([], "g int, o int")
    assert number_rows(df, ["g"], ["o"]).count() == 0


def test_spread_only_fans_out_small_inputs(spark):
    from kensa.operators.partitioning import spread
    one = spark.range(0, 100, 1, 1)
    assert spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, spark.sparkContext.defaultParallelism + 2)
    assert spread(many) is many


def test_helpers_tolerate_sessions_without_context(spark, monkeypatch):
    """Spark Connect sessions have no SparkContext: the helpers fall back."""
    from kensa import session as ks
    from kensa.operators.partitioning import spread

    class NoContext:
        conf = spark.conf

        @property
        def sparkContext(self):
            raise RuntimeError("no context under Connect")

    assert ks._context(NoContext()) is None
    assert ks.ensure_checkpoint_dir(NoContext())
    ks.ship_package(NoContext())  # no error
    df = spark.range(5)
    monkeypatch.setattr(type(df), "rdd", property(lambda self: (_ for _ in ()).throw(RuntimeError("no rdd"))))
    assert spread(df) is df


def test_null_group_is_numbered_not_dropped(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), (1, 5), (1, 3)], "g int, o int")
    got = sorted((r.g if r.g is not None else -1, r.o, r.n) for r in number_rows(df, ["g"], ["o"], out="n").collect())
    assert got == [(-1, 1, 1), (-1, 2, 2), (1, 3, 1), (1, 5, 2)]


def test_map_columns_are_carried(spark):
    df = spark.createDataFrame([(1, 2, {"a": 1}), (1, 1, {"b": 2})], "g int, o int, m map<string,int>")
    got = sorted((r.o, r.n, dict(r.m)) for r in number_rows(df, ["g"], ["o"], out="n").collect())
    assert got == [(1, 1, {"b": 2}), (2, 2, {"a": 1})]


def test_dense_rank_small_and_large_paths_agree(spark):
    from kensa.operators.numbering import dense_rank_desc
    rows = [(i, (i * 7) % 13) for i in range(60)] + [(100, None)]
    df = spark.createDataFrame(rows, "k int, n int")
    small = {r.k: r.rank for r in dense_rank_desc(df, "n").collect()}
    large = {r.k: r.rank for r in dense_rank_desc(df, "n", max_bytes=20).collect()}
    assert small == large
    assert small[100] == 14 and min(small.values()) == 1


def test_dense_rank_is_the_same_at_every_size(spark):
    from kensa.operators.numbering import dense_rank_desc
    df = spark.createDataFrame([(1, float("nan")), (2, 2.0), (3, 1.0), (4, None), (5, 2.0)], "k int, n double")
    small = {r.k: r["rank"] for r in dense_rank_desc(df, "n").collect()}
    large = {r.k: r["rank"] for r in dense_rank_desc(df, "n", max_bytes=1).collect()}
    assert small == large == {1: 1, 2: 2, 5: 2, 3: 3, 4: 4}


def test_numbering_moves_rows_once_and_checkpoints_nothing(spark):
    df = spark.createDataFrame([(i % 3, i, "x" * 50) for i in range(300)], "g int, o int, t string")
    got = number_rows(df, ["g"], ["o"], out="n", num_partitions=6)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "Scan ExistingRDD" not in plan.replace("Scan ExistingRDD[", "", 1)
    # in order from partition to partition, without a sort behind it
    rows = [(r.g, r.o) for r in got.collect()]
    assert rows == sorted(rows) and got.rdd.getNumPartitions() == 6


def test_groups_over_many_borders_and_keys_that_fill_ranges(spark):
    rows = [(None, 1)] * 50 + [(1, None)] * 400 + [(2, 7)] * 500 + [(2, 8), (3, 1), (3, None)] + [(4, i) for i in range(700)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "g int, o int, _range int").repartition(5)
    for n in (1, 2, 7, 40):
        got = number_rows(df, ["g"], ["o"], out="n", num_partitions=n)
        want = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("o", F.xxhash64("g", "o", "_range"))).cast("long"))
        assert got.columns == ["g", "o", "_range", "n"]
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_numbering_of_other_types(spark):
    import datetime as dt
    rows = [(float(i % 4) if i % 5 else float("nan"), dt.datetime(2024, 1, 1, 0, 0, 0, i), f"k{i % 9}", bool(i % 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "d double, ts timestamp, s string, b boolean").repartition(3)
    got = number_rows(df, ["d", "b"], ["s", "ts"], out="n", num_partitions=9)
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("d", "b").orderBy("s", "ts")).cast("long"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_small_is_judged_by_bytes(spark):
    from kensa.operators.joins import checked_small, join_checked
    texts = spark.range(2000).selectExpr("id", "repeat('x', 1000) t", "array('a', null, repeat('y', 90)) a", "struct(id s, repeat('z', 50) u) n", "map('k', 'v') m")
    assert checked_small(texts, 2_600_000)[1] and not checked_small(texts, 2_000_000)[1]
    assert checked_small(texts.limit(0), 0)[1]
    keys = spark.range(50).selectExpr("id", "repeat('x', 100) t")
    for limit, how in ((10_000, "BroadcastHashJoin"), (5_000, "Join")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            j = join_checked(texts.select("id"), keys, "id", max_bytes=limit)
            plan = j._jdf.queryExecution().executedPlan().toString()
            assert (how in plan) and (("Broadcast" in plan) == (limit == 10_000)) and j.count() == 50
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
