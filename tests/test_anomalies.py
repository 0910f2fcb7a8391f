from pyspark.sql import Row

from kensa.operators import anomalies as an

INSPECT = "item_id long, unit_id long, kind string, label string"


def test_verdict_missing_label_is_normal_and_flagged(spark):
    df = spark.createDataFrame([(1, "damaged"), (2, "normal"), (3, None), (4, "other")], "id int, label string")
    got = {r.id: (r.verdict, r.is_unknown) for r in an.verdict(df).collect()}
    assert got == {1: ("anomaly", False), 2: ("normal", False), 3: ("normal", True), 4: ("normal", False)}


def test_verdict_without_prediction_is_null(spark):
    df = spark.createDataFrame([(1, None, False), (2, "damaged", True)], "id int, label string, p boolean")
    got = {r.id: r.verdict for r in an.verdict(df, present="p").collect()}
    assert got == {1: None, 2: "anomaly"}


def test_share_counts_multi_kind_items(spark):
    df = spark.createDataFrame([(1, 1, "bent", "damaged"), (2, 1, "melt, bent", "damaged"),
                                (3, 2, "scratch", "damaged"), (4, 2, "normal", "normal")], INSPECT)
    r = an.anomaly_share(df, "bent").first()
    assert (r.n_kind, r.n_anomalies) == (2, 3)
    assert abs(r.share - 2 / 3) < 1e-12


def test_share_of_empty_input_is_null(spark):
    r = an.anomaly_share(spark.createDataFrame([], INSPECT), "bent").first()
    assert (r.n_kind, r.n_anomalies, r.share) == (0, 0, None)


def test_counts_explode_kinds(spark):
    df = spark.createDataFrame([(1, 1, "melt,scratch", "damaged"), (2, 1, "scratch", "damaged"),
                                (3, 1, "normal", "normal")], INSPECT)
    got = {r.kind: r.n for r in an.anomaly_counts(df).collect()}
    assert got == {"melt": 1, "scratch": 2}
    assert {r.kind for r in an.anomaly_counts(df, exclude=["melt"]).collect()} == {"scratch"}


def test_by_line_keeps_units_without_line(spark):
    insp = spark.createDataFrame([(1, 10, "bent", "damaged"), (2, 10, "bent", "damaged"),
                                  (3, 11, "bent", "damaged"), (4, 99, "bent", "damaged")], INSPECT)
    prod = spark.createDataFrame([(10, 4), (11, 4)], "unit_id long, line int")
    got = {(r.line, r.kind): (r.n_anomalies, r.n_units) for r in an.anomalies_by_line(insp, prod).collect()}
    assert got == {(4, "bent"): (3, 2), (None, "bent"): (1, 1)}


def test_hot_unit_is_reduced_before_the_join(spark):
    rows = [(i, 7, "bent", "damaged") for i in range(3000)] + [(5000 + i, i, "bent", "damaged") for i in range(6000)]
    insp = spark.createDataFrame(rows, INSPECT)
    prod = spark.createDataFrame([(i, i % 5) for i in range(6000)], "unit_id long, line int")
    out = an.anomalies_by_line(insp, prod)
    assert sum(r.n_anomalies for r in out.collect()) == 9000
    plan = out._jdf.queryExecution().executedPlan().toString()
    # partial aggregation below the join: the join never sees 3000 rows of unit 7
    assert "HashAggregate" in plan and "CartesianProduct" not in plan


def test_rank_lines_dense(spark):
    df = spark.createDataFrame([Row(line=1, kind="bent", n_anomalies=5, n_units=1),
                                Row(line=2, kind="bent", n_anomalies=5, n_units=1),
                                Row(line=3, kind="bent", n_anomalies=2, n_units=1),
                                Row(line=4, kind="melt", n_anomalies=9, n_units=1)])
    got = {r.line: r.rank for r in an.rank_lines(df, "bent").collect()}
    assert got == {1: 1, 2: 1, 3: 2}


def test_repeated_items_count_once_as_items(spark):
    insp = spark.createDataFrame([(1, 7, "bent", "damaged"), (1, 7, "bent", "damaged"), (2, 8, "bent, melt", "damaged")],
                                 "item_id long, unit_id long, kind string, label string")
    prod = spark.createDataFrame([(7, 1), (8, 1)], "unit_id long, line int")
    got = {(r.line, r.kind): (r.n_anomalies, r.n_items, r.n_units) for r in an.anomalies_by_line(insp, prod).collect()}
    assert got == {(1, "bent"): (3, 2, 2), (1, "melt"): (1, 1, 1)}


def test_an_item_under_several_units_of_a_line_counts_once(spark):
    rows = [(1, 7, "bent", "damaged"), (1, 8, "bent", "damaged"), (1, 9, "bent", "damaged"), (None, 7, "bent", "damaged"), (2, 99, "bent", "damaged"), (3, 98, "bent", "damaged")]
    insp = spark.createDataFrame(rows, "item_id long, unit_id long, kind string, label string")
    prod = spark.createDataFrame([(7, 1), (8, 1), (9, 2)], "unit_id long, line int")
    got = {r.line: (r.n_anomalies, r.n_items, r.n_units) for r in an.anomalies_by_line(insp, prod).collect()}
    assert got == {1: (3, 1, 2), 2: (1, 1, 1), None: (2, 2, 2)}
    assert "n_items" not in an.anomalies_by_line(insp, prod, distinct_items=False).columns
