import datetime as dt

import pytest

from kensa.functions.scalar import parse_stamp, run_stamp
from kensa.operators import runs as rn

RUNS = "run_key long, object_type string, path string"


def test_filter_and_latest_by_path_text(spark):
    df = spark.createDataFrame([
        (1, "EXPERIMENT", "/x/b/automl_2024-01-01_00:00:00"),
        (2, "EXPERIMENT", "/x/a/automl_2024-03-01_00:00:00"),   # later time, smaller path
        (3, "OTHER", "/x/z/automl_2025-01-01_00:00:00"),
        (4, "EXPERIMENT", "/x/zz/automl_no_stamp"),
        (5, "EXPERIMENT", "/x/zzz/run_2024-05-01_00:00:00"),  # no 'automl'
    ], RUNS)
    f = rn.filter_runs(df, "EXPERIMENT")
    assert sorted(r.run_key for r in f.collect()) == [1, 2]
    assert rn.latest_run(f).first().run_key == 1
    assert rn.require_latest_run(f)["run_key"] == 1
    with pytest.raises(LookupError):
        rn.require_latest_run(f.limit(0))


def test_staleness_floors_whole_days(spark):
    df = spark.createDataFrame([
        (1, "E", "/automl_2024-02-14_00:00:01"),   # 23:59:59 before -> 0 days
        (2, "E", "/automl_2024-01-15_00:00:00"),   # 31 days -> stale
        (3, "E", "/automl_2024-02-15_12:00:00"),   # half a day after -> -1 (floor)
        (4, "E", "/automl_2024-13-45_00:00:00"),   # impossible date -> null
    ], RUNS)
    got = {r.run_key: (r.days, r.is_stale) for r in rn.staleness(df, "2024-02-15 00:00:00").collect()}
    as_of = dt.datetime(2024, 2, 15)
    assert got[1] == ((as_of - dt.datetime(2024, 2, 14, 0, 0, 1)).days, False)
    assert got[2] == (31, True)
    assert got[3] == ((as_of - dt.datetime(2024, 2, 15, 12)).days, False)
    assert got[4] == (None, None)
    with pytest.raises(RuntimeError):
        rn.require_fresh({"days": 31, "path": "p"})


def test_stamp_extract_and_parse(spark):
    df = spark.createDataFrame([("a/automl_2024-01-02_03:04:05/x",), ("none",)], "path string")
    rows = df.select(run_stamp("path").alias("s"), parse_stamp(run_stamp("path")).alias("t")).collect()
    assert rows[0].s == "2024-01-02_03:04:05" and rows[0].t == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert rows[1].s == "" and rows[1].t is None
