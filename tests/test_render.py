"""Text renderings: exact lines of the job's output formats."""

from pyspark.sql import functions as F

from fleetreports.functions import render
from fleetreports.plans import queries as q
from fleetreports.sources import make_reports

TS = 1700000000123  # 2023-11-14 22:13:20.123 UTC, a Tuesday


def lines(df):
    return [r.value for r in df.collect()]


def test_report_line(spark):
    df = make_reports(spark, [("1", 1, 1e7, 1, "L1", 0, 0, TS)])
    assert lines(render(df, "report")) == [
        "Vehicle{id='1', vtype=1, ltype=1, lat=0.0, lng=0.0, bearing=1.0E7, lineid=1, linename='L1', "
        "routeid=0, course='', lf='', delay=0.0, laststopid=0, finalstopid=-1, isinactive='false', "
        "lastupdate=Tue Nov 14 22:13:20 UTC 2023'}"
    ]


def test_train_and_top_lines(spark):
    df = make_reports(spark, [("7", 5, 0.0, 3, "L3", 12, 44, TS)])
    assert lines(render(q.trains_last_stop(df), "train")) == [
        "trainID:7 trainName:L3 last stop:44 last update:Tue Nov 14 22:13:20 UTC 2023"
    ]
    assert lines(render(q.top_delayed(df), "top")) == ["ID:7 name:L3 delay:12.0 last update:Tue Nov 14 22:13:20 UTC 2023"]


def test_average_and_gap_lines(spark):
    avg = spark.createDataFrame([(38.166666666666664,), (1e-4,)], "avg_delay double")
    assert lines(render(avg, "average")) == ["Average delay:38.166666666666664", "Average delay:1.0E-4"]
    gap = spark.createDataFrame([("2", 0.9166666666666666)], "id string, avg_gap_s double")
    assert lines(render(gap, "gap")) == ["ID: 2 Average: 0.9166666666666666"]


def test_unknown_rendering_is_an_error(spark):
    import pytest

    with pytest.raises(ValueError):
        render(spark.range(1).select(F.lit(1).alias("x")), "nope")
