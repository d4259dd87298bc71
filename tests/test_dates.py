import datetime as dt

import pytest
from pyspark.sql import functions as F

from lineforge.functions import date_key, parse_timestamp
from lineforge.operators import build_date_dimension, date_bounds, date_spine

FORMAT = "M/d/yyyy H:mm"


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "America/Sao_Paulo"])
def test_parse_is_independent_of_the_session_zone(spark, conf, zone):
    """Local times that daylight saving skips in some zone stay what the text says."""
    conf(spark__sql__session__timeZone=zone)
    texts = ["3/10/2019 2:30", "11/4/2018 0:15", "1/1/2018 0:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    parsed = df.select(parse_timestamp(F.col("t"), FORMAT).cast("string").alias("ts")).collect()
    assert [r.ts for r in parsed] == ["2019-03-10 02:30:00", "2018-11-04 00:15:00", "2018-01-01 00:00:00"]


@pytest.mark.parametrize("text", ["2018-01-31", "", "13/1/2018 1:00", "2/30/2018 1:00", "1/1/2018 24:01", None])
def test_unreadable_text_is_null(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_timestamp(F.col("t"), FORMAT)).first()[0] is None


def _days(spark, rows):
    return spark.createDataFrame(rows, "o date, s date")


def test_bounds_take_the_later_of_both_ends(spark):
    rows = [(dt.date(2020, 1, 3), dt.date(2020, 1, 9)), (dt.date(2020, 1, 5), None)]
    assert date_bounds(_days(spark, rows), ["o"], ["o", "s"]).first()[:] == (
        dt.date(2020, 1, 3), dt.date(2020, 1, 9),
    )


def test_spine_has_every_day_with_both_ends(spark):
    rows = [(dt.date(2019, 12, 30), dt.date(2020, 3, 1))]
    days = [r[0] for r in date_spine(date_bounds(_days(spark, rows), ["o"], ["s"])).collect()]
    assert sorted(days) == [dt.date(2019, 12, 30) + dt.timedelta(n) for n in range(63)]


def test_no_rows_make_an_empty_calendar(spark):
    empty = _days(spark, [])
    assert build_date_dimension(empty, ["o"], ["o", "s"]).count() == 0


def test_calendar_columns(spark):
    rows = [(dt.date(2020, 2, 28), dt.date(2020, 3, 1))]
    got = build_date_dimension(_days(spark, rows), ["o"], ["s"]).orderBy("full_date").collect()
    assert got[1][:] == (dt.date(2020, 2, 29), 20200229, 2020, 1, 2, "Saturday", True)
    assert [r.is_weekend for r in got] == [False, True, True]


def test_date_key(spark):
    df = spark.sql("SELECT DATE'2018-01-05' AS d")
    assert df.select(date_key(F.col("d"))).first()[0] == 20180105
