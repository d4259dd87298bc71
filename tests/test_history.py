import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import same_rows
from lineforge.operators import (
    current_versions,
    former_versions,
    scd2_simulated,
    scd2_versions,
    temporal_join,
)
from lineforge.operators.history import mark_changed
from lineforge.settings import History

HISTORY = History(base_value="BUILDING", floor="1990-01-01", cutoff="1998-06-01")
SEGMENT = "customer_segment"


@pytest.fixture
def customers(spark):
    rows = [
        (20, "HOUSEHOLD", "a"), (21, "HOUSEHOLD", "b"), (40, "BUILDING", "c"), (60, None, "d"),
        (None, "HOUSEHOLD", "e"),
    ]
    return spark.createDataFrame(rows, "customer_id long, customer_segment string, name string")


@pytest.fixture
def dimension(customers):
    return scd2_simulated(customers, "customer_id", SEGMENT, HISTORY, "customer_key")


def test_only_the_changed_customer_has_two_versions(dimension):
    rows = [r[:] for r in dimension.filter("customer_id = 20").orderBy("start_date").collect()]
    day = dt.date
    assert rows == [
        (20, "BUILDING", "a", day(1990, 1, 1), day(1998, 5, 31), False, 2),
        (20, "HOUSEHOLD", "a", day(1998, 6, 1), day(9999, 12, 31), True, 3),
    ]
    assert dimension.count() == 6
    assert dimension.filter("is_current").count() == 5


def test_unknown_counts_as_not_changed(customers):
    marked = mark_changed(customers, "customer_id", SEGMENT, HISTORY)
    flags = {r.name: r.is_changed for r in marked.collect()}
    assert flags == {"a": True, "b": False, "c": False, "d": None, "e": None}
    floor = dt.date(1990, 1, 1)
    current = current_versions(marked, SEGMENT, HISTORY)
    assert {r.name for r in current.collect() if r.start_date == floor} == {"b", "c", "d", "e"}
    assert [r.name for r in former_versions(marked, SEGMENT, HISTORY).collect()] == ["a"]


def test_one_pass_equals_the_union_of_both_kinds(customers, lake):
    latest = lake.gold("dim_customer").filter("is_current").select("customer_id", SEGMENT)
    for base in (customers, latest):
        marked = mark_changed(base, "customer_id", SEGMENT, HISTORY)
        union = current_versions(marked, SEGMENT, HISTORY).unionByName(
            former_versions(marked, SEGMENT, HISTORY)
        )
        assert same_rows(scd2_versions(marked, SEGMENT, HISTORY), union)


@pytest.mark.parametrize("dim_rows", [None, 0, 10**9])
def test_boundary_days(spark, dimension, dim_rows):
    orders = [
        (1, 20, "1998-05-31", "BUILDING"),
        (2, 20, "1998-06-01", "HOUSEHOLD"),
        (3, 20, "1989-12-31", None),
        (4, 20, "1990-01-01", "BUILDING"),
        (5, 20, "9999-12-31", "HOUSEHOLD"),
        (6, 20, None, None),
        (7, 21, "1998-05-31", "HOUSEHOLD"),
        (8, 40, "1990-01-01", "BUILDING"),
        (9, 99, "1998-06-01", None),
        (10, None, "1998-06-01", None),
    ]
    schema = "line int, customer_id long, day string, expected string"
    lines = spark.createDataFrame(orders, schema).withColumn("day", F.to_date("day"))
    joined = temporal_join(
        lines, dimension, "customer_id", "day", "start_date", "end_date",
        take={SEGMENT: "valid"}, dim_rows=dim_rows,
    )
    assert joined.columns == [*lines.columns, "valid"]
    rows = joined.collect()
    assert len(rows) == len(orders)
    assert all(r.valid == r.expected for r in rows)


def test_inner_form_drops_lines_without_a_version(spark, dimension):
    lines = spark.createDataFrame([(20, dt.date(1980, 1, 1)), (21, dt.date(2000, 1, 1))], "customer_id long, day date")
    joined = temporal_join(
        lines, dimension, "customer_id", "day", "start_date", "end_date", ["customer_key"], how="inner"
    )
    assert [r.customer_id for r in joined.collect()] == [21]
