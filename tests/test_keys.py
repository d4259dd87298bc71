import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from conftest import same_rows
from lineforge.operators import build_dimension, dense_key, first_per_key, key_report, latest_per_key


def _numbered_globally(df, order, key):
    return df.withColumn(key, F.row_number().over(W.orderBy(*order)))


@pytest.fixture
def places(spark):
    rng = random.Random(3)
    rows = {
        (rng.choice([None, "A", "B", "B", "B"]), rng.choice([None, "x", "y"]), rng.randrange(400))
        for _ in range(1500)
    }
    return spark.createDataFrame(sorted(rows, key=str), "m string, r string, n int").repartition(7)


def test_dense_key_equals_the_global_numbering(spark, conf, places):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    keyed = dense_key(places, ["m", "r", "n"], "k")
    assert same_rows(keyed, _numbered_globally(places, ["m", "r", "n"], "k"))
    assert dict(keyed.dtypes)["k"] == "int"


def test_dense_key_orders_several_ranges(spark, conf):
    conf(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="5")
    df = spark.range(2000).withColumn("hot", F.lit("same")).repartition(6)
    keyed = dense_key(df, ["hot", "id"], "k")
    assert len(keyed.inputFiles()) > 1
    assert keyed.filter(F.col("k") != F.col("id") + 1).isEmpty()


def test_dense_key_of_nothing(spark):
    assert dense_key(spark.range(0), ["id"], "k").count() == 0


def test_dense_key_has_no_global_window(places):
    """One row per written range is all that meets in one partition."""
    plan = dense_key(places, ["m", "r", "n"], "k")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 1 and "_rows" in windows[0]


def test_key_report_accepts_right_keys_and_counts_wrong_ones(spark, places):
    order = ["m", "r", "n"]
    keyed = _numbered_globally(places, order, "k")
    total = places.count()
    assert key_report(keyed, order, "k").first()[:] == (total, 0)
    swapped = keyed.withColumn("k", F.when(F.col("k") < 3, 3 - F.col("k")).otherwise(F.col("k")))
    assert key_report(swapped, order, "k").first().difference_rows > 0
    gap = keyed.withColumn("k", F.when(F.col("k") > 10, F.col("k") + 1).otherwise(F.col("k")))
    assert key_report(gap, order, "k").first().difference_rows > 0
    late = keyed.withColumn("k", F.col("k") + 1)
    assert key_report(late, order, "k").first().difference_rows > 0


@pytest.fixture
def copies(spark):
    rng = random.Random(5)
    rows = [
        (rng.choice([1, 1, 1, 2, 3, 4]), rng.choice([None, 1, 2]), rng.choice(["p", "q", None]), i % 3)
        for i in range(500)
    ]
    return spark.createDataFrame(rows, "k int, a int, b string, c int")


def test_first_per_key_by_order_then_by_the_rest(copies):
    expected = (
        copies.withColumn("n", F.row_number().over(W.partitionBy("k").orderBy("a", "b", "c")))
        .filter("n = 1")
        .drop("n")
    )
    got = first_per_key(copies, ["k"], ["a"])
    assert got.columns == copies.columns and same_rows(got, expected)


def test_first_per_key_does_not_depend_on_row_order(copies):
    answers = {
        tuple(sorted(map(str, first_per_key(copies.repartition(n, "c"), ["k"]).collect())))
        for n in (1, 3, 7)
    }
    assert len(answers) == 1


def test_first_per_key_reduces_before_the_shuffle(copies):
    """Whole rows are compared for repeated keys only, and first within a map task."""
    plan = first_per_key(copies, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("[min(") < plan.index("Exchange hashpartitioning") < plan.index("partial_min") < plan.index("LeftSemi")


def test_latest_per_key_puts_null_last_and_breaks_ties(spark):
    rows = [
        (1, None, 1, "no"), (1, 5, 9, "no"), (1, 5, 2, "yes"), (1, 4, 1, "no"),
        (2, None, 8, "no"), (2, None, 3, "yes"),
    ]
    df = spark.createDataFrame(rows, "k int, t int, id long, s string")
    got = latest_per_key(df, ["k"], "t", "id")
    assert got.columns == df.columns
    assert sorted(r[:] for r in got.collect()) == [(1, 5, 2, "yes"), (2, None, 3, "yes")]


def test_latest_per_key_wants_a_numeric_tie_break(copies):
    with pytest.raises(TypeError):
        latest_per_key(copies, ["k"], "a", "b")


def test_dimension_takes_attributes_from_the_smallest_tie_break(spark):
    df = spark.createDataFrame([(7, "b", 2), (7, "a", 1), (5, "c", 3)], "id int, name string, line int")
    dim = build_dimension(df, ["id", "name"], ["id"], "key", tie_break="line")
    assert sorted(r[:] for r in dim.collect()) == [(5, "c", 1), (7, "a", 2)]


def test_dimension_of_bare_keys_keeps_one_null(spark):
    df = spark.createDataFrame([("b",), (None,), ("b",), (None,), ("a",)], "mode string")
    dim = build_dimension(df, ["mode"], ["mode"], "key")
    assert {r[:] for r in dim.collect()} == {(None, 1), ("a", 2), ("b", 3)}
