import pytest
from pyspark.sql import functions as F

from conftest import final_plan, same_rows
from lineforge.operators import Spread, lookup_join
from lineforge.operators.joins import hot_keys
from lineforge.storage import materialise


@pytest.fixture(scope="module")
def fact(spark):
    """A third of the lines under key 1, a sixth under null, a few keys unknown."""
    key = (
        F.when(F.col("id") % 3 == 0, 1)
        .when(F.col("id") % 6 == 1, None)
        .otherwise(F.col("id") % 50 + 2)
    )
    part = F.when(F.col("id") % 5 > 0, F.concat(F.lit("p"), (F.col("id") % 2).cast("string")))
    return materialise(spark.range(6000).select("id", key.alias("k"), part.alias("p")), "fact")


@pytest.fixture(scope="module")
def dim(spark):
    keys = spark.range(40).select(F.when(F.col("id") > 0, F.col("id")).alias("key"))
    parts = spark.createDataFrame([("p0",), ("p1",), (None,)], "part string")
    pairs = keys.join(parts)
    return pairs.withColumn("name", F.concat_ws("-", F.lit("n"), "key", "part"))


ON = {"k": "key", "p": "part"}


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_all_strategies_agree(fact, dim, null_safe, how):
    spread = Spread(fact, by=["id"], rows=6000, hot_rows=300)
    options = dict(null_safe=null_safe, how=how)
    by_spark = lookup_join(fact, dim, ON, ["name"], **options)
    broadcast = lookup_join(fact, dim, ON, ["name"], dim_rows=120, **options)
    cut = lookup_join(fact, dim, ON, ["name"], dim_rows=120, broadcast_rows=0, spread=spread, **options)
    match = " AND ".join(f"{a} {'<=>' if null_safe else '='} {b}" for a, b in ON.items())
    plain = fact.join(dim, F.expr(match), how).select("id", "k", "p", "name")
    for joined in (by_spark, broadcast, cut):
        assert joined.columns == ["id", "k", "p", "name"]
        assert same_rows(joined, plain)


def test_hot_keys_are_found_and_cut_by_size(fact):
    hot = hot_keys(Spread(fact, by=["id"], rows=6000, hot_rows=500), ["k"])
    assert {(r._hot_k, r._slices) for r in hot.collect()} == {(1, 16), (None, 8)}


def test_sampling_finds_a_hot_key(spark):
    """With a threshold far above the sample's aim, only a part of the rows is counted."""
    key = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))
    stored = materialise(spark.range(300_000).select("id", key.alias("k")), "sampled")
    hot = hot_keys(Spread(stored, by=["id"], rows=300_000, hot_rows=20_000), ["k"]).collect()
    assert [r._hot_k for r in hot] == [-1]
    assert 16 <= hot[0]._slices <= 24


def test_small_side_is_broadcast_and_large_side_is_not(spark, conf, fact, dim):
    conf(spark__sql__autoBroadcastJoinThreshold="1")
    small = lookup_join(fact, dim, ON, ["name"], dim_rows=120)
    assert "BroadcastHashJoin" in final_plan(small) and "SortMergeJoin" not in final_plan(small)
    spread = Spread(fact, by=["id"], rows=6000, hot_rows=10**6)
    large = lookup_join(fact, dim, ON, ["name"], dim_rows=120, broadcast_rows=0, spread=spread)
    assert "SortMergeJoin" in final_plan(large) and "BroadcastHashJoin" not in final_plan(large)


def test_slices_spread_a_hot_key_over_tasks(spark, conf, fact, dim):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="8",
    )

    def largest_task(spread):
        joined = lookup_join(fact, dim, {"k": "key"}, ["name"], broadcast_rows=0, dim_rows=9, spread=spread)
        tasks = joined.groupBy(F.spark_partition_id().alias("task")).count()
        return tasks.agg(F.max("count")).first()[0]

    dim = dim.filter("part = 'p0'")
    whole = largest_task(None)
    assert whole >= 2000
    cut = largest_task(Spread(fact, by=["id"], rows=6000, hot_rows=750))
    assert cut < whole * 0.75


def test_default_threshold_is_a_tasks_share(spark, fact):
    share = Spread(fact, by=["id"], rows=400_000_000).hot_from()
    assert share == 100_000_000
    assert Spread(fact, by=["id"], rows=10).hot_from() == 100_000


def test_few_but_wide_rows_are_not_broadcast(spark, conf):
    from pyspark.sql import functions as F

    from lineforge.operators import lookup_join

    fact = spark.range(100).withColumnRenamed("id", "k")
    dim = spark.range(50).select("id", F.repeat(F.lit("x"), 1000).alias("name"))
    plan = lambda **o: lookup_join(
        fact, dim, {"k": "id"}, {"name": "name"}, dim_rows=50, **o
    )._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan()
    assert "broadcast" not in plan(broadcast_bytes=40_000)
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    assert "broadcast" not in plan()


def test_many_narrow_rows_are_broadcast(spark):
    """A key and a number of 1.2 million rows are 19 MB: no reason to move the lines."""
    fact, dim = spark.range(100).withColumnRenamed("id", "k"), spark.range(50).selectExpr("id", "id + 1 as n")
    plan = lambda rows: lookup_join(fact, dim, {"k": "id"}, ["n"], dim_rows=rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(1_200_000)
    assert "broadcast" not in plan(20_000_000)
