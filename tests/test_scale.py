"""Skewed input: the same results, and no task left with the hot key."""

import pytest
from pyspark.sql import functions as F

from conftest import DATA, same_rows
from lineforge.plans.lakehouse import Lakehouse
from lineforge.sources import order_lines
from lineforge.sources.tables import TABLE_SETTINGS


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A third of the lines of one part, a third of one order, a third of orders of one customer."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    read = lambda name: spark.read.parquet(str(DATA / "sf0.001" / f"{name}.parquet"))
    for name in ("region", "nation", "customer", "part"):
        read(name).write.parquet(f"{folder}/{name}.parquet")
    dice = F.pmod(F.xxhash64("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"), F.lit(9))
    lines = read("lineitem").withColumn("dice", dice)
    part = F.when(F.col("dice") < 3, 7).otherwise(F.col("l_partkey")).cast("long")
    hot_order = F.col("dice") % 3 == 1
    lines.withColumns(
        {
            "l_partkey": part,
            "l_orderkey": F.when(hot_order, 1).otherwise(F.col("l_orderkey")).cast("long"),
            "l_linenumber": F.when(hot_order, 1).otherwise(F.col("l_linenumber")),
        }
    ).drop("dice").write.parquet(f"{folder}/lineitem.parquet")
    buyer = F.when(F.col("o_orderkey") % 3 == 0, 20).otherwise(F.col("o_custkey")).cast("long")
    read("orders").withColumn("o_custkey", buyer).write.parquet(f"{folder}/orders.parquet")
    return folder


@pytest.fixture
def large_tables(conf, monkeypatch):
    """Make every table count as too large to broadcast, and a few hundred rows as hot."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )
    monkeypatch.setattr("lineforge.operators.joins.LEAST_HOT_ROWS", 100)


def test_flat_view_is_the_same_when_hot_keys_are_cut(spark, skewed, large_tables):
    broadcast = order_lines(spark, skewed)
    cut = order_lines(spark, skewed, broadcast_rows=0)
    assert "_slice" in cut._jdf.queryExecution().optimizedPlan().toString()
    assert cut.count() == spark.read.parquet(f"{skewed}/lineitem.parquet").count()
    assert same_rows(broadcast, cut)


def test_star_schema_is_the_same_when_hot_keys_are_cut(spark, skewed, large_tables, tmp_path):
    source = lambda: order_lines(spark, skewed)
    lake = Lakehouse(spark, source, "skewed", TABLE_SETTINGS, str(tmp_path))
    lake.build()
    cut = lake.plan_fact(broadcast_rows=0, hot_rows=100)
    assert "_slice" in cut._jdf.queryExecution().optimizedPlan().toString()
    assert cut.count() == lake.silver().count()
    assert same_rows(lake.fact(), cut)
