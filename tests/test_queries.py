"""Every registered query against the same result in SQL, on whole tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import DATA, final_plan
from lineforge import catalogue

FOLDER = str(DATA / "sf0.01")
TABLES = ("region", "nation", "customer", "part", "orders", "lineitem")
DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_its_sql():
    assert catalogue.queries().keys() == catalogue.oracle_sql().keys()
    assert catalogue.queries().keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", catalogue.queries())
def test_query_agrees_with_sql(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    cursor = duck.execute(contract.oracle_sql()[name])
    types = {column[0]: str(column[1]) for column in cursor.description}
    assert {c: DUCK_TYPES[t] for c, t in df.dtypes} == types
    place = [list(types).index(column) for column in df.columns]
    wanted = [tuple(row[i] for i in place) for row in cursor.fetchall()]
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, wanted))


def test_flagship_runs(spark):
    df = contract.entry(spark)
    assert df.columns == ["market", "orders", "on_time_rate", "total_sales"]
    assert df.count() == 5


def test_anchors(spark):
    run = lambda name: contract.queries()[name](spark, FOLDER)
    counts = {r.table_name: r.n_rows for r in run("layer_counts").filter("layer = 'gold'").collect()}
    assert counts["fact_order_line"] == 45_832
    assert [counts[f"dim_{n}"] for n in ("product", "geo", "shipping_mode", "date", "customer")] == [
        2000, 791, 5, 2500, 1561,
    ]
    markets = {r.market: r[:] for r in run("sql_market_summary").collect()}
    assert markets["AMERICA"] == ("AMERICA", 9198, 0.54, 487_226_675.0)
    segments = {r.customer_segment: r.total_sales for r in run("kpi_sales_by_segment").collect()}
    assert segments["BUILDING"] == 480_509_039.36
    assert run("scd2_history_rows").count() == 61


@pytest.mark.parametrize("name", catalogue.queries())
def test_plan_stays_in_the_jvm_and_spread_out(spark, name):
    """No Python in any plan, no nested-loop join, and no single partition of unbounded data.

    What meets in one partition is a total, a finished report, or one row per partition:
    always the output of an aggregate that is partial first.
    """
    plan = final_plan(contract.queries()[name](spark, FOLDER))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
        assert bad not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = next(text for text in lines[i + 1 :] if "Stage" not in text and "Coalesce" not in text)
            assert any(kind in below for kind in ("Aggregate", "Project", "Filter", "TakeOrdered", "Limit"))
