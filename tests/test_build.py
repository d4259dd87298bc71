"""What a build reads and writes, and keys that stay from build to build."""

import pytest
from pyspark.sql import functions as F

from conftest import final_plan, same_rows
from lineforge.operators import dense_key, extend_keys, stable_key
from lineforge.plans.fact import customer_fk
from lineforge.plans.lakehouse import NUMBERED, SORTED_TABLE, STEPS, Lakehouse
from lineforge.plans.silver import clean_orders, rejected_orders, sort_orders, sorted_clean, sorted_rejected
from lineforge.settings import Settings
from lineforge.sources import order_lines
from lineforge.sources.tables import TABLE_SETTINGS
from lineforge.storage import materialise
from pyspark.sql import types as T


@pytest.fixture
def messy(spark):
    rows = [
        ("1", "1/31/2018 22:56", "2/3/2018 22:56", "10", None), ("1", "1/31/2018 22:56", "2/2/2018 22:56", "11", None),
        ("2", "2018-01-31", "2/2/2018 1:00", "x", None), ("3", None, "", " ", None), (None, "oops", None, "1", None),
        ("4x", None, None, "1", None), ("5", None, None, "1", "5,too,many"), ("6", None, None, "1.5", None), ("1", "bad", "bad", None, None),
    ]
    columns = "order_item_id string, order_date_dateorders string, shipping_date_dateorders string, sales string, _malformed string"
    return spark.createDataFrame(rows, columns).withColumn("customer_email", F.lit("XXXX"))


@pytest.mark.parametrize("typed", [False, True])
def test_one_pass_gives_both_outcomes(messy, typed):
    schema = T.StructType.fromDDL("order_item_id long, sales int") if typed else None
    settings = Settings(tie_break=("ship_ts",), schema=schema)
    stored = materialise(sort_orders(messy, settings), "sorted")
    clean, rejected = clean_orders(messy, settings)
    assert same_rows(sorted_clean(stored, settings), clean) and sorted_clean(stored, settings).columns == clean.columns
    assert same_rows(sorted_rejected(stored), rejected)
    assert same_rows(rejected_orders(messy, settings), rejected)
    assert rejected.count() > 3 and clean.count() > 3


def test_silver_reads_bronze_once(spark, small_dir, tmp_path):
    """Both tables of silver come from the sorted lines, after bronze is gone; those are gone with the build."""
    lake = Lakehouse(spark, lambda: order_lines(spark, small_dir), "once", TABLE_SETTINGS, str(tmp_path))
    lake.bronze()
    lake.table(SORTED_TABLE)
    rows = spark.table(lake.name("bronze.order_lines")).count()
    spark.sql(f"DROP TABLE {lake.name('bronze.order_lines')}")
    assert lake.silver().count() < rows and lake.table("silver.rejected_lines").isEmpty()
    lake.refresh()
    counts = lake.build()
    assert SORTED_TABLE not in counts and set(counts) == {t for step in STEPS for t in step} - {SORTED_TABLE}
    left = [t.name for t in spark.catalog.listTables("once_silver")]
    assert not any("sorted" in name for name in left)
    assert counts["bronze.order_lines"] == rows and counts["gold.fact_order_line"] == lake.fact().count()
    lake.drop()


# --- keys ---------------------------------------------------------------------------------


def test_known_keys_stay_and_new_ones_follow(spark):
    schema = "a string, b int"
    first = dense_key(spark.createDataFrame([("m", 1), ("c", 2), (None, 3), ("m", None)], schema), ["a", "b"], "k")
    more = spark.createDataFrame([("a", 0), ("m", 1), (None, 3), ("z", None), (None, None)], schema)
    again = stable_key(more, first, ["a", "b"], "k")
    assert again.columns == ["a", "b", "k"] and dict(again.dtypes)["k"] == "int"
    assert {(r.a, r.b): r.k for r in again.collect()} == {(None, 3): 1, ("m", 1): 4, (None, None): 5, ("a", 0): 6, ("z", None): 7}
    known = extend_keys(first, again, ["a", "b"], "k")
    assert sorted(r.k for r in known.collect()) == [1, 2, 3, 4, 5, 6, 7]
    # A key that was gone for a build has its old number again.
    assert {r.k for r in stable_key(first.select("a", "b"), known, ["a", "b"], "k").collect()} == {1, 2, 3, 4}
    assert stable_key(more.limit(0), known, ["a", "b"], "k").isEmpty()
    assert stable_key(more, known.limit(0), ["a", "b"], "k").count() == 5


def test_a_second_build_with_more_products_renumbers_none(spark, small_dir, tmp_path):
    part = {"share": 0}

    def source():
        lines = order_lines(spark, small_dir)
        return lines.where((F.col("product_card_id") % 3 > part["share"]) & (F.col("customer_id") % 4 >= part["share"]))

    lake = Lakehouse(spark, source, "kept", TABLE_SETTINGS, str(tmp_path), keep_keys=True)
    before = {}
    for share in (1, 0, 1, -1):
        part["share"] = share
        lake.refresh()
        lake.build()
        for name, (on, key) in NUMBERED.items():
            rows = {tuple(r[c] for c in on): r[key] for r in lake.gold(name).collect()}
            known = before.setdefault(name, {})
            assert all(known.get(k, n) == n for k, n in rows.items())
            known |= rows
            assert sorted(known.values()) == list(range(1, len(known) + 1))
            assert spark.table(f"kept_gold.keys_of_{name}").count() == len(known)
        missing = lake.fact().where("product_key is null or customer_key is null or shipping_mode_key is null")
        assert missing.isEmpty()
    lake.drop()


def test_a_reader_between_two_views_sees_one_build(spark, small_dir, tmp_path, monkeypatch):
    """A build that stops after its first view: what opens then is of that build, table by table."""
    lines = order_lines(spark, small_dir)
    options = {"settings": TABLE_SETTINGS, "location": str(tmp_path / "lake")}
    first = Lakehouse(spark, lambda: lines.where("order_item_id % 40 = 0"), "halfway", **options)
    first.build()
    second = Lakehouse(spark, lambda: lines, "halfway", **options)
    sql, shown = type(spark).sql, []

    def stopping(self, query, *args, **kwargs):
        if "CREATE OR REPLACE VIEW" in query:
            shown.append(query)
            if len(shown) > 2:
                raise RuntimeError("stopped")
        return sql(self, query, *args, **kwargs)

    with monkeypatch.context() as patched:
        patched.setattr(type(spark), "sql", stopping)
        with pytest.raises(RuntimeError, match="stopped"):
            second.build()
    opened = Lakehouse.open(spark, "halfway", TABLE_SETTINGS)
    assert opened.fact().count() == opened.silver().count() == second.silver().count()
    assert opened.gold("dim_product").count() == second.gold("dim_product").count() > first.gold("dim_product").count()
    assert same_rows(opened.plan_fact(), opened.fact())
    second.drop()


def test_bucketed_lines_and_customers_join_where_they_lie(spark, conf, lake, tmp_path):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="4",
    )
    built = Lakehouse(spark, lake.bronze, "dealt", TABLE_SETTINGS, str(tmp_path / "lake"), buckets=6)
    counts = built.build()
    assert counts["silver.order_lines"] == lake.silver().count()
    joined = customer_fk(built.silver(), built.gold("dim_customer"), dim_rows=counts["gold.dim_customer"])
    plan = final_plan(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert same_rows(built.fact(), lake.fact())
    built.drop()


def test_silver_alone_needs_no_sorted_copy(spark, lake, tmp_path):
    """Only a build, which makes both tables of silver, stores all lines once more for them."""
    made = Lakehouse(spark, lake.bronze, "alone", TABLE_SETTINGS, str(tmp_path / "lake"))
    assert same_rows(made.silver(), lake.silver()) and same_rows(made.table("silver.rejected_lines"), lake.table("silver.rejected_lines"))
    assert SORTED_TABLE not in made.counts
    rows = made.rows(["dim_geo"])
    assert rows == {"silver": lake.silver().count(), "dim_geo": lake.gold("dim_geo").count()}
    assert not any("dim_customer" in table or "dim_product" in table for table in made.counts)
    made.drop()


def test_lines_are_stored_by_order(spark, small_dir, conf):
    """Where both parts and orders make the lines move, orders do so last."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    plan = order_lines(spark, small_dir, broadcast_rows=0)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning(l_orderkey") < plan.index("Exchange hashpartitioning(l_partkey")
