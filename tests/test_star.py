"""What must hold for any lakehouse, checked over the smallest tables."""

import pytest
from pyspark.sql import functions as F

from conftest import same_rows
from lineforge.operators import build_dimension, first_per_key
from lineforge.plans.fact import FACT_COLUMNS, build_fact, geo_fk
from lineforge.plans.kpi import segment_kpi
from lineforge.plans.lakehouse import DIMENSIONS, GOLD_TABLES, Lakehouse
from lineforge.settings import GEO_COLUMNS

KEYS = {
    "dim_product": ("product_key", ["product_card_id"]),
    "dim_geo": ("geo_key", list(GEO_COLUMNS)),
    "dim_shipping_mode": ("shipping_mode_key", ["shipping_mode"]),
    "dim_customer": ("customer_key", ["customer_id", "start_date"]),
}


def test_silver_has_one_row_per_order_item(lake):
    silver = lake.silver()
    assert silver.count() == lake.bronze().select("order_item_id").distinct().count()


@pytest.mark.parametrize("name", KEYS)
def test_surrogate_keys_are_1_to_n(lake, name):
    key, natural = KEYS[name]
    dim = lake.gold(name)
    n = dim.count()
    bounds = dim.agg(F.min(key), F.max(key), F.countDistinct(key)).first()
    assert bounds[:] == (1, n, n)
    assert dim.select(natural).distinct().count() == n


def test_fact_has_the_rows_of_silver_and_its_columns(lake):
    assert lake.fact().columns == list(FACT_COLUMNS)
    assert len(FACT_COLUMNS) == 21
    assert lake.fact().count() == lake.silver().count()
    assert same_rows(lake.fact().select("order_item_id"), lake.silver().select("order_item_id"))


def test_every_customer_has_one_current_version_without_gap(lake):
    dim = lake.gold("dim_customer")
    per = dim.groupBy("customer_id").agg(
        F.sum(F.col("is_current").cast("int")).alias("current"),
        F.min("start_date").alias("first"),
        F.max("end_date").alias("last"),
        F.sum(F.datediff("end_date", "start_date") + 1).alias("days"),
    )
    wrong = (F.col("current") != 1) | (F.col("days") != F.datediff("last", "first") + 1)
    assert per.filter(wrong).isEmpty()
    assert per.agg(F.min("first"), F.max("first")).first()[:] == per.select("first").first()[:] * 2


def test_calendar_is_contiguous(lake):
    days = lake.gold("dim_date").agg(F.min("full_date"), F.max("full_date"), F.count("*")).first()
    assert (days[1] - days[0]).days + 1 == days[2]
    bounds = lake.silver().agg(F.min("order_date"), F.max("order_date"), F.max("ship_date")).first()
    assert days[0] == bounds[0] and days[1] == max(bounds[1], bounds[2])


def test_foreign_keys_resolve(lake):
    pairs = [(name, key, key) for name, (key, _) in KEYS.items()]
    pairs += [("dim_date", "date_key", fk) for fk in ("order_date_key", "ship_date_key")]
    for name, key, fk in pairs:
        known = lake.gold(name).select(F.col(key).alias(fk))
        used = lake.fact().filter(F.col(fk).isNotNull())
        assert used.join(known, fk, "left_anti").isEmpty()


def test_null_geography_finds_its_row_only_null_safely(lake):
    lines = lake.silver()
    missing = lines.filter(" OR ".join(f"{c} IS NULL" for c in GEO_COLUMNS)).count()
    assert missing > 0
    assert lake.fact().filter("geo_key IS NULL").count() == missing
    safe = geo_fk(lines, lake.gold("dim_geo"), null_safe=True)
    assert safe.filter("geo_key IS NULL").isEmpty()


def test_delivery_report_covers_lines_with_a_geography(lake):
    total = lake.gold("kpi_delivery_by_market").agg(F.sum("total_orders")).first()[0]
    assert total == lake.fact().filter("geo_key IS NOT NULL").count()


def test_three_readings_of_segment_sales(lake):
    fact, customers = lake.fact(), lake.gold("dim_customer")
    total = {
        mode: segment_kpi(fact, customers, mode).agg(F.sum("total_sales")).first()[0]
        for mode in ("current", "as_was", "as_is")
    }
    everything = fact.agg(F.sum("sales")).first()[0]
    former = customers.filter("NOT is_current").select("customer_key")
    historic = fact.join(former, "customer_key", "left_semi").agg(F.sum("sales")).first()[0] or 0
    assert total["as_was"] == total["as_is"] == everything
    assert total["current"] == everything - historic
    with pytest.raises(ValueError):
        segment_kpi(fact, customers, "sometimes")


def test_fact_is_the_same_however_dimensions_are_joined(lake):
    dims = lake.dimensions()
    by_spark = build_fact(lake.silver(), **dims)
    assert same_rows(lake.fact(), by_spark)
    assert same_rows(lake.fact(), lake.plan_fact(broadcast_rows=0, hot_rows=50))


def test_layer_counts_and_export(lake, tmp_path, spark):
    counts = {(r.layer, r.table_name): r.n_rows for r in lake.layer_counts().collect()}
    assert len(counts) == 10
    assert counts["silver", "order_lines"] == counts["gold", "fact_order_line"]
    lake.export(str(tmp_path))
    for name in GOLD_TABLES:
        back = spark.read.schema(lake.gold(name).schema).csv(str(tmp_path / name), header=True, escape='"')
        assert same_rows(lake.gold(name), back)


def test_rebuild_overwrites_and_gives_the_same_keys(lake, spark):
    before = {name: lake.gold(name).collect() for name in DIMENSIONS}
    lake.refresh()
    lake.build()
    for name, rows in before.items():
        assert sorted(map(str, rows)) == sorted(map(str, lake.gold(name).collect()))


def test_lakehouse_from_files(spark, tmp_path, lake):
    """Files in, star schema out, with the parameters of the public source file."""
    from lineforge.catalogue.registry import file_header
    from lineforge.sources.schemas import LINE_SCHEMA

    lines = lake.bronze()
    path = str(tmp_path / "in")
    lines.toDF(*map(file_header, lines.columns)).write.options(
        header=True, encoding="ISO-8859-1"
    ).csv(path)
    built = Lakehouse.from_csv(
        spark, path, "from_files", LINE_SCHEMA, settings=lake.settings, location=str(tmp_path / "lake")
    )
    counts = built.build()
    assert counts["silver.rejected_lines"] == 0
    assert same_rows(built.fact(), lake.fact())
    assert {"_ingested_at", "_source_file"} <= set(built.bronze().columns)
    assert not {"_ingested_at", "_source_file"} & set(built.silver().columns)
    built.drop()
    assert not spark.catalog.databaseExists("from_files_gold")


def test_default_parameters_fit_the_public_file(lake):
    from lineforge.settings import Settings

    history = Settings().history
    assert (history.base_value, history.cutoff, history.floor) == ("Consumer", "2017-06-01", "2000-01-01")


def test_helpers_keep_small_groups_small(lake):
    """Building a dimension twice gives the same table: nothing depends on task order."""
    silver = lake.silver()
    attributes = ["product_card_id", "product_name", "product_price"]
    once = build_dimension(silver, attributes, ["product_card_id"], "k", "order_item_id")
    again = build_dimension(silver.repartition(3), attributes, ["product_card_id"], "k", "order_item_id")
    assert same_rows(once, again)
    assert first_per_key(silver, ["order_id"]).count() == silver.select("order_id").distinct().count()


def test_a_build_shows_as_a_whole(spark, tmp_path, lake):
    """Two objects under one name: at every step the plain names show one build, the last whole one."""
    import os

    lines = lake.bronze()
    few = lines.filter("order_item_id % 50 = 0")
    name, options = "switched", {"settings": lake.settings, "location": str(tmp_path / "lake")}

    def shown():
        return [spark.table(f"{name}_{t}").count() for t in ("silver.order_lines", "gold.fact_order_line")]

    with pytest.raises(ValueError, match="no build to open"):
        Lakehouse.open(spark, name)
    first = Lakehouse(spark, lambda: few, name, **options)
    first.build()
    before = shown()
    assert before[0] == before[1]
    second = Lakehouse(spark, lambda: lines, name, **options)
    assert second.gold("dim_geo").count() > first.gold("dim_geo").count()
    assert shown() == before
    broken = Lakehouse(spark, lambda: lines, name, **options)
    broken._builders["gold.fact_order_line"] = lambda: spark.table("there_is_no_such_table")
    with pytest.raises(Exception, match="there_is_no_such_table"):
        broken.build()
    assert shown() == before
    second.build()
    after = shown()
    assert after[0] == after[1] > before[0]
    assert len(os.listdir(tmp_path / "lake" / f"{name}_gold")) == len(GOLD_TABLES)

    opened = Lakehouse.open(spark, name, lake.settings)
    assert same_rows(opened.fact(), second.fact()) and same_rows(opened.plan_fact(), second.fact())
    with pytest.raises(ValueError, match="no source"):
        opened.refresh()
    opened.drop()


def test_stored_star_with_null_safe_places(spark, tmp_path, lake):
    from dataclasses import replace

    settings = replace(lake.settings, null_safe_geo=True)
    built = Lakehouse(spark, lake.bronze, "nullsafe", settings, location=str(tmp_path / "lake"))
    assert built.fact().filter("geo_key IS NULL").isEmpty()
    built.drop()


def test_mean_ratio_does_not_depend_on_row_order(lake):
    reports = [
        segment_kpi(lake.fact().repartition(n, column), lake.gold("dim_customer"), "as_was")
        for n, column in ((1, "sales"), (3, "quantity"), (7, "order_id"))
    ]
    rows = [sorted(map(str, report.collect())) for report in reports]
    assert rows[0] == rows[1] == rows[2]
    odd = lake.fact().withColumn("order_item_profit_ratio", F.lit(float("inf")))
    assert segment_kpi(odd, lake.gold("dim_customer")).first().avg_profit_ratio == float("inf")


def test_build_leaves_only_layer_tables(spark, tmp_path, lake):
    import os

    from lineforge.storage import work_folder

    folder = work_folder(spark)
    kept = lambda: {f for f in os.listdir(folder) if f.startswith(("order-", "hot-keys-"))}
    before = kept()
    built = Lakehouse(spark, lake.bronze, "tidy", lake.settings, location=str(tmp_path / "lake"))
    built.build()
    assert kept() == before
    built.drop()
