"""Registered queries: each runs one operator over whole tables.

A query reads the layer below its operator: raw lines, or tables of the lakehouse that was
built from them. That lakehouse is built once per application and input folder.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha1
from threading import Lock
from dataclasses import replace
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineforge.functions import parse_timestamp
from lineforge.operators import (
    Spread,
    code_bitmaps,
    current_versions,
    date_bounds,
    date_spine,
    day_observations,
    distinct_codes,
    former_versions,
    key_report,
    merge_snapshots,
    profile_constant_columns,
    profile_distinct,
    scd2_from_snapshots,
    scd2_versions,
    stable_key,
    temporal_join,
)
from lineforge.operators.history import mark_changed
from lineforge.plans import dashboard, fact, kpi
from lineforge.plans.lakehouse import (
    GOLD_TABLES,
    NUMBERED,
    Lakehouse,
    customer_dimension,
    date_dimension,
    geo_dimension,
    latest_customers,
    product_dimension,
    shipping_dimension,
)
from lineforge.plans.silver import clean_orders, rejected_orders
from lineforge.settings import GEO_COLUMNS, JUNK_COLUMNS
from lineforge.sinks import export_csv, write_table
from lineforge.sinks.csv import FAST
from lineforge.sources import ingest_csv, order_lines
from lineforge.sources.schemas import LINE_SCHEMA
from lineforge.sources.tables import TABLE_SETTINGS
from lineforge.storage import application_id, materialise, new_path, work_folder

Query = Callable[[SparkSession, str], DataFrame]

HISTORY = TABLE_SETTINGS.history
GRAIN = TABLE_SETTINGS.grain

# Files as a source system sends them, compressed: the lines as plain text take several times the stored bytes.
SOURCE_FILES = {"header": True, "encoding": "ISO-8859-1", "compression": "gzip", **FAST}

# Between the first and the second half of the days, for what goes on from an earlier state.
MERGED_FROM = "1995-06-17"

_lakehouses: dict[tuple[str, str], Lakehouse] = {}
_lakehouses_lock = Lock()


def lakehouse_for(spark: SparkSession, folder: str) -> Lakehouse:
    """The lakehouse over the tables in ``folder``: a snapshot, kept for this application."""
    key = (application_id(spark), folder)
    with _lakehouses_lock:
        if key not in _lakehouses:
            prefix = "lines_" + sha1("|".join(key).encode()).hexdigest()[:12]
            _lakehouses[key] = Lakehouse(
                spark,
                lambda: order_lines(spark, folder),
                prefix,
                TABLE_SETTINGS,
                location=work_folder(spark),
            )
        return _lakehouses[key]


# --- raw lines --------------------------------------------------------------------------


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lakehouse_for(spark, folder).bronze()


def file_header(column: str) -> str:
    """A header as a source system would write it, for the column it normalises to."""
    special = {
        "order_date_dateorders": "order date (DateOrders)",
        "shipping_date_dateorders": "shipping date (DateOrders)",
        "days_for_shipping_real": "Days for shipping (real)",
        "days_for_shipment_scheduled": "Days for shipment (scheduled)",
    }
    return special.get(column, column.replace("_", " ").title())


def csv_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Write the lines as Latin-1 files with free-text headers, and ingest those."""
    lines = raw_lines(spark, folder)
    path = new_path(spark, "csv-ingest")
    headed = lines.toDF(*[file_header(c) for c in lines.columns])
    headed.write.options(**SOURCE_FILES).csv(path)
    bronze = ingest_csv(spark, path, LINE_SCHEMA)
    from_file = F.col("_source_file").contains("csv-ingest").alias("has_source_file")
    return bronze.select(*LINE_SCHEMA.names, from_file)


# Texts that a double can't hold: beyond its range, with more digits than it has, no number, below its range.
NO_DOUBLES = ("1e400", "0.1234567890123456789", "NaN", "1e-400")


def csv_ingest_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Spoil lines by their ids, write them as a file, and list what is found to be at fault."""
    lines = raw_lines(spark, folder)
    line, amount, units = F.col(GRAIN), F.col("sales"), F.col("order_item_quantity")
    no_doubles = F.create_map(*[F.lit(x) for i, text in enumerate(NO_DOUBLES) for x in (i, text)])
    ratio = F.element_at(no_doubles, F.when(line % 17 < len(NO_DOUBLES), (line % 17).cast("int")))
    spoilt = {
        "order_item_profit_ratio": F.coalesce(ratio, F.col("order_item_profit_ratio").cast("string")),
        "sales": F.when(line % 7 == 1, F.lit("n/a"))
        .when(line % 7 == 2, F.concat(amount, F.lit("1")))
        .otherwise(amount.cast("string")),
        "order_item_quantity": F.when(line % 11 == 2, F.concat(units, F.lit(".0"))).otherwise(units.cast("string")),
        GRAIN: F.when(line % 13 == 3, F.concat(line, F.lit("x"))).otherwise(line.cast("string")),
    }
    path = new_path(spark, "csv-faults")
    headed = lines.withColumns(spoilt).toDF(*[file_header(c) for c in lines.columns])
    headed.write.options(**SOURCE_FILES).csv(path)
    found = rejected_orders(ingest_csv(spark, path), replace(TABLE_SETTINGS, schema=LINE_SCHEMA))
    shown = [GRAIN, "order_id", "sales", "order_item_quantity", "order_item_profit_ratio"]
    # Ratios are shown where they are spoilt: engines write other doubles in different ways.
    ratio = F.when(F.col(shown[-1]).isin(*NO_DOUBLES), F.col(shown[-1])).alias("spoilt_ratio")
    return found.select(*shown[:-1], ratio, F.col("_faults").alias("faults"))


def date_parse(spark: SparkSession, folder: str) -> DataFrame:
    lines = raw_lines(spark, folder)
    order = parse_timestamp(F.col("order_date_dateorders"), TABLE_SETTINGS.date_format)
    ship = parse_timestamp(F.col("shipping_date_dateorders"), TABLE_SETTINGS.date_format)
    parsed = lines.select(GRAIN, order.alias("order_ts"), ship.alias("ship_ts"))
    days = {"order_date": F.to_date("order_ts"), "ship_date": F.to_date("ship_ts")}
    return parsed.withColumns(days)


def silver_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The surviving copy of each order line, by what tells the copies apart."""
    kept = [GRAIN, "order_date_dateorders", "shipping_date_dateorders"]
    order = ["product_card_id", "order_item_quantity", "sales", "order_item_discount_rate"]
    lines = raw_lines(spark, folder).select(*kept, *order, "tie_suppkey")
    clean, _ = clean_orders(lines, TABLE_SETTINGS, stored=True)
    return clean.select(GRAIN, "ship_ts", *order)


def silver_clean(spark: SparkSession, folder: str) -> DataFrame:
    clean, _ = clean_orders(raw_lines(spark, folder), TABLE_SETTINGS, stored=True)
    return clean


def rejected_lines(spark: SparkSession, folder: str) -> DataFrame:
    _, rejected = clean_orders(raw_lines(spark, folder), TABLE_SETTINGS)
    return rejected.select(GRAIN, "_faults").withColumnRenamed("_faults", "faults")


# --- keys -------------------------------------------------------------------------------


def dense_key_equivalence(spark: SparkSession, folder: str) -> DataFrame:
    """Per dimension, rows in all and rows that do not hold their position in key order."""
    lake = lakehouse_for(spark, folder)
    checks = {
        "dim_product": (["product_card_id"], "product_key"),
        "dim_geo": (list(GEO_COLUMNS), "geo_key"),
        "dim_shipping_mode": (["shipping_mode"], "shipping_mode_key"),
        "dim_customer": (["customer_id", "start_date"], "customer_key"),
    }
    reports = None
    for name, (order, key) in checks.items():
        one = key_report(lake.gold(name), order, key)
        one = one.select(F.lit(name).alias("dimension"), "total_rows", "difference_rows")
        reports = one if reports is None else reports.unionByName(one)
    return reports


def kept_product_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Products numbered as of the first half of the days, and again over all: none is renumbered."""
    silver = lakehouse_for(spark, folder).silver()
    early = silver.where(F.col("order_date") < F.to_date(F.lit(MERGED_FROM)))
    before = materialise(product_dimension(early, GRAIN), "early-products")
    on, key = NUMBERED["dim_product"]
    now = product_dimension(silver, GRAIN, lambda df, by, name: stable_key(df, before, by, name))
    was = before.select(*on, F.col(key).alias("early_key"))
    return now.select(*on, "product_name", key).join(was, list(on), "left")


# --- customer history -------------------------------------------------------------------


def _marked(spark: SparkSession, folder: str) -> DataFrame:
    latest = latest_customers(lakehouse_for(spark, folder).silver(), GRAIN)
    return mark_changed(latest, "customer_id", "customer_segment", HISTORY)


def scd2_sample(spark: SparkSession, folder: str) -> DataFrame:
    """A glance at five former versions."""
    former = lakehouse_for(spark, folder).gold("dim_customer").filter("is_current = false")
    shown = former.select("customer_id", "customer_segment", "start_date", "end_date")
    return shown.orderBy("customer_id", "start_date").limit(5)


MODE = ["shipping_mode"]


def _mode_observations(spark: SparkSession, folder: str) -> DataFrame:
    """How each customer's last line of a day was shipped; stored, since a history reads it several times."""
    seen = day_observations(lakehouse_for(spark, folder).silver(), "customer_id", "order_date", MODE, GRAIN, stored=True)
    return materialise(seen, "observed-days")


def mode_versions(spark: SparkSession, folder: str) -> DataFrame:
    """History of each customer's shipping mode, from the days on which the customer ordered."""
    return scd2_from_snapshots(_mode_observations(spark, folder), "customer_id", "order_date", MODE)


def mode_versions_merged(spark: SparkSession, folder: str) -> DataFrame:
    """The same history, its second half merged into what the first half gave."""
    seen, late = _mode_observations(spark, folder), F.col("order_date") >= F.to_date(F.lit(MERGED_FROM))
    stored = materialise(scd2_from_snapshots(seen.where(~late), "customer_id", "order_date", MODE), "mode-versions")
    return merge_snapshots(stored, seen.where(late), "customer_id", "order_date", MODE)


def temporal_join_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Each line with its customer's shipping mode as of the day it was shipped."""
    lines = lakehouse_for(spark, folder).silver().select(GRAIN, "customer_id", "ship_date")
    take = {"shipping_mode": "valid_mode", "start_date": "valid_since"}
    versions = materialise(mode_versions(spark, folder), "mode-versions")
    return temporal_join(
        lines, versions, "customer_id", "ship_date", "start_date", "end_date", take, many_versions=0
    )


# --- fact -------------------------------------------------------------------------------


def _foreign_key(
    add_key: Callable[..., DataFrame], dimension: str, *columns: str, **options
) -> Query:
    """One lookup of the fact on its own."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        lake = lakehouse_for(spark, folder)
        silver, dim, rows = lake.silver(), lake.gold(dimension), lake.rows([dimension])
        spread = Spread(silver, by=[GRAIN], rows=rows["silver"])
        lines = add_key(silver, dim, dim_rows=rows[dimension], spread=spread, **options)
        return lines.select(GRAIN, *columns)

    return run


FACT_KEYS = ("customer_key", "product_key", "geo_key", "shipping_mode_key", "ship_date_key")


def distinct_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Different keys in the fact per year of order, merged from the bitmaps of months."""
    month = F.expr("order_date_key div 100").cast("int").alias("month")
    months = code_bitmaps(lakehouse_for(spark, folder).fact().select(month, *FACT_KEYS), FACT_KEYS, ["month"])
    years = months.withColumn("order_year", F.expr("month div 100").cast("int"))
    return distinct_codes(years, ["order_year"])


# --- round trips ------------------------------------------------------------------------


def table_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The fact, written as one more managed table and read back; the last copy gives way to it."""
    lake = lakehouse_for(spark, folder)
    plan = lake.plan_fact()
    schema = lake.schemas["gold"]
    copies = [t.name for t in spark.catalog.listTables(schema) if t.name.startswith("fact_copy_")]
    stored = write_table(plan, f"{schema}.fact_copy_{uuid4().hex}")
    for name in copies:
        spark.sql(f"DROP TABLE IF EXISTS `{schema}`.`{name}`")
    return stored


def csv_export_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The fact exported as CSV and read back."""
    path = new_path(spark, "export")
    lines = lakehouse_for(spark, folder).fact()
    export_csv({"fact_order_line": lines}, path, compression="gzip")
    return spark.read.schema(lines.schema).csv(f"{path}/fact_order_line", header=True, escape='"')


def csv_export_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Product names with quotes, commas, line breaks, backslashes and blanks, exported as CSV and read back."""
    path, name = new_path(spark, "export"), F.col("p_name")
    awkward = [
        F.concat(F.lit('"'), name, F.lit('"')),
        F.concat(name, F.lit(', "x", '), name),
        F.concat(F.lit("a\n"), name, F.lit('\n"')),
        F.concat(name, F.lit("\\")),
        F.concat(F.lit('\\"'), name, F.lit('\\",\n')),
        F.concat(F.lit("  "), name, F.lit(" ")),
        F.lit(""),
        F.lit(None).cast("string"),
        F.concat(name, F.lit("\r\ny")),
    ]
    texts = spark.read.parquet(f"{folder}/part.parquet").select(
        "p_partkey", F.element_at(F.array(*awkward), (F.col("p_partkey") % len(awkward) + 1).cast("int")).alias("note")
    )
    export_csv({"notes": texts}, path)
    # Another mark of null than the empty text, which Spark would read as null as well, though it is written as "".
    return spark.read.schema(texts.schema).csv(f"{path}/notes", header=True, escape='"', multiLine=True, nullValue="\0")


def csv_export_tables(spark: SparkSession, folder: str) -> DataFrame:
    """All gold tables exported; rows that each folder gives back."""
    lake = lakehouse_for(spark, folder)
    path = new_path(spark, "export")
    lake.export(path, compression="gzip")
    counted = None
    for name in GOLD_TABLES:
        back = spark.read.schema(lake.gold(name).schema).csv(f"{path}/{name}", header=True, escape='"')
        one = back.agg(F.count("*").alias("n_rows")).withColumn("table_name", F.lit(name))
        counted = one if counted is None else counted.unionByName(one)
    return counted


# --- registration -----------------------------------------------------------------------


def _raw(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: build(raw_lines(spark, folder))


def _silver(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: build(lakehouse_for(spark, folder).silver())


def _lake(build: Callable[[Lakehouse], DataFrame]) -> Query:
    return lambda spark, folder: build(lakehouse_for(spark, folder))


def _on_marked(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: build(_marked(spark, folder))


def _star(build: Callable[..., DataFrame], dimension: str | None = None, **options) -> Query:
    """A report over the stored fact and at most one dimension."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        lake = lakehouse_for(spark, folder)
        dims = [] if dimension is None else [lake.gold(dimension)]
        return build(lake.fact(), *dims, **options)

    return run


def _best_first(query: Query, column: str) -> Query:
    return lambda spark, folder: query(spark, folder).orderBy(F.desc(column))


def _comparable(query: Query) -> Query:
    """Decimals as doubles: both engines of the check then return the same kind of number."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = query(spark, folder)
        exact = [f.name for f in df.schema if isinstance(f.dataType, T.DecimalType)]
        return df.withColumns({name: F.col(name).cast("double") for name in exact})

    return run


def market_summary(spark: SparkSession, folder: str) -> DataFrame:
    lake = lakehouse_for(spark, folder)
    lake.fact()
    return kpi.market_summary(spark, lake.name("gold.fact_order_line"), lake.name("gold.dim_geo"))


def _bounds(silver: DataFrame) -> DataFrame:
    return date_bounds(silver, ["order_date"], ["order_date", "ship_date"])


_QUERIES: dict[str, Query] = {
    "csv_ingest": csv_ingest,
    "csv_ingest_faults": csv_ingest_faults,
    "date_parse": date_parse,
    "table_roundtrip": table_roundtrip,
    "csv_export_roundtrip": csv_export_roundtrip,
    "csv_export_texts": csv_export_texts,
    "csv_export_tables": csv_export_tables,
    "profile_distinct": _raw(lambda raw: profile_distinct(raw, JUNK_COLUMNS)),
    "profile_constant_columns": _raw(profile_constant_columns),
    "layer_counts": _lake(lambda lake: lake.layer_counts()),
    "silver_dedup": silver_dedup,
    "silver_clean": silver_clean,
    "rejected_lines": rejected_lines,
    "dim_product": _silver(lambda silver: product_dimension(silver, GRAIN)),
    "dim_geo": _silver(geo_dimension),
    "dim_shipping_mode": _silver(shipping_dimension),
    "date_bounds": _silver(_bounds),
    "date_spine": _silver(lambda silver: date_spine(_bounds(silver))),
    "dim_date": _silver(date_dimension),
    "dense_key_equivalence": dense_key_equivalence,
    "dim_product_kept_keys": kept_product_keys,
    "customer_latest": _silver(lambda silver: latest_customers(silver, GRAIN)),
    "scd2_is_changed": _on_marked(
        lambda marked: marked.select("customer_id", "customer_segment", "is_changed")
    ),
    "scd2_current_rows": _on_marked(lambda m: current_versions(m, "customer_segment", HISTORY)),
    "scd2_history_rows": _on_marked(lambda m: former_versions(m, "customer_segment", HISTORY)),
    "scd2_dim": _on_marked(lambda m: scd2_versions(m, "customer_segment", HISTORY)),
    "scd2_sample": scd2_sample,
    "scd2_from_snapshots": mode_versions,
    "scd2_merge_snapshots": mode_versions_merged,
    "temporal_join_versions": temporal_join_versions,
    "dim_customer": _silver(lambda silver: customer_dimension(silver, TABLE_SETTINGS)),
    "temporal_join_customer": _foreign_key(fact.customer_fk, "dim_customer", "customer_key"),
    "fact_product_fk": _foreign_key(fact.product_fk, "dim_product", "product_key"),
    "fact_geo_fk": _foreign_key(fact.geo_fk, "dim_geo", "geo_key"),
    "fact_geo_fk_nullsafe": _foreign_key(fact.geo_fk, "dim_geo", "geo_key", null_safe=True),
    "fact_shipping_fk": _foreign_key(fact.shipping_fk, "dim_shipping_mode", "shipping_mode_key"),
    "fact_date_fk": _foreign_key(fact.date_fk, "dim_date", "order_date_key", "ship_date_key"),
    "fact_order_line": _lake(lambda lake: lake.plan_fact()),
    "kpi_delivery_by_market": _best_first(_star(kpi.delivery_kpi, "dim_geo"), "total_orders"),
    "kpi_sales_by_segment": _best_first(_star(kpi.segment_kpi, "dim_customer"), "total_sales"),
    "kpi_segment_as_was": _star(kpi.segment_kpi, "dim_customer", mode="as_was"),
    "kpi_segment_as_is": _star(kpi.segment_kpi, "dim_customer", mode="as_is"),
    "sql_market_summary": market_summary,
    "distinct_keys_by_year": distinct_keys,
    "dash_department_share": _star(dashboard.department_share, "dim_product"),
    "dash_top_units": _star(dashboard.top_products, "dim_product", by="units"),
    "dash_top_revenue": _star(dashboard.top_products, "dim_product", by="sales"),
    "dash_late_overall": _star(dashboard.late_overall),
    "dash_late_by_mode": _star(
        dashboard.late_by, "dim_shipping_mode", key="shipping_mode_key", level="shipping_mode"
    ),
    "dash_late_by_market": _silver(dashboard.late_by_market),
    "dash_late_levels": _silver(dashboard.late_levels),
    "dash_unprofitable_share": _star(dashboard.unprofitable_share),
    "dash_category_margin": _star(dashboard.category_margin, "dim_product"),
    "dash_segment_margin": _star(dashboard.segment_margin, "dim_customer"),
    "dash_market_concentration": _silver(dashboard.market_concentration),
}


def queries() -> dict[str, Query]:
    return {name: _comparable(query) for name, query in _QUERIES.items()}
