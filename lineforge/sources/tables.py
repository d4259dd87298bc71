"""The normalised order tables seen as one flat line per ``lineitem``: the shape of the file."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineforge.operators.joins import BROADCAST_ROWS, Spread, lookup_join
from lineforge.settings import History, Settings
from lineforge.sources.schemas import FINE_MONEY, LINE_SCHEMA, MONEY, RATE
from lineforge.storage import fit_shuffle

# Columns that tell the lines of one order, part or customer apart.
LINE_PARTS = (
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_shipdate",
    "l_quantity",
    "l_extendedprice",
)

# Parameters that fit the order tables: their dates and segments differ from the file's.
TABLE_SETTINGS = Settings(
    tie_break=(
        "ship_ts",
        "product_card_id",
        "tie_suppkey",
        "order_item_quantity",
        "sales",
        "order_item_discount_rate",
    ),
    helpers=("tie_suppkey",),
    history=History(base_value="BUILDING", floor="1990-01-01", cutoff="1998-06-01"),
)


def _date_text(ts: Column) -> Column:
    """``M/d/yyyy H:mm`` from the fields of a zone-free timestamp."""
    minute = F.lpad(F.minute(ts).cast("string"), 2, "0")
    day = F.concat_ws("/", F.month(ts), F.dayofmonth(ts), F.year(ts))
    return F.concat(day, F.lit(" "), F.hour(ts), F.lit(":"), minute)


def count_rows(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """Rows per stored table, from the file footers, in one job."""
    counted = [
        df.agg(F.count("*").alias("n_rows")).withColumn("name", F.lit(name))
        for name, df in tables.items()
    ]
    return {row["name"]: row["n_rows"] for row in reduce(DataFrame.unionByName, counted).collect()}


def use_all_cores(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Deal out an input that has fewer splits than there are cores, by columns that vary.

    Such an input is small, less than one split's bytes per core, so moving it costs less
    than leaving cores idle in all that follows. A larger one is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *by) if df.rdd.getNumPartitions() < cores else df


def order_lines(
    spark: SparkSession, folder: str, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Flat order lines from the parquet tables in ``folder``.

    Customers join orders before the far more numerous lines do, so the lines move only for
    parts and orders. Parts come first: their columns are fewer than those of orders and customers, and the
    lines then end up in the order of orders, which takes less room where they are stored. How each
    table is joined follows from its counted rows.
    """
    tables = {
        name: spark.read.parquet(f"{folder}/{name}.parquet")
        for name in ("lineitem", "orders", "part", "customer", "nation", "region")
    }
    rows = count_rows(tables)
    fit_shuffle(spark, rows["lineitem"])

    def spread(name: str, by: Sequence[str]) -> Spread:
        return Spread(counted=tables[name], by=by, rows=rows[name])

    def meet(left: DataFrame, right: DataFrame, name: str, on: dict[str, str], spread=None):
        take = [column for column in right.columns if column not in on.values()]
        return lookup_join(
            left,
            right,
            on,
            take,
            dim_rows=rows[name],
            broadcast_rows=broadcast_rows,
            spread=spread,
            how="inner",
        )

    places = meet(tables["nation"], tables["region"], "region", {"n_regionkey": "r_regionkey"})
    buyers = meet(tables["customer"], places, "nation", {"c_nationkey": "n_nationkey"})
    orders = meet(
        tables["orders"], buyers, "customer", {"o_custkey": "c_custkey"}, spread("orders", ["o_orderkey"])
    )
    lines = use_all_cores(tables["lineitem"], LINE_PARTS)
    by_line = spread("lineitem", LINE_PARTS)
    lines = meet(lines, tables["part"], "part", {"l_partkey": "p_partkey"}, by_line)
    lines = meet(lines, orders, "orders", {"l_orderkey": "o_orderkey"}, by_line)

    def text(prefix: str, n: int) -> Column:
        return F.concat(F.lit(prefix), (F.col("o_custkey") % n).cast("string"))

    null_text = F.lit(None).cast("string")
    lines = lines.withColumns(
        {
            "sales": F.col("l_extendedprice").cast(MONEY),
            "rate": F.col("l_discount").cast(RATE),
            "price": F.col("p_retailprice").cast(MONEY),
            "units": F.col("l_quantity").cast("int"),
            "real_days": F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")),
            "planned_days": F.substring("o_orderpriority", 1, 1).cast("int"),
        }
    )
    net = F.col("sales") * (1 - F.col("rate"))
    lines = lines.withColumns(
        {
            "total": net.cast(FINE_MONEY),
            "profit": (net - F.col("units") * F.col("price")).cast(FINE_MONEY),
        }
    )
    columns = {
        "order_item_id": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        "order_id": F.col("l_orderkey"),
        "order_date_dateorders": _date_text(F.col("o_orderdate")),
        "shipping_date_dateorders": _date_text(F.col("l_shipdate")),
        "days_for_shipping_real": F.col("real_days"),
        "days_for_shipment_scheduled": F.col("planned_days"),
        "late_delivery_risk": F.when(F.expr("real_days > planned_days"), 1).otherwise(0),
        "delivery_status": F.col("l_linestatus"),
        "order_status": F.col("o_orderstatus"),
        "shipping_mode": F.col("o_orderpriority"),
        "sales": F.col("sales"),
        "order_item_quantity": F.col("units"),
        "order_item_discount": (F.col("sales") * F.col("rate")).cast(FINE_MONEY),
        "order_item_discount_rate": F.col("rate"),
        "order_item_profit_ratio": F.expr("try_divide(double(profit), double(total))"),
        "order_profit_per_order": F.col("profit"),
        "benefit_per_order": F.col("profit"),
        "order_item_total": F.col("total"),
        "customer_id": F.col("o_custkey"),
        "customer_fname": F.col("c_name"),
        "customer_lname": null_text,
        "customer_segment": F.col("c_mktsegment"),
        "customer_city": text("CITY_", 40),
        "customer_state": text("STATE_", 8),
        "customer_country": F.col("n_name"),
        "customer_zipcode": F.lpad((F.col("o_custkey") % 100000).cast("string"), 5, "0"),
        "product_card_id": F.col("l_partkey"),
        "product_name": F.col("p_name"),
        "category_id": F.col("p_size"),
        "category_name": F.col("p_type"),
        "department_id": F.expr("int(substring(p_brand, 7))"),
        "department_name": F.col("p_brand"),
        "product_price": F.col("price"),
        "market": F.col("r_name"),
        "order_region": F.expr("concat(r_name, '-', string(c_nationkey % 2))"),
        "order_country": F.col("n_name"),
        "order_state": F.when(F.col("c_nationkey") % 7 != 3, text("STATE_", 8)),
        "order_city": text("CITY_", 40),
        "customer_email": F.lit("XXXX"),
        "customer_password": F.lit("XXXX"),
        "product_description": null_text,
        "product_status": F.lit(0),
        "product_image": F.col("p_name"),
        "tie_suppkey": F.col("l_suppkey"),
    }
    return lines.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in LINE_SCHEMA])
