"""The fact table: silver lines with natural keys replaced by surrogate keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineforge.operators.joins import BROADCAST_ROWS, Spread, lookup_join, temporal_join
from lineforge.settings import GEO_COLUMNS

# The 21 columns of the fact, as result name and source where they differ.
FACT_COLUMNS = {
    "order_item_id": "order_item_id",
    "order_id": "order_id",
    "customer_key": "customer_key",
    "product_key": "product_key",
    "geo_key": "geo_key",
    "shipping_mode_key": "shipping_mode_key",
    "order_date_key": "order_date_key",
    "ship_date_key": "ship_date_key",
    "sales": "sales",
    "quantity": "order_item_quantity",
    "order_item_discount": "order_item_discount",
    "order_item_discount_rate": "order_item_discount_rate",
    "order_item_profit_ratio": "order_item_profit_ratio",
    "profit_per_order": "order_profit_per_order",
    "benefit_per_order": "benefit_per_order",
    "order_item_total": "order_item_total",
    "days_ship_real": "days_for_shipping_real",
    "days_ship_scheduled": "days_for_shipment_scheduled",
    "late_delivery_risk": "late_delivery_risk",
    "delivery_status": "delivery_status",
    "order_status": "order_status",
}


def customer_fk(lines: DataFrame, dim_customer: DataFrame, **options) -> DataFrame:
    """Key of the customer version valid on the order date."""
    return temporal_join(
        lines,
        dim_customer,
        key="customer_id",
        at="order_date",
        start="start_date",
        end="end_date",
        take={"customer_key": "customer_key"},
        **options,
    )


def product_fk(lines: DataFrame, dim_product: DataFrame, **options) -> DataFrame:
    on = {"product_card_id": "product_card_id"}
    return lookup_join(lines, dim_product, on, {"product_key": "product_key"}, **options)


def geo_fk(lines: DataFrame, dim_geo: DataFrame, null_safe: bool = False, **options) -> DataFrame:
    """A null in any of the five parts finds no key, unless ``null_safe``."""
    on = {column: column for column in GEO_COLUMNS}
    return lookup_join(lines, dim_geo, on, {"geo_key": "geo_key"}, null_safe=null_safe, **options)


def shipping_fk(lines: DataFrame, dim_shipping_mode: DataFrame, **options) -> DataFrame:
    on = {"shipping_mode": "shipping_mode"}
    take = {"shipping_mode_key": "shipping_mode_key"}
    return lookup_join(lines, dim_shipping_mode, on, take, **options)


def date_fk(lines: DataFrame, dim_date: DataFrame, **options) -> DataFrame:
    """Order and ship date each look up the one calendar; days outside it stay null."""
    for day, key in (("order_date", "order_date_key"), ("ship_date", "ship_date_key")):
        lines = lookup_join(lines, dim_date, {day: "full_date"}, {"date_key": key}, **options)
    return lines


def build_fact(
    silver: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_geo: DataFrame,
    dim_shipping_mode: DataFrame,
    dim_date: DataFrame,
    null_safe_geo: bool = False,
    rows: Mapping[str, int] | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int | None = None,
) -> DataFrame:
    """All six lookups over a stored silver table; row count stays that of silver.

    ``rows`` gives the counted rows of ``silver`` and of the dimensions by name. The smallest
    dimensions come first: they are broadcast, and swap wide natural keys for a key of four
    bytes before any dimension that is too large makes the lines move. Without counts Spark
    decides by file size.
    """
    counted = rows is not None
    rows = rows or {}
    lookups = {
        "dim_customer": (customer_fk, dim_customer, {}),
        "dim_product": (product_fk, dim_product, {}),
        "dim_geo": (geo_fk, dim_geo, {"null_safe": null_safe_geo}),
        "dim_shipping_mode": (shipping_fk, dim_shipping_mode, {}),
        "dim_date": (date_fk, dim_date, {}),
    }
    spread = None
    if counted:
        spread = Spread(silver, by=["order_item_id"], rows=rows["silver"], hot_rows=hot_rows)
    lines = silver
    for name in sorted(lookups, key=lambda n: rows.get(n, broadcast_rows + 1)):
        add_key, dim, options = lookups[name]
        lines = add_key(
            lines,
            dim,
            dim_rows=rows.get(name),
            broadcast_rows=broadcast_rows,
            spread=spread,
            **options,
        )
    return lines.select(*[F.col(source).alias(name) for name, source in FACT_COLUMNS.items()])
