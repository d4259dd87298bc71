"""Reports kept as gold tables.

Every report first adds the fact up per surrogate key, map-side, and joins the dimension to
those sums: a key with a third of all lines is one row by then, whatever the join strategy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lineforge.functions import mean

# Names and rounding places of the columns of the reports below.

# Ratios are added up as decimals, whose sum does not depend on the order of the rows.
EXACT_RATIO = "decimal(30,15)"

SEGMENT_MODES = ("current", "as_was", "as_is")


def delivery_kpi(fact: DataFrame, dim_geo: DataFrame) -> DataFrame:
    """Lines, on-time rate and mean delay per market, over lines with a geography.

    ``total_orders`` counts order lines. On time is every line not flagged as late.
    """
    delay = F.col("days_ship_real") - F.col("days_ship_scheduled")
    per_place = fact.groupBy("geo_key").agg(
        F.count("*").alias("lines"),
        F.sum("late_delivery_risk").alias("late"),
        F.count("late_delivery_risk").alias("rated"),
        F.sum(delay).alias("delay"),
        F.count(delay).alias("timed"),
    )
    return (
        per_place.join(dim_geo.select("geo_key", "market"), "geo_key")
        .groupBy("market")
        .agg(
            F.sum("lines").alias("total_orders"),
            F.round(1 - mean("late", "rated"), 3).alias("on_time_rate"),
            F.round(mean("delay", "timed"), 2).alias("avg_delay_days"),
        )
    )


def segment_of_key(dim_customer: DataFrame, mode: str) -> DataFrame:
    """Which segment the lines of a customer version count for.

    ``current``: versions valid today only, so lines sold under a former version are left
    out. ``as_was``: the segment at order time. ``as_is``: all lines under today's segment.
    """
    if mode not in SEGMENT_MODES:
        raise ValueError(f"mode must be one of {', '.join(SEGMENT_MODES)}")
    if mode == "current":
        dim_customer = dim_customer.filter("is_current")
    segment = F.col("customer_segment")
    if mode == "as_is":
        today = F.when(F.col("is_current"), segment)
        segment = F.max(today).over(W.partitionBy("customer_id"))
    return dim_customer.select("customer_key", segment.alias("customer_segment"))


def segment_kpi(fact: DataFrame, dim_customer: DataFrame, mode: str = "current") -> DataFrame:
    """Sales, profit and mean profit ratio of a line per customer segment.

    Ratios count with fifteen decimals. If a segment holds one that no such decimal can hold, such
    as an infinite one, its ratios are added up as doubles instead.
    """
    exact = F.col("order_item_profit_ratio").try_cast(EXACT_RATIO)
    per_customer = fact.groupBy("customer_key").agg(
        F.sum("sales").alias("sales"),
        F.sum("profit_per_order").alias("profit"),
        F.try_sum(exact).alias("ratio"),
        F.sum("order_item_profit_ratio").alias("rough_ratio"),
        F.count(exact).alias("exact"),
        F.count("order_item_profit_ratio").alias("rated"),
    )
    lost = (F.col("exact") < F.col("rated")) | (F.col("ratio").isNull() & (F.col("rated") > 0))
    ratio = F.when(F.count_if(lost) == 0, F.try_sum("ratio").cast("double"))
    ratio = F.coalesce(ratio, F.sum("rough_ratio"))
    return (
        per_customer.join(segment_of_key(dim_customer, mode), "customer_key")
        .groupBy("customer_segment")
        .agg(
            F.round(F.sum("sales"), 2).alias("total_sales"),
            F.round(F.sum("profit"), 2).alias("total_profit"),
            F.round(F.try_divide(ratio, F.sum("rated")), 3).alias("avg_profit_ratio"),
        )
    )


MARKET_SUMMARY = """
WITH places AS (
  SELECT geo_key,
         count(*)                  AS line_count,
         count(late_delivery_risk) AS rated,
         sum(late_delivery_risk)   AS late,
         sum(sales)                AS sales
  FROM IDENTIFIER(:fact)
  WHERE geo_key IS NOT NULL
  GROUP BY geo_key
)
SELECT market,
       sum(line_count)                                      AS orders,
       round(1 - try_divide(sum(late), sum(rated)), :places) AS on_time_rate,
       round(sum(sales), 0)                                 AS total_sales
FROM places JOIN IDENTIFIER(:dim_geo) USING (geo_key)
GROUP BY market
ORDER BY total_sales DESC
"""


def market_summary(spark: SparkSession, fact: str, dim_geo: str) -> DataFrame:
    """The closing check in SQL: lines, on-time rate and sales per market, best market first."""
    return spark.sql(MARKET_SUMMARY, {"fact": fact, "dim_geo": dim_geo, "places": 3})
