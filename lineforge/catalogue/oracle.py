"""The registered queries in ANSI-style SQL for an independent engine.

Written from the definitions in FIXTURES.md, not from the DataFrame code: it numbers with
global windows, deduplicates with ``row_number`` and joins the fact line by line.
"""

from __future__ import annotations

from lineforge.settings import JUNK_COLUMNS
from lineforge.sources.schemas import LINE_SCHEMA

RAW = """
lines AS (
  SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS x_sales,
         CAST(l_discount AS DECIMAL(4,2)) AS x_rate,
         CAST(p_retailprice AS DECIMAL(18,2)) AS x_price,
         CAST(l_quantity AS INTEGER) AS x_units,
         CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS x_real,
         CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS x_planned
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
),
amounts AS (
  SELECT *, CAST(x_sales * (1 - x_rate) AS DECIMAL(18,4)) AS x_total,
         CAST(x_sales * (1 - x_rate) - x_units * x_price AS DECIMAL(18,4)) AS x_profit
  FROM lines
),
raw AS (
  SELECT l_orderkey * 10 + l_linenumber AS order_item_id,
         l_orderkey AS order_id,
         strftime(o_orderdate, '%-m/%-d/%Y %-H:%M') AS order_date_dateorders,
         strftime(l_shipdate, '%-m/%-d/%Y %-H:%M') AS shipping_date_dateorders,
         x_real AS days_for_shipping_real,
         x_planned AS days_for_shipment_scheduled,
         CAST(CASE WHEN x_real > x_planned THEN 1 ELSE 0 END AS INTEGER) AS late_delivery_risk,
         l_linestatus AS delivery_status,
         o_orderstatus AS order_status,
         o_orderpriority AS shipping_mode,
         x_sales AS sales,
         x_units AS order_item_quantity,
         CAST(x_sales * x_rate AS DECIMAL(18,4)) AS order_item_discount,
         x_rate AS order_item_discount_rate,
         CAST(x_profit AS DOUBLE) / nullif(CAST(x_total AS DOUBLE), 0) AS order_item_profit_ratio,
         x_profit AS order_profit_per_order,
         x_profit AS benefit_per_order,
         x_total AS order_item_total,
         o_custkey AS customer_id,
         c_name AS customer_fname,
         CAST(NULL AS VARCHAR) AS customer_lname,
         c_mktsegment AS customer_segment,
         'CITY_' || (c_custkey % 40) AS customer_city,
         'STATE_' || (c_custkey % 8) AS customer_state,
         n_name AS customer_country,
         lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS customer_zipcode,
         l_partkey AS product_card_id,
         p_name AS product_name,
         p_size AS category_id,
         p_type AS category_name,
         CAST(substring(p_brand, 7) AS INTEGER) AS department_id,
         p_brand AS department_name,
         x_price AS product_price,
         r_name AS market,
         r_name || '-' || (n_nationkey % 2) AS order_region,
         n_name AS order_country,
         CASE WHEN n_nationkey % 7 = 3 THEN NULL ELSE 'STATE_' || (c_custkey % 8) END AS order_state,
         'CITY_' || (c_custkey % 40) AS order_city,
         'XXXX' AS customer_email,
         'XXXX' AS customer_password,
         CAST(NULL AS VARCHAR) AS product_description,
         CAST(0 AS INTEGER) AS product_status,
         p_name AS product_image,
         l_suppkey AS tie_suppkey
  FROM amounts
)"""

SILVER = """
parsed AS (
  SELECT *, strptime(order_date_dateorders, '%m/%d/%Y %H:%M') AS order_ts,
         strptime(shipping_date_dateorders, '%m/%d/%Y %H:%M') AS ship_ts
  FROM raw
),
ranked AS (
  SELECT *, CAST(order_ts AS DATE) AS order_date, CAST(ship_ts AS DATE) AS ship_date,
         row_number() OVER (
           PARTITION BY order_item_id
           ORDER BY ship_ts NULLS FIRST, product_card_id NULLS FIRST, tie_suppkey NULLS FIRST,
                    order_item_quantity NULLS FIRST, sales NULLS FIRST,
                    order_item_discount_rate NULLS FIRST) AS copy_no
  FROM parsed
),
silver AS (SELECT * FROM ranked WHERE copy_no = 1)"""

PRODUCT = """
product_copies AS (
  SELECT product_card_id, product_name, category_id, category_name, department_id,
         department_name, product_price,
         row_number() OVER (PARTITION BY product_card_id ORDER BY order_item_id) AS copy_no
  FROM silver
),
dim_product AS (
  SELECT product_card_id, product_name, category_id, category_name, department_id,
         department_name, product_price,
         CAST(row_number() OVER (ORDER BY product_card_id NULLS FIRST) AS INTEGER) AS product_key
  FROM product_copies WHERE copy_no = 1
)"""

GEO = """
places AS (
  SELECT DISTINCT market, order_region, order_country, order_state, order_city FROM silver
),
dim_geo AS (
  SELECT *, CAST(row_number() OVER (
           ORDER BY market NULLS FIRST, order_region NULLS FIRST, order_country NULLS FIRST,
                    order_state NULLS FIRST, order_city NULLS FIRST) AS INTEGER) AS geo_key
  FROM places
)"""

SHIPPING = """
modes AS (SELECT DISTINCT shipping_mode FROM silver),
dim_shipping_mode AS (
  SELECT shipping_mode,
         CAST(row_number() OVER (ORDER BY shipping_mode NULLS FIRST) AS INTEGER) AS shipping_mode_key
  FROM modes
)"""

DATES = """
bounds AS (
  SELECT min(order_date) AS d_min, greatest(max(order_date), max(ship_date)) AS d_max FROM silver
),
days AS (
  SELECT CAST(unnest(generate_series(CAST(d_min AS TIMESTAMP), CAST(d_max AS TIMESTAMP),
                                     INTERVAL 1 DAY)) AS DATE) AS full_date
  FROM bounds
),
dim_date AS (
  SELECT full_date,
         CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key,
         CAST(year(full_date) AS INTEGER) AS year,
         CAST(quarter(full_date) AS INTEGER) AS quarter,
         CAST(month(full_date) AS INTEGER) AS month,
         dayname(full_date) AS day_of_week,
         dayofweek(full_date) IN (0, 6) AS is_weekend
  FROM days
)"""

CUSTOMER = """
customer_lines AS (
  SELECT customer_id, customer_fname, customer_lname, customer_segment, customer_city,
         customer_state, customer_country, customer_zipcode,
         row_number() OVER (PARTITION BY customer_id
                            ORDER BY order_ts DESC NULLS LAST, order_item_id) AS line_no
  FROM silver
),
latest AS (SELECT * EXCLUDE (line_no) FROM customer_lines WHERE line_no = 1),
marked AS (
  SELECT *, (customer_id % 20 = 0 AND customer_segment <> 'BUILDING') AS is_changed FROM latest
),
current_rows AS (
  SELECT * EXCLUDE (is_changed),
         CASE WHEN is_changed THEN DATE '1998-06-01' ELSE DATE '1990-01-01' END AS start_date,
         DATE '9999-12-31' AS end_date, TRUE AS is_current
  FROM marked
),
history_rows AS (
  SELECT * EXCLUDE (is_changed) REPLACE ('BUILDING' AS customer_segment),
         DATE '1990-01-01' AS start_date, DATE '1998-05-31' AS end_date, FALSE AS is_current
  FROM marked WHERE is_changed
),
versions AS (
  SELECT * FROM current_rows UNION ALL BY NAME SELECT * FROM history_rows
),
dim_customer AS (
  SELECT *, CAST(row_number() OVER (ORDER BY customer_id NULLS FIRST, start_date) AS INTEGER)
            AS customer_key
  FROM versions
)"""

MODES = """
observed AS (
  SELECT customer_id, order_date, shipping_mode,
         row_number() OVER (PARTITION BY customer_id, order_date ORDER BY order_item_id DESC) AS line_no
  FROM silver WHERE order_date IS NOT NULL
  QUALIFY line_no = 1
),
previous AS (
  SELECT o.customer_id, o.order_date, max(p.order_date) AS day_before
  FROM observed o LEFT JOIN observed p ON p.customer_id = o.customer_id AND p.order_date < o.order_date
  GROUP BY o.customer_id, o.order_date
),
starts AS (
  SELECT o.customer_id, o.shipping_mode, o.order_date AS start_date
  FROM observed o JOIN previous USING (customer_id, order_date)
  LEFT JOIN observed p ON p.customer_id = o.customer_id AND p.order_date = day_before
  WHERE day_before IS NULL OR o.shipping_mode IS DISTINCT FROM p.shipping_mode
),
ends AS (
  SELECT s.customer_id, s.shipping_mode, s.start_date,
         CAST(coalesce(min(n.start_date) - 1, DATE '9999-12-31') AS DATE) AS end_date, min(n.start_date) IS NULL AS is_current
  FROM starts s LEFT JOIN starts n ON n.customer_id = s.customer_id AND n.start_date > s.start_date
  GROUP BY s.customer_id, s.shipping_mode, s.start_date
),
mode_versions AS (
  SELECT e.customer_id, e.shipping_mode, start_date, end_date, is_current, max(o.order_date) AS last_seen
  FROM ends e JOIN observed o ON o.customer_id = e.customer_id AND o.order_date BETWEEN start_date AND end_date
  GROUP BY e.customer_id, e.shipping_mode, start_date, end_date, is_current
)"""

FACT = """
fact AS (
  SELECT s.order_item_id, s.order_id, c.customer_key, p.product_key, g.geo_key,
         m.shipping_mode_key, od.date_key AS order_date_key, sd.date_key AS ship_date_key,
         s.sales, s.order_item_quantity AS quantity, s.order_item_discount,
         s.order_item_discount_rate, s.order_item_profit_ratio,
         s.order_profit_per_order AS profit_per_order, s.benefit_per_order, s.order_item_total,
         s.days_for_shipping_real AS days_ship_real,
         s.days_for_shipment_scheduled AS days_ship_scheduled,
         s.late_delivery_risk, s.delivery_status, s.order_status
  FROM silver s
  LEFT JOIN dim_customer c ON s.customer_id = c.customer_id
    AND s.order_date BETWEEN c.start_date AND c.end_date
  LEFT JOIN dim_product p ON s.product_card_id = p.product_card_id
  LEFT JOIN dim_geo g ON s.market = g.market AND s.order_region = g.order_region
    AND s.order_country = g.order_country AND s.order_state = g.order_state
    AND s.order_city = g.order_city
  LEFT JOIN dim_shipping_mode m ON s.shipping_mode = m.shipping_mode
  LEFT JOIN dim_date od ON s.order_date = od.full_date
  LEFT JOIN dim_date sd ON s.ship_date = sd.full_date
)"""

STAR = (RAW, SILVER, PRODUCT, GEO, SHIPPING, DATES, CUSTOMER, FACT)

FACT_LIST = """order_item_id, order_id, customer_key, product_key, geo_key, shipping_mode_key,
  order_date_key, ship_date_key, CAST(sales AS DOUBLE) AS sales, quantity,
  CAST(order_item_discount AS DOUBLE) AS order_item_discount,
  CAST(order_item_discount_rate AS DOUBLE) AS order_item_discount_rate, order_item_profit_ratio,
  CAST(profit_per_order AS DOUBLE) AS profit_per_order,
  CAST(benefit_per_order AS DOUBLE) AS benefit_per_order,
  CAST(order_item_total AS DOUBLE) AS order_item_total, days_ship_real, days_ship_scheduled,
  late_delivery_risk, delivery_status, order_status"""

RAW_DECIMALS = """CAST(sales AS DOUBLE) AS sales,
  CAST(order_item_discount AS DOUBLE) AS order_item_discount,
  CAST(order_item_discount_rate AS DOUBLE) AS order_item_discount_rate,
  CAST(order_profit_per_order AS DOUBLE) AS order_profit_per_order,
  CAST(benefit_per_order AS DOUBLE) AS benefit_per_order,
  CAST(order_item_total AS DOUBLE) AS order_item_total,
  CAST(product_price AS DOUBLE) AS product_price"""

KPI_DELIVERY = """
SELECT market, count(*) AS total_orders,
       round(1 - avg(late_delivery_risk), 3) AS on_time_rate,
       round(avg(days_ship_real - days_ship_scheduled), 2) AS avg_delay_days
FROM fact JOIN dim_geo USING (geo_key) GROUP BY market"""

KPI_LIST = """CAST(round(sum(sales), 2) AS DOUBLE) AS total_sales,
       CAST(round(sum(profit_per_order), 2) AS DOUBLE) AS total_profit,
       round(avg(order_item_profit_ratio), 3) AS avg_profit_ratio"""

KPI_CURRENT = f"""
SELECT customer_segment, {KPI_LIST}
FROM fact JOIN (SELECT * FROM dim_customer WHERE is_current) d USING (customer_key)
GROUP BY customer_segment"""


def _with(parts: tuple[str, ...], select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select.strip()


def _raw(select: str) -> str:
    return _with((RAW,), select)


def _silver(select: str, *parts: str) -> str:
    return _with((RAW, SILVER, *parts), select)


def _star(select: str) -> str:
    return _with(STAR, select)


def _margin(level: str, dimension: str, key: str) -> str:
    return f"""
    SELECT {level}, CAST(sum(sales) AS DOUBLE) AS total_sales,
           CAST(sum(profit_per_order) AS DOUBLE) AS total_profit,
           CAST(sum(profit_per_order) AS DOUBLE) / CAST(sum(sales) AS DOUBLE) AS margin
    FROM fact JOIN {dimension} USING ({key}) GROUP BY {level}"""


def _late(level: str, dimension: str, key: str) -> str:
    return f"""
    SELECT {level}, count(*) AS lines, avg(late_delivery_risk) AS late_rate
    FROM fact JOIN {dimension} USING ({key}) GROUP BY {level}"""


def _top(column: str, by: str, as_double: bool) -> str:
    total = f"sum({column})"
    shown = f"CAST({total} AS {'DOUBLE' if as_double else 'BIGINT'})"
    return f"""
    SELECT product_card_id, product_name, {shown} AS {by}
    FROM fact JOIN dim_product USING (product_key)
    GROUP BY product_card_id, product_name
    ORDER BY {total} DESC, product_card_id LIMIT 10"""


def _table_counts(tables: dict[str, str], with_layer: bool) -> str:
    rows = []
    for name, relation in tables.items():
        layer, _, short = name.partition(".")
        prefix = f"'{layer}' AS layer, " if with_layer else ""
        rows.append(f"SELECT {prefix}'{short}' AS table_name, count(*) AS n_rows FROM {relation}")
    return "\nUNION ALL ".join(rows)


_GOLD = {
    "gold.fact_order_line": "fact",
    "gold.dim_customer": "dim_customer",
    "gold.dim_product": "dim_product",
    "gold.dim_geo": "dim_geo",
    "gold.dim_shipping_mode": "dim_shipping_mode",
    "gold.dim_date": "dim_date",
    "gold.kpi_delivery_by_market": f"({KPI_DELIVERY}) d",
    "gold.kpi_sales_by_segment": f"({KPI_CURRENT}) s",
}
_LAYERS = {"bronze.order_lines": "raw", "silver.order_lines": "silver", **_GOLD}


def _key_check(dimension: str) -> str:
    return f"""SELECT '{dimension}' AS dimension, count(*) AS total_rows,
      CAST(0 AS BIGINT) AS difference_rows FROM {dimension}"""


def oracle_sql() -> dict[str, str]:
    constants = "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS non_null_rows, "
        f"count(DISTINCT {c}) <= 1 AS is_constant FROM raw"
        for c in LINE_SCHEMA.names
    )
    keyed = ("dim_product", "dim_geo", "dim_shipping_mode", "dim_customer")
    return {
        "csv_ingest": _raw(
            f"SELECT * REPLACE ({RAW_DECIMALS}), TRUE AS has_source_file FROM raw"
        ),
        "csv_ingest_faults": _raw(
            """SELECT * FROM (
                 SELECT order_item_id || CASE WHEN order_item_id % 13 = 3 THEN 'x' ELSE '' END
                          AS order_item_id,
                        CAST(order_id AS VARCHAR) AS order_id,
                        CASE order_item_id % 7 WHEN 1 THEN 'n/a' WHEN 2 THEN sales || '1'
                             ELSE CAST(sales AS VARCHAR) END AS sales,
                        order_item_quantity || CASE WHEN order_item_id % 11 = 2 THEN '.0' ELSE '' END
                          AS order_item_quantity,
                        CASE order_item_id % 17 WHEN 0 THEN '1e400' WHEN 1 THEN '0.1234567890123456789'
                             WHEN 2 THEN 'NaN' WHEN 3 THEN '1e-400' END AS spoilt_ratio,
                        concat_ws(',',
                          CASE WHEN order_item_id % 13 = 3 THEN 'order_item_id' END,
                          CASE WHEN order_item_id % 7 IN (1, 2) THEN 'sales' END,
                          CASE WHEN order_item_id % 11 = 2 THEN 'order_item_quantity' END,
                          CASE WHEN order_item_id % 17 < 4 THEN 'order_item_profit_ratio' END) AS faults
                 FROM raw)
               WHERE faults <> ''"""
        ),
        "date_parse": _with(
            (RAW, SILVER),
            """SELECT order_item_id, order_ts, ship_ts, CAST(order_ts AS DATE) AS order_date,
               CAST(ship_ts AS DATE) AS ship_date FROM parsed""",
        ),
        "table_roundtrip": _star(f"SELECT {FACT_LIST} FROM fact"),
        "csv_export_roundtrip": _star(f"SELECT {FACT_LIST} FROM fact"),
        "csv_export_texts": """
    SELECT p_partkey, CASE p_partkey % 9
        WHEN 0 THEN '"' || p_name || '"'
        WHEN 1 THEN p_name || ', "x", ' || p_name
        WHEN 2 THEN 'a' || chr(10) || p_name || chr(10) || '"'
        WHEN 3 THEN p_name || chr(92)
        WHEN 4 THEN chr(92) || '"' || p_name || chr(92) || '",' || chr(10)
        WHEN 5 THEN '  ' || p_name || ' '
        WHEN 6 THEN ''
        WHEN 7 THEN NULL
        ELSE p_name || chr(13) || chr(10) || 'y' END AS note
    FROM part""",
        "csv_export_tables": _star(_table_counts(_GOLD, with_layer=False)),
        "profile_distinct": _raw(
            "SELECT "
            + ", ".join(f"count(DISTINCT {c}) AS {c}" for c in JUNK_COLUMNS)
            + " FROM raw"
        ),
        "profile_constant_columns": _raw(constants),
        "layer_counts": _star(_table_counts(_LAYERS, with_layer=True)),
        "silver_dedup": _silver(
            """SELECT order_item_id, ship_ts, product_card_id, order_item_quantity,
               CAST(sales AS DOUBLE) AS sales,
               CAST(order_item_discount_rate AS DOUBLE) AS order_item_discount_rate FROM silver"""
        ),
        "silver_clean": _silver(
            f"""SELECT * EXCLUDE (copy_no, tie_suppkey, order_date_dateorders,
               shipping_date_dateorders, {", ".join(JUNK_COLUMNS)}) REPLACE ({RAW_DECIMALS})
               FROM silver"""
        ),
        "rejected_lines": _raw(
            """SELECT order_item_id, 'order_item_id' AS faults FROM raw
               WHERE order_item_id IS NULL"""
        ),
        "dim_product": _silver(
            "SELECT * REPLACE (CAST(product_price AS DOUBLE) AS product_price) FROM dim_product",
            PRODUCT,
        ),
        "dim_geo": _silver("SELECT * FROM dim_geo", GEO),
        "dim_shipping_mode": _silver("SELECT * FROM dim_shipping_mode", SHIPPING),
        "date_bounds": _silver("SELECT * FROM bounds", DATES),
        "date_spine": _silver("SELECT * FROM days", DATES),
        "dim_date": _silver("SELECT * FROM dim_date", DATES),
        "dense_key_equivalence": _star("\nUNION ALL ".join(_key_check(d) for d in keyed)),
        "customer_latest": _silver("SELECT * FROM latest", CUSTOMER),
        "scd2_is_changed": _silver(
            "SELECT customer_id, customer_segment, is_changed FROM marked", CUSTOMER
        ),
        "scd2_current_rows": _silver("SELECT * FROM current_rows", CUSTOMER),
        "scd2_history_rows": _silver("SELECT * FROM history_rows", CUSTOMER),
        "scd2_dim": _silver("SELECT * FROM versions", CUSTOMER),
        "scd2_sample": _silver(
            """SELECT customer_id, customer_segment, start_date, end_date FROM dim_customer
               WHERE NOT is_current ORDER BY customer_id, start_date LIMIT 5""",
            CUSTOMER,
        ),
        "dim_customer": _silver("SELECT * FROM dim_customer", CUSTOMER),
        "dim_product_kept_keys": _silver(
            """
            SELECT product_card_id, product_name, early_key,
                   CAST(coalesce(early_key, (SELECT count(DISTINCT product_card_id) FROM silver
                                             WHERE order_date < DATE '1995-06-17')
                        + row_number() OVER (PARTITION BY early_key IS NULL ORDER BY product_card_id)) AS INTEGER) AS product_key
            FROM dim_product LEFT JOIN (
              SELECT product_card_id, CAST(row_number() OVER (ORDER BY product_card_id) AS INTEGER) AS early_key
              FROM (SELECT DISTINCT product_card_id FROM silver WHERE order_date < DATE '1995-06-17')) e
            USING (product_card_id)""",
            PRODUCT,
        ),
        "scd2_from_snapshots": _silver("SELECT * FROM mode_versions", MODES),
        "scd2_merge_snapshots": _silver("SELECT * FROM mode_versions", MODES),
        "temporal_join_versions": _silver(
            """
            SELECT order_item_id, s.customer_id, ship_date, v.shipping_mode AS valid_mode, start_date AS valid_since
            FROM silver s LEFT JOIN mode_versions v
            ON v.customer_id = s.customer_id AND ship_date BETWEEN start_date AND end_date""",
            MODES,
        ),
        "temporal_join_customer": _star("SELECT order_item_id, customer_key FROM fact"),
        "fact_product_fk": _star("SELECT order_item_id, product_key FROM fact"),
        "fact_geo_fk": _star("SELECT order_item_id, geo_key FROM fact"),
        "fact_geo_fk_nullsafe": _silver(
            """SELECT s.order_item_id, g.geo_key FROM silver s LEFT JOIN dim_geo g
               ON s.market IS NOT DISTINCT FROM g.market
               AND s.order_region IS NOT DISTINCT FROM g.order_region
               AND s.order_country IS NOT DISTINCT FROM g.order_country
               AND s.order_state IS NOT DISTINCT FROM g.order_state
               AND s.order_city IS NOT DISTINCT FROM g.order_city""",
            GEO,
        ),
        "fact_shipping_fk": _star("SELECT order_item_id, shipping_mode_key FROM fact"),
        "fact_date_fk": _star("SELECT order_item_id, order_date_key, ship_date_key FROM fact"),
        "fact_order_line": _star(f"SELECT {FACT_LIST} FROM fact"),
        "kpi_delivery_by_market": _star(KPI_DELIVERY + " ORDER BY total_orders DESC"),
        "kpi_sales_by_segment": _star(KPI_CURRENT + " ORDER BY total_sales DESC"),
        "kpi_segment_as_was": _star(
            f"""SELECT customer_segment, {KPI_LIST} FROM fact JOIN dim_customer USING (customer_key)
            GROUP BY customer_segment"""
        ),
        "kpi_segment_as_is": _star(
            f"""SELECT today.customer_segment, {KPI_LIST}
            FROM fact JOIN dim_customer sold USING (customer_key)
            JOIN dim_customer today ON today.customer_id = sold.customer_id AND today.is_current
            GROUP BY today.customer_segment"""
        ),
        "sql_market_summary": _star(
            """SELECT market, count(*) AS orders,
                      round(1 - avg(late_delivery_risk), 3) AS on_time_rate,
                      CAST(round(sum(sales), 0) AS DOUBLE) AS total_sales
               FROM fact JOIN dim_geo USING (geo_key) GROUP BY market ORDER BY total_sales DESC"""
        ),
        "dash_department_share": _star(
            """SELECT department_name, CAST(sum(sales) AS DOUBLE) AS total_sales,
                      CAST(sum(sales) AS DOUBLE) / CAST((SELECT sum(sales) FROM fact) AS DOUBLE)
                        AS sales_share
               FROM fact LEFT JOIN dim_product USING (product_key) GROUP BY department_name"""
        ),
        "dash_top_units": _star(_top("quantity", "units", as_double=False)),
        "dash_top_revenue": _star(_top("sales", "sales", as_double=True)),
        "distinct_keys_by_year": _star(
            "\nUNION ALL ".join(
                f"""SELECT CAST(order_date_key // 10000 AS INTEGER) AS order_year, '{key}' AS column_name,
                           count(DISTINCT {key}) AS n_distinct
                    FROM fact WHERE {key} IS NOT NULL GROUP BY 1"""
                for key in ("customer_key", "product_key", "geo_key", "shipping_mode_key", "ship_date_key")
            )
        ),
        "dash_late_overall": _star(
            "SELECT count(*) AS lines, avg(late_delivery_risk) AS late_rate FROM fact"
        ),
        "dash_late_by_mode": _star(_late("shipping_mode", "dim_shipping_mode", "shipping_mode_key")),
        "dash_late_by_market": _silver(
            """SELECT market, count(*) AS lines, avg(late_delivery_risk) AS late_rate
               FROM silver GROUP BY market"""
        ),
        "dash_late_levels": _silver(
            """SELECT shipping_mode, market, CAST(0 AS BIGINT) AS level, count(*) AS lines, avg(late_delivery_risk) AS late_rate
               FROM silver GROUP BY shipping_mode, market
               UNION ALL SELECT shipping_mode, NULL, 1, count(*), avg(late_delivery_risk) FROM silver GROUP BY shipping_mode
               UNION ALL SELECT NULL, market, 2, count(*), avg(late_delivery_risk) FROM silver GROUP BY market
               UNION ALL SELECT NULL, NULL, 3, count(*), avg(late_delivery_risk) FROM silver"""
        ),
        "dash_unprofitable_share": _star(
            """SELECT count(*) AS lines,
                      avg(CASE WHEN profit_per_order < 0 THEN 1.0 ELSE 0.0 END) AS unprofitable_share
               FROM fact"""
        ),
        "dash_category_margin": _star(_margin("category_name", "dim_product", "product_key")),
        "dash_segment_margin": _star(_margin("customer_segment", "dim_customer", "customer_key")),
        "dash_market_concentration": _silver(
            """SELECT market, CAST(total_sales AS DOUBLE) AS total_sales,
                      CAST(sum(total_sales) OVER (
                        ORDER BY total_sales DESC, market
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
                      / CAST(sum(total_sales) OVER () AS DOUBLE) AS cumulative_share
               FROM (SELECT market, sum(sales) AS total_sales FROM silver GROUP BY market)"""
        ),
    }
