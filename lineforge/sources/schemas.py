"""Names and types of the flat order lines."""

from __future__ import annotations

from pyspark.sql import types as T

ID = T.LongType()
COUNT = T.IntegerType()
TEXT = T.StringType()
RATIO = T.DoubleType()
MONEY = T.DecimalType(18, 2)
FINE_MONEY = T.DecimalType(18, 4)
RATE = T.DecimalType(4, 2)

# Name and type of every column that the pipeline uses, in file order.
LINE_COLUMNS = (
    ("order_item_id", ID),
    ("order_id", ID),
    ("order_date_dateorders", TEXT),
    ("shipping_date_dateorders", TEXT),
    ("days_for_shipping_real", COUNT),
    ("days_for_shipment_scheduled", COUNT),
    ("late_delivery_risk", COUNT),
    ("delivery_status", TEXT),
    ("order_status", TEXT),
    ("shipping_mode", TEXT),
    ("sales", MONEY),
    ("order_item_quantity", COUNT),
    ("order_item_discount", FINE_MONEY),
    ("order_item_discount_rate", RATE),
    ("order_item_profit_ratio", RATIO),
    ("order_profit_per_order", FINE_MONEY),
    ("benefit_per_order", FINE_MONEY),
    ("order_item_total", FINE_MONEY),
    ("customer_id", ID),
    ("customer_fname", TEXT),
    ("customer_lname", TEXT),
    ("customer_segment", TEXT),
    ("customer_city", TEXT),
    ("customer_state", TEXT),
    ("customer_country", TEXT),
    ("customer_zipcode", TEXT),
    ("product_card_id", ID),
    ("product_name", TEXT),
    ("category_id", COUNT),
    ("category_name", TEXT),
    ("department_id", COUNT),
    ("department_name", TEXT),
    ("product_price", MONEY),
    ("market", TEXT),
    ("order_region", TEXT),
    ("order_country", TEXT),
    ("order_state", TEXT),
    ("order_city", TEXT),
    ("customer_email", TEXT),
    ("customer_password", TEXT),
    ("product_description", TEXT),
    ("product_status", COUNT),
    ("product_image", TEXT),
)

# The view over the order tables, with the column that tells copies of a line apart.
LINE_SCHEMA = T.StructType([T.StructField(*column) for column in (*LINE_COLUMNS, ("tie_suppkey", ID))])

# The public source file writes amounts with up to nine decimals. As decimals they keep them,
# and their sums do not depend on the order of the rows. There is room for sixteen digits before
# the point and twelve after it; silver lists an amount beyond that as a fault.
FILE_AMOUNT = T.DecimalType(28, 12)
FILE_SCHEMA = T.StructType(
    [
        T.StructField(name, FILE_AMOUNT if isinstance(kind, T.DecimalType) else kind)
        for name, kind in LINE_COLUMNS
    ]
)
