"""A file in the style of the public source, through the whole lakehouse with default settings."""

import csv
import datetime as dt
from decimal import Decimal

import pytest

from lineforge.plans.kpi import market_summary
from lineforge.plans.lakehouse import Lakehouse

HEADER = [
    "Type", "Days for shipping (real)", "Days for shipment (scheduled)", "Benefit per order",
    "Delivery Status", "Late_delivery_risk", "Category Id", "Category Name", "Customer City",
    "Customer Country", "Customer Email", "Customer Fname", "Customer Id", "Customer Lname",
    "Customer Password", "Customer Segment", "Customer State", "Customer Zipcode", "Department Id",
    "Department Name", "Latitude", "Market", "Order City", "Order Country", "order date (DateOrders)",
    "Order Id", "Order Item Discount", "Order Item Discount Rate", "Order Item Id",
    "Order Item Profit Ratio", "Order Item Quantity", "Sales", "Order Item Total",
    "Order Profit Per Order", "Order Region", "Order State", "Order Status", "Product Card Id",
    "Product Description", "Product Image", "Product Name", "Product Price", "Product Status",
    "shipping date (DateOrders)", "Shipping Mode",
]


def _line(item, customer, segment, day, market, late, real, sales, profit, state="São Paulo"):
    values = dict.fromkeys(HEADER, "")
    values |= {
        "Type": "DEBIT", "Order Item Id": item, "Order Id": item // 10, "Customer Id": customer,
        "Customer Segment": segment, "Customer Fname": "José", "Customer Zipcode": "00725",
        "Customer Email": "XXXXXXXXX", "Customer Password": "XXXXXXXXX", "Product Status": 0,
        "order date (DateOrders)": day, "shipping date (DateOrders)": "2/3/2018 22:56",
        "Market": market, "Order Region": "South", "Order Country": "Brasil", "Order City": "Osório",
        "Order State": state, "Late_delivery_risk": late, "Days for shipping (real)": real,
        "Days for shipment (scheduled)": 2, "Sales": sales, "Order Profit Per Order": profit,
        "Benefit per order": profit, "Order Item Quantity": 1, "Order Item Discount": "13.10999966",
        "Order Item Total": "314.6400146", "Order Item Discount Rate": "0.039999999",
        "Order Item Profit Ratio": "0.25", "Product Card Id": 1360, "Product Name": "Smart watch ",
        "Category Id": 73, "Category Name": "Sporting Goods", "Department Id": 2,
        "Department Name": "Fitness", "Product Price": "327.75", "Latitude": "18.2514534",
        "Shipping Mode": "Standard Class", "Delivery Status": "Advance shipping",
        "Order Status": "COMPLETE",
    }
    return [values[name] for name in HEADER]


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("public") / "orders.csv"
    with open(path, "w", encoding="latin-1", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(HEADER)
        writer.writerows(
            [
                _line(11, 20, "Corporate", "5/31/2017 10:00", "LATAM", 1, 4, "100.10", "10"),
                _line(12, 20, "Corporate", "6/1/2017 0:00", "LATAM", 0, 2, "200.20", "-5.5"),
                _line(21, 7, "Home Office", "1/31/2018 22:56", "Europe", 0, 1, "300.30", "3"),
                _line(22, 40, "Consumer", "1/1/2016 9:05", "Europe", 1, 6, "400.40", "4", state=""),
                _line(12, 20, "Corporate", "6/1/2017 0:00", "LATAM", 0, 2, "200.20", "-5.5"),
                _line(31, 7, "Home Office", "2018-01-31", "LATAM", 0, 2, "500.50", "5"),
            ]
        )
    location = str(tmp_path_factory.mktemp("lake"))
    built = Lakehouse.from_csv(spark, str(path), "public", location=location)
    built.build()
    return built


def test_bronze_keeps_every_column_and_value(lake):
    bronze = lake.bronze()
    assert len(bronze.columns) == len(HEADER) + 3
    row = bronze.filter("order_item_id = 11").first()
    assert row.order_item_discount == "13.10999966" and row.latitude == "18.2514534"
    assert row.customer_fname == "José" and row.order_state == "São Paulo"
    assert row.customer_zipcode == "00725"


def test_silver(lake):
    silver = lake.silver()
    assert silver.count() == 5
    assert silver.filter("order_item_id = 11").first().order_item_discount == Decimal("13.10999966")
    assert {"type", "latitude", "order_ts", "ship_date"} <= set(silver.columns)
    assert not {"customer_email", "product_image", "order_date_dateorders"} & set(silver.columns)
    assert [r._faults for r in lake.table("silver.rejected_lines").collect()] == ["order_date_dateorders"]


def test_customer_versions(lake):
    rows = lake.gold("dim_customer").orderBy("customer_key").collect()
    day = dt.date
    assert [(r.customer_key, r.customer_id, r.customer_segment, r.start_date, r.end_date) for r in rows] == [
        (1, 7, "Home Office", day(2000, 1, 1), day(9999, 12, 31)),
        (2, 20, "Consumer", day(2000, 1, 1), day(2017, 5, 31)),
        (3, 20, "Corporate", day(2017, 6, 1), day(9999, 12, 31)),
        (4, 40, "Consumer", day(2000, 1, 1), day(9999, 12, 31)),
    ]


def test_fact_keys(lake):
    rows = {r.order_item_id: r for r in lake.fact().collect()}
    assert {item: r.customer_key for item, r in rows.items()} == {11: 2, 12: 3, 21: 1, 22: 4, 31: None}
    assert rows[22].geo_key is None and rows[11].geo_key is not None
    assert (rows[21].order_date_key, rows[21].ship_date_key) == (20180131, 20180203)
    assert rows[31].order_date_key is None


def test_reports(lake, spark):
    delivery = {r.market: r[1:] for r in lake.gold("kpi_delivery_by_market").collect()}
    assert delivery == {"LATAM": (3, 0.667, 0.67), "Europe": (1, 1.0, -1.0)}
    sales = {r.customer_segment: r.total_sales for r in lake.gold("kpi_sales_by_segment").collect()}
    assert sales == {
        "Home Office": Decimal("300.30"), "Corporate": Decimal("200.20"), "Consumer": Decimal("400.40"),
    }
    summary = market_summary(spark, lake.name("gold.fact_order_line"), lake.name("gold.dim_geo"))
    assert [(r.market, r.orders, r.total_sales) for r in summary.collect()] == [
        ("LATAM", 3, Decimal(801)), ("Europe", 1, Decimal(300)),
    ]


def test_refresh_reads_new_files(spark, tmp_path):
    def write(name, *lines):
        with open(tmp_path / name, "w", encoding="latin-1", newline="") as out:
            csv.writer(out).writerows([HEADER, *lines])

    write("a.csv", _line(11, 7, "Consumer", "1/1/2018 1:00", "LATAM", 0, 2, "1", "1"))
    built = Lakehouse.from_csv(spark, f"{tmp_path}/*.csv", "growing", location=f"{tmp_path}/lake")
    assert built.fact().count() == 1
    write("b.csv", _line(12, 8, "Consumer", "1/2/2018 1:00", "Europe", 0, 2, "1", "1"))
    assert built.fact().count() == 1
    built.refresh()
    assert built.build()["gold.fact_order_line"] == 2
    assert built.gold("dim_geo").count() == 2
    built.drop()


def test_no_value_is_lost_without_being_listed(spark, tmp_path):
    """Texts that no type holds, too many or few fields, and a record cut by a line break."""
    def line(item, **changes):
        values = dict(zip(HEADER, map(str, _line(item, 7, "Consumer", "1/1/2018 1:00", "LATAM", 0, 2, "1", "1"))))
        return [(values | changes)[name] for name in HEADER]

    rows = [
        line(1, **{"Sales": "1500000000.25", "Order Item Total": "1.12345678987"}),
        line(2, **{"Sales": "n/a"}),
        line(3, **{"Order Item Quantity": "2.0"}),
        line(4) + ["surplus"],
        line(5, **{"Order Item Id": "5x"}),
        line(6)[:-1],
        line(7, **{"Sales": "0.1234567890123", "Order Item Total": "12345678901234567", "Product Price": "1e-20"}),
        line(8, **{"Sales": " ", "Product Price": "1.5E2", "Order Item Quantity": " 3 "}),
        line(9, **{"Product Name": "cut\nhere"}),
    ]
    with open(tmp_path / "a.csv", "w", encoding="latin-1", newline="") as out:
        csv.writer(out, lineterminator="\n").writerows([HEADER, *rows])
    built = Lakehouse.from_csv(spark, f"{tmp_path}/a.csv", "faulty", location=f"{tmp_path}/lake")
    silver = {r.order_item_id: r for r in built.silver().collect()}
    assert set(silver) == {1, 2, 3, 7, 8}
    assert silver[1].sales == Decimal("1500000000.25") and silver[1].order_item_total == Decimal("1.12345678987")
    assert silver[2].sales is None and silver[3].order_item_quantity is None
    assert silver[8].sales is None and silver[8].product_price == 150 and silver[8].order_item_quantity == 3
    listed = built.table("silver.rejected_lines").collect()
    faults = {r.order_item_id: r for r in listed if not r._malformed}
    assert {item: r._faults for item, r in faults.items()} == {
        "2": "sales", "3": "order_item_quantity", "5x": "order_item_id",
        "7": "sales,order_item_total,product_price",
    }
    assert faults["2"].sales == "n/a" and faults["3"].order_item_quantity == "2.0"
    broken = [r._malformed for r in listed if r._malformed]
    assert all(r._faults.startswith("_malformed") for r in listed if r._malformed)
    assert len(broken) == 4 and any(text.endswith("surplus") for text in broken)
    built.drop()
