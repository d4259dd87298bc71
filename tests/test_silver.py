import pytest
from pyspark.sql import functions as F

from pyspark.sql import types as T

from conftest import same_rows
from lineforge.functions import casts
from lineforge.plans import silver
from lineforge.plans.silver import clean_orders
from lineforge.settings import Settings

COLUMNS = (
    "order_item_id long, order_date_dateorders string, shipping_date_dateorders string, "
    "sales int, customer_email string, _ingested_at timestamp, other string"
)
SETTINGS = Settings(tie_break=("ship_ts",))


@pytest.fixture
def bronze(spark):
    rows = [
        (1, "1/31/2018 22:56", "2/3/2018 22:56", 10, "XXXX", None, "late copy"),
        (1, "1/31/2018 22:56", "2/2/2018 22:56", 11, "XXXX", None, "first copy"),
        (2, "2018-01-31", "2/2/2018 1:00", 20, "XXXX", None, "bad date"),
        (3, None, "", 30, "XXXX", None, "no dates"),
        (None, "1/1/2018 1:00", "1/2/2018 1:00", 40, "XXXX", None, "no id"),
        (None, "oops", "1/2/2018 1:00", 41, "XXXX", None, "no id, bad date"),
    ]
    return spark.createDataFrame(rows, COLUMNS)


def test_clean_rows(bronze):
    clean, _ = clean_orders(bronze, SETTINGS)
    assert clean.columns == [
        "order_item_id", "sales", "other", "order_ts", "ship_ts", "order_date", "ship_date",
    ]
    rows = {r.order_item_id: r for r in clean.collect()}
    assert set(rows) == {1, 2, 3}
    assert rows[1].other == "first copy" and str(rows[1].ship_date) == "2018-02-02"
    assert rows[2].order_ts is None and rows[2].order_date is None and rows[2].ship_ts is not None
    assert rows[3].order_ts is None and rows[3].ship_ts is None
    assert dict(clean.dtypes)["order_ts"] == "timestamp_ntz"


def test_rejects_name_the_columns_at_fault(bronze):
    _, rejected = clean_orders(bronze, SETTINGS)
    faults = {r.other: r._faults for r in rejected.collect()}
    assert faults == {
        "bad date": "order_date_dateorders",
        "no id": "order_item_id",
        "no id, bad date": "order_item_id,order_date_dateorders",
    }


def test_survivor_does_not_depend_on_partitioning(spark, lake):
    bronze = lake.bronze()
    once, _ = clean_orders(bronze.repartition(3, "sales"), lake.settings)
    again, _ = clean_orders(bronze.repartition(5, "order_city"), lake.settings)
    assert same_rows(once, again)


def test_hot_order_line_leaves_each_map_task_once(spark):
    """A third of the rows under one id: the shuffle carries it once per map task."""
    rows = spark.range(30_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("order_item_id"),
        F.lit("1/1/2018 1:00").alias("order_date_dateorders"),
        F.lit("1/2/2018 1:00").alias("shipping_date_dateorders"),
        F.col("id").alias("sales"),
    )
    clean, _ = clean_orders(rows, Settings())
    assert clean.count() == 20_001
    assert clean.filter("order_item_id = 0").first().sales == 0
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert plan.index("[min(") < plan.index("Exchange hashpartitioning") < plan.index("partial_min") < plan.index("LeftSemi")


@pytest.mark.parametrize("kind", ["int", "long", "decimal(6,2)", "decimal(2,2)", "double", "float", "boolean"])
def test_plain_numbers_are_settled_as_the_others_are(spark, kind):
    """By one pattern, with what a cast and its digits would say."""
    given = [None, "", " ", "0", "-0", "7", "-12", "007", "12.5", "1234.56", "12345.6", "12.345", "1e3", "5.", ".5", " 5 ", "5\n", "x",
             "123456789", "9999999999", "1234567890123456789", "0.1", "12345678.1234567", "123.456", "0.0000001", "NaN", "1,5"]
    texts = spark.createDataFrame([(t,) for t in given], "t string").repartition(1)
    kind = T._parse_datatype_string(kind)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(casts, "_plain", lambda text, kind: F.lit(False))
        slow = texts.select("t", casts.unfit(F.col("t"), kind).alias("lost"))
    fast = texts.select("t", casts.unfit(F.col("t"), kind).alias("lost"))
    assert same_rows(fast, slow)
    names = texts.select(casts._plain(F.col("t"), kind).alias("p")).where("p").count()
    assert names >= 3 or str(kind) in ("DecimalType(2,2)", "BooleanType()")


def test_faults_are_named_once(bronze):
    """The text of the names says whether there are any; no condition is worked out a second time."""
    marked = bronze.select(silver._faults(bronze, SETTINGS).alias("f"))
    plan = marked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("isnull(order_item_id") == 1


def test_rows_at_fault_are_found_and_named_by_one_evaluation(bronze):
    rejected = silver.rejected_orders(bronze, SETTINGS)
    plan = rejected._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("isnull(order_item_id") == 1
    assert rejected.columns == [*bronze.columns, "_faults"] and rejected.count() == 3


def test_whole_numbers_need_no_pattern_and_long_doubles_one(spark):
    given = [("0.30000000000000004", True), ("-1.25E-5", True), ("0.300000000000000045", False), ("1e400", False)]
    texts = spark.createDataFrame(given, "t string, fits boolean")
    assert texts.where(casts.unfit(F.col("t"), T.DoubleType()) == F.col("fits")).isEmpty()
    plan = texts.select(casts.unfit(F.col("t"), T.IntegerType()))._jdf.queryExecution().optimizedPlan().toString()
    assert "[0-9]" not in plan
