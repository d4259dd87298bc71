import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import same_rows
from lineforge.functions import parse_timestamp
from lineforge.operators import profile_distinct
from lineforge.sinks import export_csv
from lineforge.sources import ingest_csv

HEADER = "order item id,Order Date (x),Zip,Café Name,Empty"
LINES = [
    "1,1/31/2018 22:56,00725,Café,",
    "2,12/1/2017 1:05,10001,Québec,",
    "3,2018-01-31,20002,Plain,",
    "4,,00001,Plain,",
]
SCHEMA = T.StructType([T.StructField("order_item_id", T.LongType())])


@pytest.fixture
def source(tmp_path):
    path = tmp_path / "orders.csv"
    path.write_bytes("\n".join([HEADER, *LINES]).encode("latin-1"))
    return str(path)


def test_names_values_and_audit_columns(spark, source):
    df = ingest_csv(spark, source, SCHEMA)
    assert df.columns == [
        "order_item_id", "order_date_x", "zip", "caf_name", "empty", "_malformed", "_ingested_at", "_source_file",
    ]
    rows = df.orderBy("order_item_id").collect()
    assert [r.order_item_id for r in rows] == [1, 2, 3, 4]
    assert [r.caf_name for r in rows][:2] == ["Café", "Québec"]
    assert [r.zip for r in rows] == ["00725", "10001", "20002", "00001"]
    assert all(r._source_file.endswith("orders.csv") and r._ingested_at for r in rows)
    assert rows[3].order_date_x is None


def test_inference_is_optional_and_drops_zeros(spark, source):
    df = ingest_csv(spark, source, infer=True)
    assert dict(df.dtypes)["zip"] == "int"
    assert dict(df.dtypes)["order_date_x"] == "string"
    assert df.filter("order_item_id = 1").first().zip == 725


def test_schema_is_matched_by_name_not_position(spark, source):
    schema = T.StructType([T.StructField("zip", T.IntegerType()), *SCHEMA.fields])
    assert ingest_csv(spark, source, schema).agg(F.max("order_item_id"), F.min("zip")).first()[:] == (4, 1)


def test_unknown_schema_column_is_an_error(spark, source):
    with pytest.raises(ValueError, match="no column nowhere"):
        ingest_csv(spark, source, T.StructType([T.StructField("nowhere", T.LongType())]))


def test_colliding_headers_are_an_error(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("A-b,a b\n1,2\n")
    with pytest.raises(ValueError, match="both become"):
        ingest_csv(spark, str(path))


def test_files_with_another_header_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n")
    (tmp_path / "b.csv").write_text("name,id\ny,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        ingest_csv(spark, str(tmp_path)).collect()


def test_dates_parse_by_format_or_become_null(spark, source):
    text = F.col("order_date_x")
    df = ingest_csv(spark, source, SCHEMA).select(
        "order_item_id", parse_timestamp(text, "M/d/yyyy H:mm").cast("string").alias("ts")
    )
    assert [r.ts for r in df.orderBy("order_item_id").collect()] == [
        "2018-01-31 22:56:00", "2017-12-01 01:05:00", None, None,
    ]


def test_all_empty_column_has_no_distinct_value(spark, source):
    assert profile_distinct(ingest_csv(spark, source), ["empty", "caf_name"]).first()[:] == (0, 3)


def test_export_keeps_null_empty_and_padded_text_apart(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " padded "), (4, 'a "b", c')], "id int, s string")
    export_csv({"t": df}, str(tmp_path / "out"), single_file=["t"])
    files = list((tmp_path / "out" / "t").glob("part-*.csv"))
    assert len(files) == 1
    written = files[0].read_text().splitlines()
    assert written[0] == "id,s" and written[1] == "1," and written[2] == '2,""'
    back = spark.read.schema(df.schema).csv(str(tmp_path / "out" / "t"), header=True, escape='"')
    rows = {r.id: r.s for r in back.collect()}
    assert rows[1] is None and rows[3] == " padded " and rows[4] == 'a "b", c'


def test_export_is_parallel_unless_asked(spark, tmp_path):
    df = spark.range(100).repartition(3)
    export_csv({"t": df}, str(tmp_path / "out"))
    assert len(list((tmp_path / "out" / "t").glob("part-*.csv"))) == 3


def test_doubled_quotes_and_line_breaks_both_ways(spark, tmp_path):
    rows = [("1", '5" tee, red'), ("2", 'a ""b""'), ("3", "back\\slash"), ("4", "two\nlines"), ("5", '"')]
    df = spark.createDataFrame(rows, "id string, name string")
    export_csv({"t": df}, str(tmp_path))
    back = ingest_csv(spark, f"{tmp_path}/t", encoding="UTF-8", multiline=True)
    assert sorted(map(tuple, back.select("id", "name").collect())) == rows
    (tmp_path / "one.csv").write_text('id,name\n1,"5"" tee, red"\n')
    assert ingest_csv(spark, f"{tmp_path}/one.csv").first().name == '5" tee, red'


def test_compressed_export_gives_the_same_rows(spark, tmp_path):
    df = spark.range(50).selectExpr("id", "concat('é ', id) as t")
    export_csv({"t": df}, str(tmp_path), compression="gzip")
    assert list((tmp_path / "t").glob("*.csv.gz")) and not list((tmp_path / "t").glob("*.csv"))
    assert same_rows(spark.read.schema(df.schema).csv(str(tmp_path / "t"), header=True), df)
