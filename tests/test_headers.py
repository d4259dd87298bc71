import pytest
from hypothesis import given
from hypothesis import strategies as st

from lineforge.functions import clean_name, clean_names, normalise_headers


@pytest.mark.parametrize(
    ("header", "name"),
    [
        ("Days for shipping (real)", "days_for_shipping_real"),
        ("  Order Date (x) ", "order_date_x"),
        ("Café Name", "caf_name"),
        ("A-b", "a_b"),
        ("__Zip__Code__", "zip_code"),
        ("日本", ""),
    ],
)
def test_clean_name(header, name):
    assert clean_name(header) == name


@given(st.text())
def test_clean_name_is_snake_case_and_stable(header):
    name = clean_name(header)
    assert clean_name(name) == name
    assert set(name) <= set("abcdefghijklmnopqrstuvwxyz0123456789_")
    assert not name.startswith("_") and not name.endswith("_") and "__" not in name


def test_collision_names_both_headers():
    with pytest.raises(ValueError, match="'A-b' and 'a b' both become 'a_b'"):
        clean_names(["x", "A-b", "a b"])


def test_vanishing_header_is_an_error():
    with pytest.raises(ValueError, match="日本"):
        clean_names(["x", "日本"])


def test_normalise_headers_renames_all_columns(spark):
    df = spark.createDataFrame([(1, 2)], ["Order Item Id", "Sales (USD)"])
    assert normalise_headers(df).columns == ["order_item_id", "sales_usd"]
