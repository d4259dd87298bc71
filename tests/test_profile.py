from lineforge.operators import code_bitmaps, distinct_codes, profile_constant_columns, profile_distinct


def test_exact_and_sketched_distinct_counts(spark):
    df = spark.createDataFrame([("a", None, 1), ("b", None, 1), ("a", None, None)], "x string, y string, z int")
    assert profile_distinct(df, ["x", "y", "z"]).first()[:] == (2, 0, 1)
    assert profile_distinct(df, ["x", "y", "z"], approx=True).first()[:] == (2, 0, 1)


def test_constant_columns(spark):
    schema = "same string, nothing string, one_or_null int, varied double, flag boolean"
    rows = [("x", None, 1, 1.5, True), ("x", None, None, 2.5, True), ("x", None, 1, 1.5, False)]
    got = {r.column_name: (r.non_null_rows, r.is_constant) for r in profile_constant_columns(spark.createDataFrame(rows, schema)).collect()}
    assert got == {
        "same": (3, True), "nothing": (0, True), "one_or_null": (2, True), "varied": (3, False), "flag": (3, False),
    }


def test_one_scan_settles_all_but_constant_text(spark, tmp_path):
    """Texts that are all equal are compared by value; everything else is known after one pass."""
    path = str(tmp_path / "t")
    spark.range(500).selectExpr("id", "id % 1 as same", "cast(id as string) as text", "'x' as one", "id / 3.0 as d").write.parquet(path)
    read = spark.read.parquet(path)
    plan = profile_constant_columns(read)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "one" in plan.split("Relation [")[0]
    assert "Relation [" not in profile_constant_columns(read.drop("one"))._jdf.queryExecution().optimizedPlan().toString()
    got = {r.column_name: tuple(r)[1:] for r in profile_constant_columns(read.limit(0)).collect()}
    assert set(got.values()) == {(0, True)} and len(got) == 5


def test_constant_agrees_with_distinct_counts(lake):
    bronze = lake.bronze()
    counted = profile_distinct(bronze, bronze.columns).first().asDict()
    constant = {r.column_name: r.is_constant for r in profile_constant_columns(bronze).collect()}
    assert constant == {name: n <= 1 for name, n in counted.items()}
    assert constant["customer_email"] and constant["product_description"] and not constant["product_image"]


def test_bitmaps_count_what_distinct_counts_do(spark, lake):
    fact = lake.fact()
    keys = [c for c in fact.columns if c.endswith("_key")]
    whole = {r.column_name: r.n_distinct for r in distinct_codes(code_bitmaps(fact, keys, ["order_status"])).collect()}
    assert whole == profile_distinct(fact, keys).first().asDict()
    odd = spark.createDataFrame([(x, g) for x in (None, -70000, -1, 0, 1, 32768, 32769, 2**40, 1) for g in ("a", None)], "x long, g string")
    parts = distinct_codes(code_bitmaps(odd, ["x"], ["g"]), ["g"]).collect()
    assert {(r.g, r.n_distinct) for r in parts} == {("a", 7), (None, 7)}
    assert distinct_codes(code_bitmaps(odd.limit(0), ["x"])).isEmpty()


def test_each_counted_column_is_read_apart(spark, tmp_path):
    """No task holds a copy of its rows for every counted column."""
    path = str(tmp_path / "keys")
    spark.range(3000).selectExpr("id % 7 as a", "id as b", "id % 2 as g").write.parquet(path)
    bitmaps = code_bitmaps(spark.read.parquet(path), ["a", "b"], ["g"])
    assert "Generate" not in bitmaps._jdf.queryExecution().optimizedPlan().toString()
    counts = {(r.g, r.column_name): r.n_distinct for r in distinct_codes(bitmaps, ["g"]).collect()}
    assert counts == {(0, "a"): 7, (1, "a"): 7, (0, "b"): 1500, (1, "b"): 1500}
