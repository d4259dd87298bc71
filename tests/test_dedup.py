"""One row per key, by every path and against a window over whole rows."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from conftest import final_plan, same_rows
from lineforge.operators import dedup, first_per_key, latest_per_key

SCHEMA = "k string, n int, at timestamp_ntz, id long, b string, x double"


@pytest.fixture(scope="module")
def rows(spark):
    """Unique, repeated, null and hot keys; repeated rows; nulls in every column."""
    rng = random.Random(9)
    day = [None, *(f"2018-01-0{i} 00:00:00" for i in range(1, 6))]
    made = [
        (rng.choice([None, "hot", "hot", f"k{rng.randrange(300)}"]), rng.choice([None, 1]), rng.choice(day),
         rng.choice([None, *range(6)]), rng.choice([None, "p", "q"]), rng.choice([None, 0.5, float("nan"), -1.0]))
        for _ in range(1500)
    ]
    text = spark.createDataFrame(made, SCHEMA.replace("timestamp_ntz", "string")).repartition(6)
    return text.withColumn("at", F.col("at").cast("timestamp_ntz"))


@pytest.fixture(params=["broadcast", "shuffled"])
def size(request, conf, monkeypatch):
    if request.param == "shuffled":
        conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
        monkeypatch.setattr("lineforge.operators.dedup.LEAST_HOT_ROWS", 100)
        monkeypatch.setattr("lineforge.operators.dedup.shuffle_tasks", lambda spark: 8)
    return request.param


def by_window(df, key, *order):
    number = F.row_number().over(W.partitionBy(*key).orderBy(*order))
    return df.withColumn("place", number).where("place = 1").drop("place")


@pytest.mark.parametrize("order", [[], ["x"], ["id"], ["b", "id"], ["b"]])
@pytest.mark.parametrize("key", [["k"], ["k", "n"]])
def test_first(rows, size, key, order):
    rest = [c for c in rows.columns if c not in key and c not in order]
    got = first_per_key(rows, key, order)
    assert got.columns == rows.columns
    assert same_rows(got, by_window(rows, key, *order, *rest))


@pytest.mark.parametrize("key", [["k"], ["k", "n"]])
def test_latest(rows, size, key):
    rest = [F.desc(c) for c in rows.columns if c not in key and c != "at"]
    expected = by_window(rows, key, F.desc_nulls_last("at"), F.asc_nulls_last("id"), *rest)
    assert same_rows(latest_per_key(rows, key, "at", "id"), expected)


def test_rows_of_unrepeated_keys_are_not_aggregated(spark, size):
    lines = spark.range(2000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("s"))
    assert "Aggregate" not in final_plan(first_per_key(lines, ["k"]))
    some = lines.unionAll(lines.where("k % 50 = 0").withColumn("s", F.lit("0")))
    kept = first_per_key(some, ["k"])
    assert kept.count() == 2000 and kept.where("s = '0'").count() == 40


def test_extremes_are_hash_aggregates(rows, size):
    """What sorts is one row per key, behind the join with the winners."""
    for kept in (latest_per_key(rows, ["k"], "at", "id"), first_per_key(rows, ["k"], ["id"])):
        plan = final_plan(kept)
        assert "LeftSemi" in plan[plan.index("SortAggregate") :]


def test_nothing(spark, size):
    none = spark.createDataFrame([], SCHEMA)
    assert first_per_key(none, ["k"], ["b"]).isEmpty() and first_per_key(none, ["k"], ["id"]).isEmpty()
    assert latest_per_key(none, ["k"], "at", "id").isEmpty()


def test_whole_rows_move_once_if_repeated_keys_are_many(spark, conf, monkeypatch):
    """By key, with no join between, unless a key is hot."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    lines = spark.range(3000).select((F.col("id") % 2000).alias("k"), F.col("id").cast("string").alias("s"))
    kept = first_per_key(lines, ["k"])
    plan = final_plan(kept).partition("Initial Plan")[0]
    assert "Join" not in plan and plan.count("Exchange hashpartitioning(k") == 1
    assert kept.count() == 2000 and kept.where("int(s) % 2000 = k").count() == 2000


def test_latest_by_the_tie_break_itself_counts_no_single_rows(rows):
    rest = [F.desc(c) for c in rows.columns if c not in ("k", "id")]
    got = latest_per_key(rows, ["k"], "id", "id")
    assert same_rows(got, by_window(rows, ["k"], F.desc_nulls_last("id"), *rest))
    jobs = []
    held = dedup._holders
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(dedup, "_holders", lambda df, best, *a: jobs.append(best._jdf.queryExecution().optimizedPlan().toString()) or held(df, best, *a))
        latest_per_key(rows, ["k"], "id", "id")
    assert jobs[0].count("Aggregate") == 1


@pytest.fixture
def stored(rows, tmp_path, conf, monkeypatch):
    """The rows in files of several row groups, too many keys for any broadcast of keys."""
    rows.write.option("parquet.block.size", 1024).parquet(str(tmp_path / "rows"))
    monkeypatch.setattr(dedup, "KEY_BYTES", 800)
    monkeypatch.setattr(dedup, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(dedup, "PIECE", 64)
    conf(spark__sql__files__maxPartitionBytes="4000", spark__sql__files__openCostInBytes="0")
    return rows.sparkSession.read.parquet(str(tmp_path / "rows"))


@pytest.mark.parametrize("key", [["k"], ["k", "n"]])
@pytest.mark.parametrize("order", [["id"], ["x"], ["b", "id"], ["at", "id", "x"]])
def test_stored_rows_stay_where_they_lie(stored, key, order):
    """Also those of a selection, and with keys whose best rows tie."""
    some = stored.where("id is null or id < 5").withColumn("id", F.col("id") * 2)
    rest = [c for c in some.columns if c not in key and c not in order]
    got = first_per_key(some, key, order, stored=True)
    assert got.columns == some.columns
    assert same_rows(got, by_window(some, key, *order, *rest))


@pytest.mark.parametrize("by", ["at", "id"])
def test_latest_of_stored_rows(stored, by):
    rest = [F.desc(c) for c in stored.columns if c not in ("k", by)]
    order = [F.desc_nulls_last(by), *([] if by == "id" else [F.asc_nulls_last("id")]), *rest]
    assert same_rows(latest_per_key(stored, ["k"], by, "id", stored=True), by_window(stored, ["k"], *order))


def test_stored_rows_are_not_shuffled(stored, spark, tmp_path):
    """No exchange of the rows themselves, which have a wide column; other rows than stored ones take the other way."""
    lines = spark.range(4000).select((F.col("id") % 1500).alias("k"), F.col("id").alias("at"), F.repeat(F.lit("x"), 50).alias("wide"))
    lines.repartition(5).write.parquet(str(tmp_path / "lines"))
    read = spark.read.parquet(str(tmp_path / "lines"))
    for order in (["at"], ["at", "wide"]):
        kept = first_per_key(read, ["k"], order, stored=True)
        assert kept.count() == 1500 and kept.where("at <> k").isEmpty()
        assert "Exchange hashpartitioning" not in final_plan(kept)
        assert same_rows(kept, first_per_key(lines, ["k"], order, stored=True))
