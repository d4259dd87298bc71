"""History from observed days, and lines that meet one of many versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import final_plan, same_rows
from lineforge.catalogue import registry
from lineforge.operators import joins, sweep
from lineforge.operators import day_observations, merge_snapshots, scd2_from_snapshots, sweep_join, temporal_join
from lineforge.operators.joins import lookup_join

SCHEMA = "who string, day date, line long, city string, size int, note string"
TRACKED = ["city", "size"]
START = dt.date(2018, 1, 1)


def day(n):
    return None if n is None else START + dt.timedelta(n)


@pytest.fixture(scope="module")
def lines(spark):
    rng = random.Random(4)
    rows = [
        (rng.choice([None, "a", "b", "c", "hot", "hot", "hot"]), day(rng.choice([None, *range(40)])), i,
         rng.choice(["x", "y", None]), rng.choice([1, 2, None]), "n")
        for i in range(400)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def versions_of(rows):
    """Runs of equal values per entity, by hand."""
    last = {}
    for r in sorted((r for r in rows if r.day), key=lambda r: r.line):
        last[(r.who, r.day)] = (r.city, r.size)
    out = []
    for who in {w for w, _ in last}:
        runs = []
        for d in sorted(d for w, d in last if w == who):
            if runs and runs[-1][0] == last[(who, d)]:
                runs[-1][2] = d
            else:
                runs.append([last[(who, d)], d, d])
        for i, (values, first, seen) in enumerate(runs):
            end = runs[i + 1][1] - dt.timedelta(1) if i + 1 < len(runs) else dt.date(9999, 12, 31)
            out.append((who, *values, first, end, i + 1 == len(runs), seen))
    return sorted(out, key=repr)


def built(lines):
    return scd2_from_snapshots(day_observations(lines, "who", "day", TRACKED, "line"), "who", "day", TRACKED)


def test_versions_are_the_runs_of_equal_values(lines):
    got = built(lines)
    assert got.columns == ["who", "city", "size", "start_date", "end_date", "is_current", "last_seen"]
    assert sorted(map(tuple, got.collect()), key=repr) == versions_of(lines.collect())


@pytest.mark.parametrize("cut", [0, 1, 13, 39, 60])
def test_merging_in_order_is_building_at_once(lines, cut):
    observed = day_observations(lines, "who", "day", TRACKED, "line")
    stored = scd2_from_snapshots(observed.where(F.col("day") < day(cut)), "who", "day", TRACKED)
    merged = merge_snapshots(stored, observed.where(F.col("day") >= day(cut)), "who", "day", TRACKED)
    assert same_rows(merged, built(lines))


def test_an_entity_without_news_stays_and_a_late_one_splits(spark):
    observed = spark.createDataFrame(
        [("a", day(1), "x", 1), ("a", day(9), "x", 1), ("b", day(1), "x", 1)], "who string, day date, city string, size int"
    )
    stored = scd2_from_snapshots(observed, "who", "day", TRACKED)
    late = spark.createDataFrame([("a", day(5), "y", 1), ("a", None, "z", 1), ("a", day(9), "x", 2)], observed.schema)
    merged = merge_snapshots(stored, late, "who", "day", TRACKED).where("who = 'a'").orderBy("start_date")
    assert [(r.city, r.size, r.start_date, r.end_date) for r in merged.collect()] == [
        ("x", 1, day(1), day(4)), ("y", 1, day(5), day(8)), ("x", 2, day(9), dt.date(9999, 12, 31)),
    ]
    assert same_rows(
        merge_snapshots(stored, late, "who", "day", TRACKED).where("who = 'b'"), stored.where("who = 'b'")
    )


def test_nothing_observed(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert built(none).isEmpty()
    assert merge_snapshots(built(none), day_observations(none, "who", "day", TRACKED, "line"), "who", "day", TRACKED).isEmpty()


# --- lines against versions ----------------------------------------------------------------

ON = ("who", "day", "start_date", "end_date")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_sweep_is_the_plain_join(spark, conf, lines, how):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="7")
    gaps = built(lines).where("start_date <> date'2018-01-05' and size is not null")
    asked = lines.unionByName(lines.limit(30)).withColumnRenamed("city", "_key").withColumnRenamed("size", "_line")
    take = {"city": "was", "last_seen": "until"}
    plain = lookup_join(asked, gaps, {"who": "who"}, take, during=("day", "start_date", "end_date"), how=how)
    assert same_rows(sweep_join(asked, gaps, *ON, take, how), plain)
    assert same_rows(temporal_join(asked, gaps, *ON, take, how, many_versions=1), plain)
    assert sweep_join(asked.limit(0), gaps, *ON, take, how).isEmpty()
    assert sweep_join(asked, gaps.limit(0), *ON, take, how).count() == (asked.count() if how == "left" else 0)


def test_many_versions_of_one_entity_meet_linearly(spark):
    """10,000 versions of one customer and as many lines: no step makes more rows than both together."""
    n = 10_000
    start = F.date_add(F.to_date(F.lit("1990-01-01")), F.col("id").cast("int"))
    versions = spark.range(n).select(F.lit(1).alias("c"), start.alias("s"), start.alias("e"), F.col("id").alias("v"))
    asked = spark.range(n).select(F.lit(1).alias("c"), start.alias("d"), F.col("id").alias("v_wanted"))
    joined = temporal_join(asked, versions, "c", "d", "s", "e", ["v"])
    assert joined.where("v <=> v_wanted").count() == n
    joined.collect()
    plan = final_plan(joined)
    assert "_range" in plan and "Join" in plan
    assert not any("c#" in line for line in plan.splitlines() if "Join" in line)


def test_histories_read_stored_observations(spark, lake, small_dir):
    """The lines are reduced to days once, however often the days are read."""
    merged = registry.mode_versions_merged(spark, small_dir)
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "order_item_id" not in plan
    assert same_rows(merged, registry.mode_versions(spark, small_dir))


def test_swept_rows_are_stored_without_their_deal(spark, lines, monkeypatch):
    stored = []
    keep = sweep.materialise
    monkeypatch.setattr(sweep, "materialise", lambda df, label: stored.append(df.columns) or keep(df, label))
    sweep_join(lines, built(lines), *ON, {"city": "was"})
    assert stored == [["_key", "_day", "_kind", "_line", "_version", "_seq"]]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("hot", [0, 1, 3])
def test_sweep_of_ordinary_entities_by_key(spark, lines, how, hot):
    """Given the entities with too many lines, the others move once and are not stored."""
    lines, versions = sweep.materialise(lines, "lines"), sweep.materialise(built(lines), "versions")
    take = {"city": "was", "last_seen": "until"}
    few = lines.select("who").distinct().orderBy("who").limit(hot)
    few = spark.createDataFrame(few.collect(), few.schema)
    swept = sweep_join(lines, versions, *ON, take, how, few)
    assert same_rows(swept, sweep_join(lines, versions, *ON, take, how))
    if not hot:
        plan = final_plan(swept).partition("Initial Plan")[0]
        assert plan.count("Exchange hashpartitioning") == 1 and "_range" not in plan


def test_large_tables_are_swept_by_entity(spark, lines, monkeypatch):
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 3)
    monkeypatch.setattr(joins, "LEAST_HOT_ROWS", 3)
    take = {"city": "was"}
    given = []
    keep = joins.sweep_join
    monkeypatch.setattr(joins, "sweep_join", lambda *a: given.append(a[-1].count()) or keep(*a))
    joined = temporal_join(lines, built(lines), *ON, take, many_versions=0)
    assert given and same_rows(joined, sweep_join(lines, built(lines), *ON, take))
