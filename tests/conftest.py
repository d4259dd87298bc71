from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from lineforge.catalogue import lakehouse_for  # noqa: E402
from lineforge.session import local_session  # noqa: E402

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4,
        "lineforge-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def put(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture(scope="session")
def small_dir() -> str:
    return str(DATA / "sf0.001")


@pytest.fixture(scope="session")
def lake(spark, small_dir):
    """A lakehouse over the smallest tables, built once."""
    built = lakehouse_for(spark, small_dir)
    built.build()
    return built


def same_rows(left, right) -> bool:
    """Equal as multisets of rows."""
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def final_plan(df) -> str:
    """The executed plan, as adaptive execution ended up with it."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
