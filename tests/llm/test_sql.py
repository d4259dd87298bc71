"""Operations that SQL can express, against that SQL on whole tables: rows, names and types."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from lineforge.llm import registry

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_operation_agrees_with_sql(spark, small_dir, name):
    duck = duckdb.connect()
    for file in Path(small_dir).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    cursor = duck.execute(registry.oracle_sql()[name])
    wanted = {c[0]: str(c[1]) for c in cursor.description}
    df = registry.queries()[name](spark, small_dir)
    shared = [c for c in df.columns if c in wanted]
    assert shared and {c: KINDS[dict(df.dtypes)[c]] for c in shared} == wanted
    place = [list(wanted).index(c) for c in shared]
    rows = [tuple(row[i] for i in place) for row in cursor.fetchall()]
    assert sorted(map(repr, map(tuple, df.select(*shared).collect()))) == sorted(map(repr, rows))
