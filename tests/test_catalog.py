"""Every registered query against its SQL twin on the smallest tables."""

import importlib.util
import os

import duckdb
import pandas as pd
import pytest

from tracewarden.queries.catalog import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def _values(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    return sorted(
        tuple("NULL" if pd.isna(v) else repr(float(v)) if isinstance(v, float) else str(v) for v in row)
        for row in frame.itertuples(index=False)
    )


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, database, name):
    ours = QUERIES[name](spark, FOLDER).toPandas()
    theirs = database.execute(ORACLE[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert _values(ours) == _values(theirs)


def test_entry_points():
    root = os.path.join(os.path.dirname(__file__), os.pardir, "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("entry_points", root)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert module.queries().keys() >= QUERIES.keys()
    assert module.queries().keys() >= module.oracle_sql().keys() >= ORACLE.keys()


def test_line_plan_is_narrow_and_shuffles_once(spark):
    """The ordered pass moves five small columns, in one exchange, without the text."""
    from tracewarden.operators.gaps import gap_marks
    from tracewarden.operators.parsing import parse_lines
    from tracewarden.queries import inputs
    from tracewarden.sources.staging import stage

    parsed = parse_lines(inputs.service_lines(spark, FOLDER), inputs.CONFIG)
    steps = gap_marks(stage(parsed, "parsed"), inputs.CONFIG)
    plan = steps._jdf.queryExecution().executedPlan().toString().splitlines()
    (at,) = [n for n, line in enumerate(plan) if "Exchange" in line]
    assert "hashpartitioning(source" in plan[at] and "block" in plan[at]
    moved = plan[at + 1]
    assert "raw_us" in moved and "line_number#" in moved and " line#" not in moved
    assert sum("Window [" in line for line in plan) == 1
    (scan,) = [line for line in plan if "FileScan" in line]
    assert "PushedFilters: [IsNotNull(ts_us)]" in scan
    assert "ReadSchema: struct<source:string,line_number:bigint,ts_us:bigint,parser:string>" in scan


def test_error_filter_reaches_the_scan_side(spark):
    """Only error lines are shuffled for burst counts."""
    from tracewarden.operators.bursts import burst_counts
    from tracewarden.operators.parsing import parse_lines
    from tracewarden.queries import inputs

    parsed = parse_lines(inputs.single_source_lines(spark, FOLDER), inputs.CONFIG)
    plan = burst_counts(parsed, inputs.CONFIG)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    error_filter = max(n for n, line in enumerate(plan) if "Filter" in line and "Contains" in line)
    assert error_filter > max(n for n, line in enumerate(plan) if "Window" in line)
