import importlib.util
import math
from pathlib import Path

import duckdb
import pytest

spec = importlib.util.spec_from_file_location(
    "entry_point", Path(__file__).resolve().parents[1] / "__spark_entry__.py"
)
entry_point = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry_point)

TABLES = ["customer", "orders", "lineitem", "events", "embeddings"]
# The queries of the training-data package are tested beside it.
CHECKED = {k: v for k, v in entry_point.oracle_sql().items() if k in entry_point.CHECKS}


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    return connection


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def in_order(rows):
    return sorted(rows, key=lambda r: [(v is None, str(type(v)), str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(CHECKED))
def test_query_equals_sql(spark, small, duck, name):
    df = entry_point.queries()[name](spark, small)
    result = duck.execute(CHECKED[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    order = [names.index(c) for c in sorted(names)]
    wanted = [tuple(plain(row[i]) for i in order) for row in result.fetchall()]
    found = [tuple(plain(row[c]) for c in sorted(names)) for row in df.collect()]
    assert in_order(found) == in_order(wanted)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_query_is_registered():
    assert set(CHECKED) < set(entry_point.queries())


def test_whole_analysis(spark, small):
    from clientele import run_analysis
    from clientele.sources.tables import order_lines

    done = run_analysis(order_lines(spark, small), max_clusters=5)
    customers = done.customers.count()
    removed = done.scored.where("is_outlier").count()
    assert customers + removed == done.features.count()
    assert abs(removed / done.features.count() - 0.05) < 0.01
    assert done.assigned.count() == customers
    assert done.best in {r.algorithm for r in done.comparison.collect()}
    assert 3 <= done.k <= 7
    for tables in (done.exploration(), done.description(), done.reports()):
        for name, table in tables.items():
            assert not table.isEmpty(), name
