"""Every registered query against its check statement in DuckDB, on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as contract
from helixframe.registry import all_oracles, all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

QUERIES, ORACLES = all_queries(), all_oracles()
TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}
# Results the smallest tables leave empty.
MAY_BE_EMPTY = {"panel_filter", "alleles_by_population", "rare_carrier_list_near_locus"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.fixture(scope="module", autouse=True)
def small_data_settings(spark):
    """Compiling a stage takes longer than running it on tables this small."""
    settings = {"spark.sql.codegen.wholeStage": "false", "spark.sql.shuffle.partitions": "2"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def _text(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return None if value is None else str(value)


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_text(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES) and len(QUERIES) > 140


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    types = {d[0]: str(d[1]) for d in cursor.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    got, expected = df.collect(), cursor.fetchall()
    assert _sorted(df.columns, got) == _sorted(names, expected)
    assert got or name in MAY_BE_EMPTY
