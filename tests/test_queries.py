"""Every named query against its SQL on the smallest test tables."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from voxmill.plans import ORACLES, QUERIES

DATA = Path("/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
         "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{DATA}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "null" if math.isnan(value) else repr(value)
    return "null" if value is None else str(value)


def table(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in data)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    cursor = duck.execute(ORACLES[name])
    types = {d[0]: str(d[1]) for d in cursor.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    assert table(df.columns, df.collect()) == table(list(types), cursor.fetchall())


def test_entry_points(spark):
    assert entry_points.queries().keys() >= QUERIES.keys()
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert entry_points.entry(spark).limit(1).count() == 1


def test_answers_have_all_sections(spark):
    rows = QUERIES["answered_questions"](spark, str(DATA)).collect()
    asked = spark.read.parquet(f"{DATA}/conversations.parquet").where("role = 'user'").count()
    assert len(rows) == asked
    for row in rows:
        for part in ("relevant reviews for", "### 1. Sentiment Breakdown", "### 2. Relevant Aspects",
                     "### 3.", "### 4. Representative Evidence"):
            assert part in row.answer
