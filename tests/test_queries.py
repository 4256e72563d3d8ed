"""Every registered query against its SQL, at the smallest scale."""

import datetime

import duckdb
import pytest

import __spark_entry__ as driver
from obslake.plans.catalog import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}


def plain(value):
    return value.isoformat() if isinstance(value, datetime.date) else value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(driver.queries()) and set(QUERIES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    found = con.execute(driver.oracle_sql()[name])
    expected_types = {d[0]: str(d[1]) for d in found.description}
    df = driver.queries()[name](spark, sf_dir)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == expected_types
    expected = rows_of([d[0] for d in found.description], found.fetchall())
    assert rows_of(df.columns, df.collect()) == expected and expected


def test_entry(spark, sf_dir):
    assert driver.entry(spark).count() > 0
