"""Rows of a query and of its SQL, in one form."""

import duckdb

import __spark_entry__ as driver

TABLES = "documents embeddings pages benchmark labels conversations".split()


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def by_sql(name, sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    found = con.execute(driver.oracle_sql()[name])
    return rows_of([d[0] for d in found.description], found.fetchall())


def by_spark(spark, name, sf_dir):
    df = driver.queries()[name](spark, sf_dir)
    return rows_of(df.columns, df.collect())
