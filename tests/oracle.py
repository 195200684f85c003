"""Spark results against the registered SQL in DuckDB."""

import glob
import os

import duckdb


def views(sf_dir):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        c.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{files}'")
    return c


def rows(table):
    names = sorted(table.column_names)
    return names, sorted(map(repr, zip(*[table.column(n).to_pylist() for n in names], strict=True)))


def same(spark, sf_dir, query, sql):
    a, b = query(spark, sf_dir).toArrow(), views(sf_dir).sql(sql).to_arrow_table()
    return rows(a) == rows(b)
