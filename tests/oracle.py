"""Comparison of a Spark result with DuckDB's over the same Parquet tables."""

import datetime
import decimal
import glob
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (float, decimal.Decimal)):
        return f"{float(value):.6g}"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value).removesuffix(" 00:00:00")
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows), sorted(names)


def both(spark, con, query, sql, sf_dir):
    df = query(spark, sf_dir)
    found = con.sql(sql)
    return rows_of(df.columns, [tuple(r) for r in df.collect()]), rows_of(found.columns, found.fetchall())
