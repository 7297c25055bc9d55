"""Compare a query with its SQL, order and column order aside."""

import os

import duckdb
import pandas as pd


def canon(v):
    if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
        return tuple(canon(x) for x in v)
    if v is None or pd.isna(v):
        return None
    return v.item() if hasattr(v, "item") else v


def rows(pdf):
    pdf = pdf[sorted(pdf.columns)]
    return sorted((tuple(canon(v) for v in r) for r in pdf.astype(object).itertuples(index=False)), key=repr)


def check(spark, sf_dir, run, sql):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf_dir}/{f}'")
    got, expected = run(spark, sf_dir).toPandas(), con.execute(sql).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got) == rows(expected)
