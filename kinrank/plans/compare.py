"""Run a registered query in Spark and its SQL oracle in DuckDB, and compare
schema, row count and the multiset of rows (columns taken in name order)."""

from __future__ import annotations

import math
import time
from collections import Counter

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

_SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                  "float": "FLOAT", "boolean": "BOOLEAN", "smallint": "SMALLINT"}


def duck_connect(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    return v


def compare(spark, con, name: str, build, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    df = build(spark, sf_dir)
    s_cols = sorted(df.columns)
    s_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    s_rows = [tuple(_norm(r[c]) for c in s_cols) for r in df.collect()]
    t1 = time.time()
    res = {"query": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        return res
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_types = {c[0]: str(c[1]) for c in cur.description}
    d_rows_raw = cur.fetchall()
    order = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    d_rows = [tuple(_norm(r[i]) for i in order) for r in d_rows_raw]
    res["oracle_rows"] = len(d_rows)
    res["oracle_sec"] = round(time.time() - t1, 2)
    res["columns_match"] = s_cols == sorted(d_cols)
    res["types_match"] = all(_SPARK_TO_DUCK.get(s_types[c], s_types[c]) == d_types.get(c)
                             for c in s_cols) if res["columns_match"] else False
    if not res["types_match"]:
        res["types"] = {c: (s_types.get(c), d_types.get(c)) for c in set(s_cols) | set(d_cols)}
    sc, dc = Counter(s_rows), Counter(d_rows)
    res["values_match"] = sc == dc
    if not res["values_match"]:
        res["only_spark"] = [list(r) for r in list((sc - dc).elements())[:5]]
        res["only_oracle"] = [list(r) for r in list((dc - sc).elements())[:5]]
    res["ok"] = res["columns_match"] and res["types_match"] and res["values_match"]
    return res
