"""Run registered queries next to their SQL in DuckDB: python tests/check_oracle.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    kinds = []
    for c in df.columns:
        s = df[c]
        if str(s.dtype).startswith(("int", "uint", "Int")):
            kinds.append("int")
        elif str(s.dtype).startswith("float"):
            kinds.append("float")
        else:
            kinds.append("any")
    rows = []
    for row in df.itertuples(index=False, name=None):
        rows.append(tuple(None if v is None or (not isinstance(v, (list, str)) and pd.isna(v)) else _plain(v) for v in row))
    return sorted(rows, key=repr)


def _plain(v):
    if hasattr(v, "item") and getattr(v, "shape", None) == ():
        v = v.item()
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if hasattr(v, "hour") and v.hour == v.minute == v.second == v.microsecond == 0:
        v = v.date()
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return float(v)
    return v


def compare(spark_df: pd.DataFrame, sql_df: pd.DataFrame) -> str:
    """Empty when both hold the same columns and rows."""
    if sorted(spark_df.columns) != sorted(sql_df.columns):
        a, b = set(spark_df.columns), set(sql_df.columns)
        return f"columns differ: only spark {sorted(a - b)[:5]}, only sql {sorted(b - a)[:5]}"
    if len(spark_df) != len(sql_df):
        return f"{len(spark_df)} rows in spark, {len(sql_df)} in sql"
    left, right = normal(spark_df), normal(sql_df)
    names = sorted(spark_df.columns)
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if not bad:
        return ""
    a, b = bad[0]
    diff = [(n, x, y) for n, x, y in zip(names, a, b) if x != y][:4]
    return f"{len(bad)} rows differ, first {diff}"


def type_classes(spark_df, con, sql: str) -> str:
    """Report columns whose type class differs (whole number, float, text, ...)."""
    kinds = {"TINYINT": "int", "SMALLINT": "int", "INTEGER": "int", "BIGINT": "int", "DOUBLE": "float", "FLOAT": "float"}
    sparks = {"tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "double": "float", "float": "float"}
    sparks |= {"string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP"}
    sqls = {r[0]: kinds.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    own = {f.name: sparks.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in spark_df.schema}
    odd = {c: (own[c], sqls.get(c)) for c in own if own[c] != sqls.get(c)}
    return f"types differ {dict(list(odd.items())[:4])}" if odd else ""


def main() -> int:
    import __spark_entry__ as entry
    from panelkit.session import local_session

    args = sys.argv[1:]
    sf = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    queries, sqls = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not args or any(a in n for a in args)]
    failed = 0
    for n in names:
        t = time.time()
        try:
            df = queries[n](spark, sf)
            got = df.toPandas()
            spent = time.time() - t
            if n not in sqls:
                print(f"rows {n:34s} {len(got)} rows {spent:.1f}s", flush=True)
                continue
            t = time.time()
            want = con.execute(sqls[n]).df()
            other = time.time() - t
            why = compare(got, want) or type_classes(df, con, sqls[n])
        except Exception as e:  # noqa: BLE001
            why, got, spent, other = f"{type(e).__name__}: {str(e)[:600]}", [], time.time() - t, 0
        failed += bool(why)
        print(f"{'FAIL' if why else 'ok  '} {n:34s} {len(got)} rows {spent:.1f}s / {other:.1f}s {why}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
