"""Run catalog queries against their SQL on one folder of driver tables.

python tests/check.py [folder] [query ...]
"""

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def ordered(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime") or df[c].dtype == object:
            sample = df[c].dropna()
            if len(sample) and hasattr(sample.iloc[0], "isoformat"):
                df[c] = pd.to_datetime(df[c]).dt.strftime("%Y-%m-%d %H:%M:%S.%f")
        if str(df[c].dtype) in ("Int64", "int32", "int64"):
            df[c] = df[c].astype("float64")
    keys = [c for c in df.columns if df[c].dtype != "float64"]
    keys += [c for c in df.columns if df[c].dtype == "float64"]
    return df.sort_values(keys, kind="stable").reset_index(drop=True)


def differences(spark_df: pd.DataFrame, sql_df: pd.DataFrame) -> list[str]:
    """Empty when both hold the same rows."""
    if sorted(spark_df.columns) != sorted(sql_df.columns):
        return [f"columns {sorted(spark_df.columns)} / {sorted(sql_df.columns)}"]
    if len(spark_df) != len(sql_df):
        return [f"rows {len(spark_df)} / {len(sql_df)}"]
    a, b = ordered(spark_df), ordered(sql_df)
    out = []
    for c in a.columns:
        if a[c].dtype == "float64" and b[c].dtype == "float64":
            same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
            if not same.all():
                out.append(f"{c}: {(~same).sum()} differ, worst {(a[c] - b[c]).abs().max()}")
        else:
            same = (a[c].astype(object) == b[c].astype(object)) | (a[c].isna() & b[c].isna())
            if not same.all():
                i = (~same).idxmax()
                out.append(f"{c}: {(~same).sum()} differ, first {a[c][i]!r} / {b[c][i]!r}")
    return out


def main() -> int:
    import __spark_entry__ as entry
    from tickertone import get_spark

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("check", 8)
    con, queries, sql = database(folder), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            got = queries[name](spark, folder).toPandas()
        except Exception as error:  # report and go on
            print(f"FAIL {name}: {str(error)[:1500]}", flush=True)
            bad += 1
            continue
        took = time.time() - start
        if name not in sql:
            print(f"rows {name} {len(got)} rows {took:.1f}s", flush=True)
            continue
        start = time.time()
        try:
            problems = differences(got, con.execute(sql[name]).df())
        except Exception as error:
            problems = [str(error)[:800]]
        bad += bool(problems)
        verdict = "FAIL" if problems else "ok"
        print(f"{verdict} {name} {len(got)} rows {took:.1f}s sql {time.time() - start:.1f}s", *problems,
              sep="\n   ", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
