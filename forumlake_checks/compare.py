"""Run registered queries against their SQL: python -m forumlake_checks.compare [sf_dir] [query ...]"""

import sys
import time

import duckdb
import pandas as pd

from forumlake_checks.oracle import ORACLE
from forumlake_checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _kind(dtype: str) -> str:
    names = {"long": "bigint", "double": "double", "string": "varchar", "date": "date", "boolean": "boolean"}
    return names.get(dtype, {"integer": "int", "timestamp_ntz": "timestamp"}.get(dtype, dtype))


def differences(spark_df, con, sql: str) -> list[str]:
    """What differs between a Spark result and a SQL result, rows in any order."""
    expected = con.sql(sql)
    types = {n: str(t).lower().replace("integer", "int") for n, t in zip(expected.columns, expected.types)}
    found = {f.name: _kind(f.dataType.typeName()) for f in spark_df.schema}
    problems = []
    if found != types:
        problems.append(f"schema {sorted(set(found.items()) ^ set(types.items()))}")
    names = sorted(found)
    if names != sorted(types):
        return problems
    left = [tuple(map(str, r)) for r in spark_df.select(*names).collect()]
    right = [tuple(map(str, r)) for r in expected.select(*[f'"{n}"' for n in names]).fetchall()]
    if len(left) != len(right):
        problems.append(f"rows {len(left)} != {len(right)}")
    if sorted(left) != sorted(right):
        extra = pd.Series(left).value_counts().sub(pd.Series(right).value_counts(), fill_value=0)
        sample = extra[extra != 0]
        problems.append(f"values: {len(sample)} differ, {names}: {sample.head(6).to_dict()}")
    return problems


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    from forumlake.session import local_session

    spark = local_session(8)
    con = database(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            problems = differences(df, con, ORACLE[name]) if name in ORACLE else ["no SQL"]
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok':4} {name} {time.time() - start:.1f}s {problems or ''}", flush=True)
    print(f"{failed} of {len(names or QUERIES)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
