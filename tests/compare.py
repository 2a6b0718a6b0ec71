"""Runs named queries on Spark and their SQL on DuckDB, and compares rows, column names and types."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
          "TIMESTAMP": "timestamp", "DATE": "date"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def differences(df, con, sql: str) -> list[str]:
    """What differs; empty if the two agree."""
    answer = con.sql(sql)
    names = sorted(df.columns)
    found = []
    if names != sorted(answer.columns):
        return [f"columns {names} / {sorted(answer.columns)}"]
    theirs = dict(zip(answer.columns, answer.types))
    for field in df.schema.fields:
        expected = _TYPES.get(str(theirs[field.name]), str(theirs[field.name]))
        if field.dataType.simpleString() != expected:
            found.append(f"type of {field.name}: {field.dataType.simpleString()} / {theirs[field.name]}")
    ours = Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())
    order = [answer.columns.index(n) for n in names]
    other = Counter(tuple(_plain(row[i]) for i in order) for row in answer.fetchall())
    if ours != other:
        only, missing = ours - other, other - ours
        found.append(f"rows {sum(ours.values())} / {sum(other.values())}; only Spark {sum(only.values())} "
                     f"{list(only)[:3]}; only SQL {sum(missing.values())} {list(missing)[:3]}")
    return found


def main(sf_dir: str, wanted: list[str]) -> int:
    import __spark_entry__ as contract
    from laneflow.session import local_session

    spark, con, bad = local_session(8), connect(sf_dir), 0
    sqls = contract.oracle_sql()
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sqls:
                found = differences(df, con, sqls[name])
                note = "ok" if not found else "DIFFERS " + " | ".join(found)
            else:
                found, note = [], f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001 - report and go on
            found, note = [str(error)], "ERROR " + str(error)[:600]
        bad += bool(found)
        print(f"{name:28s} {time.time() - start:6.2f}s  {note}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
