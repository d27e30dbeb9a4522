"""Run registered queries beside their oracles and report differences.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from checks.oracles import ORACLES
from checks.queries import QUERIES
from lakemart.session import get_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def differences(spark, con, name: str, sf_dir: str) -> tuple[int, list[str]]:
    """Row count and what differs: columns, types or values."""
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = Counter(tuple(r) for r in df.select(*columns).collect())
    if name not in ORACLES:
        return got.total(), []
    result = con.execute(ORACLES[name])
    types = {d[0]: str(d[1]).lower() for d in result.description}
    if sorted(types) != columns:
        return got.total(), [f"columns {columns} != {sorted(types)}"]
    order = [list(types).index(c) for c in columns]
    want = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    found = []
    for field in df.schema.fields:
        spark_type = SAME_TYPE.get(field.dataType.simpleString(), field.dataType.simpleString())
        if spark_type != types[field.name]:
            found.append(f"type of {field.name}: {spark_type} != {types[field.name]}")
    if got != want:
        found += [f"only Spark: {r}" for r in list(got - want)[:3]] + [f"only SQL: {r}" for r in list(want - got)[:3]]
        found.append(f"{(got - want).total()} of {got.total()} rows differ from {want.total()}")
    return got.total(), found


SAME_TYPE = {"string": "varchar", "int": "integer", "timestamp_ntz": "timestamp"}


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = get_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names or QUERIES:
        started = time.time()
        try:
            rows, found = differences(spark, con, name, sf_dir)
        except Exception as error:  # keep going, report at the end
            rows, found = -1, [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(found)
        oracle = "oracle" if name in ORACLES else "rows only"
        print(f"{'DIFF' if found else 'ok  '} {name} {rows} rows {time.time() - started:.1f}s {oracle}", *found, sep="\n     " if found else " ", flush=True)
    print(f"{bad} with differences")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
