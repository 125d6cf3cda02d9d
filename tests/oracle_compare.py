"""Run reports and their SQL side by side: ``python -m tests.oracle_compare SF_DIR [names…]``."""

import datetime as dt
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return str(value)


def compare(con, df, sql):
    """None when equal, else a text that says what differs."""
    columns = sorted(df.columns)
    got = sorted(tuple(cell(v) for v in row) for row in df.select(*columns).collect())
    rel = con.sql(sql)
    if sorted(rel.columns) != columns:
        return f"columns {columns} != {sorted(rel.columns)}"
    order = [rel.columns.index(c) for c in columns]
    want = sorted(tuple(cell(row[i]) for i in order) for row in rel.fetchall())
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        lacking = [r for r in want if r not in set(got)][:3]
        return f"{len(got)} rows vs {len(want)}; only Spark {extra}; only SQL {lacking}"
    types = {c: (t, str(rel.types[rel.columns.index(c)])) for c, t in df.dtypes}
    same = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE", "date": "DATE",
        "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
    }
    odd = {c: pair for c, pair in types.items() if same.get(pair[0]) != pair[1]}
    return f"ok, but types differ: {odd}" if odd else None


def main(sf_dir, names):
    from ludoshelf import build_session
    from ludoshelf.plans.reports import all_reports

    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name, (query, sql) in all_reports().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            result = compare(con, df, sql) if sql else f"no SQL, {df.count()} rows"
        except Exception as problem:  # noqa: BLE001
            result = "ERROR " + str(problem)[:700]
        print(f"{name:22s} {time.time() - start:6.1f}s  {result or 'equal'}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
