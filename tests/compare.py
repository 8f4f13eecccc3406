"""Compare queries with their SQL on a folder of tables: python tests/compare.py FOLDER [NAME...]"""

import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in sorted(Path(folder).glob("*.parquet")):
        at = f"{p}/*.parquet" if p.is_dir() else str(p)
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{at}'")
    return con


def plain(value):
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, (list, tuple)):
        return tuple(plain(x) for x in value)
    if isinstance(value, float):
        return "nan" if value != value else round(value, 6)
    if type(value).__name__ == "Decimal":
        return round(float(value), 6)
    return value


def rows_of(columns, rows) -> tuple[list, list]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, folder: str, name: str, query, sql: str | None) -> str:
    began = time.time()
    df = query(spark, folder)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - began
    if sql is None:
        return f"rows-only {len(mine[1])} {took:.1f}s"
    cur = con.execute(sql)
    theirs = rows_of([d[0] for d in cur.description], cur.fetchall())
    if mine == theirs:
        return f"ok {len(mine[1])} {took:.1f}s"
    a, b = set(mine[1]), set(theirs[1])
    return f"DIFFERS columns {mine[0] == theirs[0]} {mine[0]} {theirs[0]} rows {len(mine[1])} {len(theirs[1])}; only mine {list(a - b)[:3]}; only SQL {list(b - a)[:3]} {took:.1f}s"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from decisionlake.session import local_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    con, queries, sqls = connection(folder), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        try:
            said = compare(spark, con, folder, name, queries[name], sqls.get(name))
        except Exception as e:  # noqa: BLE001
            said = f"ERROR {type(e).__name__} {str(e)[:1500]}"
        bad += said.startswith(("DIFFERS", "ERROR"))
        print(name, said, flush=True)
    print("bad", bad)
