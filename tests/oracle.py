"""Compare a registered query with its SQL on DuckDB, value by value."""

import datetime
import decimal
import glob
import math
import os
import sys

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    names, left = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    other, right = rows_of(columns, result.fetchall())
    if names != other:
        return f"columns {names} != {other}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"row {a[:3]}: " + ", ".join(f"{n}: {x!r} != {y!r}" for n, x, y in zip(names, a, b) if x != y)
    return None


if __name__ == "__main__":
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry_module
    from clientele.session import build_session

    sf = sys.argv[1]
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    bad = 0
    for name in queries:
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, queries[name], oracles[name], sf_dir)
            else:
                problem = None
                n = len(queries[name](spark, sf_dir).collect())
                if n == 0:
                    problem = "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        took = time.time() - start
        flag = "ok " if problem is None else "BAD"
        bad += problem is not None
        print(f"{flag} {name} {took:.1f}s {'' if name in oracles else '(rows only)'} {problem or ''}", flush=True)
    print("bad:", bad)
