"""Compare a registered query with its SQL oracle on one scale-factor directory."""

import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark_df, con, sql):
    """None if both sides agree, else a description of the first difference."""
    left_names, left = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    right_names, right = rows_of([d[0] for d in result.description], result.fetchall())
    if left_names != right_names:
        return f"columns {left_names} against {right_names}"
    if len(left) != len(right):
        return f"rows {len(left)} against {len(right)}: only here {[r for r in left[:5000] if r not in right][:2]}"
    for a, b in zip(left, right):
        if a != b:
            diff = [(n, x, y) for n, x, y in zip(left_names, a, b) if x != y]
            return f"row {a} against {b}: {diff}"
    kinds = [
        (n, x, y) for n, x, y in zip(left_names, left[0] if left else (), right[0] if right else ())
        if x is not None and y is not None and type(x) is not type(y)
    ]
    return f"types {kinds}" if kinds else None


def main(sf_dir, names):
    import __spark_entry__ as entry
    from moraflow.session import local_session

    spark = local_session("8")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            problem = difference(df, con, oracles[name]) if name in oracles else f"no oracle, {df.count()} rows"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
