"""Compare queries with their SQL counterparts: python tests/oracle_check.py [sf_dir] [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def normal(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float):
        return (2, repr(value))
    if hasattr(value, "is_finite"):
        return (2, str(value.normalize()))
    return (1, str(value))


def compare(spark, connection, sf_dir, name, query, sql):
    """Empty string when rows and columns agree, else what differs."""
    df = query(spark, sf_dir)
    rows = df.collect()
    if sql is None:
        return f"no SQL, {len(rows)} rows" if not rows else ""
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    order = sorted(columns)
    left = sorted(tuple(normal(r[c]) for c in order) for r in rows)
    at = [columns.index(c) for c in order]
    right = sorted(tuple(normal(r[i]) for i in at) for r in expected)
    if left == right:
        return ""
    first = next((pair for pair in zip(left, right) if pair[0] != pair[1]), None)
    return f"{len(left)} rows against {len(right)}; first difference {first}"


def connect(sf_dir):
    import duckdb

    connection = duckdb.connect()
    connection.execute("set timezone='UTC'")
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return connection


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from ledgermill.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, sqls, failed = connect(sf), oracle_sql(), []
    todo = sys.argv[2:] or list(queries())
    for name in todo:
        began = time.time()
        try:
            problem = compare(spark, connection, sf, name, queries()[name], sqls.get(name))
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        note = "ok" if not problem else problem[:900]
        if problem or time.time() - began > 3:
            print(f"{name}: {time.time() - began:.1f}s {note}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(todo) - len(failed)} of {len(todo)} agree; without SQL: {sorted(set(todo) - set(sqls))}")
