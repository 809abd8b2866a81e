"""Run registered queries and compare each with its SQL on the same tables."""

import datetime as dt
import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, dt.datetime) and value.tzinfo:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def type_differences(con, df, sql):
    """Columns whose type differs between the two results."""
    want = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    return {c: (t, want.get(c)) for c, t in df.dtypes if SAME_TYPE.get(t) != want.get(c)}


def compare(con, df, sql):
    """None when equal, else a short description of the difference."""
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want = normal(want_columns, result.fetchall())
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} vs {sorted(want_columns)}"
    types = type_differences(con, df, sql)
    if types:
        return f"types {types}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    different = [(g, w) for g, w in zip(got, want) if g != w]
    if different:
        return f"{len(different)} of {len(got)} rows differ, first {different[0]}"
    return None


def main(sf_dir, names):
    root = Path(__file__).resolve().parents[1]
    sys.path.insert(0, str(root))
    import __spark_entry__ as entry
    from tidelake import get_spark

    spark = get_spark("oracle", "local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                verdict = compare(con, df, oracles[name])
                detail = f"{df.count() if verdict else ''}"
            else:
                verdict, detail = None, f"{df.count()} rows, no oracle"
        except Exception as error:  # report and go on with the next query
            verdict, detail = f"{type(error).__name__}: {str(error)[:700]}", ""
        bad += verdict is not None
        print(f"{'OK ' if verdict is None else 'BAD'} {name} {time.time() - start:.1f}s {verdict or ''} {detail}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
