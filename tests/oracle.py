"""Run registered queries beside their SQL and compare all rows.

``python tests/oracle.py FOLDER [name ...]`` prints one line per query.
"""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(folder):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return db


def _key(row):
    return tuple((v is None, str(v)) for v in row)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=_key)


def same_cell(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return type(a) is type(b) and a == b


def difference(df, db, sql):
    """None when columns, types of cells and all rows agree, else a short text."""
    mine = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    found = db.execute(sql)
    theirs = sorted_rows([d[0] for d in found.description], found.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} / {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows / {len(theirs[1])}"
    bad = [(a, b) for a, b in zip(mine[1], theirs[1]) if not all(map(same_cell, a, b))]
    return f"{len(bad)} of {len(mine[1])} rows differ, first {bad[0]}" if bad else None


def main(folder, names):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, sql = connect(folder), entry.oracle_sql()
    failed = 0
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            df = fn(spark, folder)
            if name in sql:
                wrong = difference(df, db, sql[name])
                verdict = "same" if wrong is None else f"DIFFERENT {wrong}"
            else:
                verdict = f"{len(df.collect())} rows, no SQL"
        except Exception as error:  # keep going, report all
            verdict = f"ERROR {type(error).__name__} {str(error)[:600]}"
        failed += verdict.startswith(("DIFF", "ERR"))
        print(f"{name:26s} {time.time() - began:6.2f}s {verdict}", flush=True)
    print("failed:", failed)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
