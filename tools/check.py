"""Runs every registered query next to its SQL and compares names, types and rows.

    python tools/check.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from wakeline.plans.catalog import QUERIES, SQL  # noqa: E402
from wakeline.session import spark_session  # noqa: E402

SAME = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE",
}


def cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(row[i]) for i in order) for row in rows)


def main(sf_dir="/root/testdata/sf0.01", *prefixes):
    spark = spark_session(
        "check", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for path in glob.glob(sf_dir + "/*.parquet"):
        db.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    bad = 0
    for name, query in QUERIES.items():
        if prefixes and not name.startswith(prefixes):
            continue
        began = time.time()
        try:
            df = query(spark, sf_dir)
            rows = df.collect()
        except Exception as error:  # report and go on
            bad += 1
            print(f"FAIL {name}: {str(error)[:600]}")
            continue
        spent = time.time() - began
        if name not in SQL:
            print(f"rows {name}: {len(rows)} in {spent:.2f}s")
            continue
        began = time.time()
        try:
            want = db.sql(SQL[name])
            names, types, expected = want.columns, want.types, want.fetchall()
        except Exception as error:
            bad += 1
            print(f"FAIL {name} (sql): {str(error)[:600]}")
            continue
        sql_spent = time.time() - began
        notes = []
        ours = {f.name: SAME.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
        theirs = dict(zip(names, map(str, types)))
        if ours != theirs:
            notes.append(f"schema {set(ours.items()) ^ set(theirs.items())}")
        a, b = bag(df.columns, rows), bag(names, expected)
        if a != b:
            notes.append(
                f"rows {len(rows)} vs {len(expected)}; ours {list((a - b).items())[:3]} sql {list((b - a).items())[:3]}"
            )
        bad += bool(notes)
        print(f"{'DIFF' if notes else 'ok  '} {name}: {len(rows)} rows, {spent:.2f}s / sql {sql_spent:.2f}s {' | '.join(notes)}")
    print(f"{bad} not right of {len(QUERIES)} ({len(SQL)} with SQL)")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
