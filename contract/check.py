"""Run registered queries beside their SQL twins and report differences.

    python -m contract.check [folder] [query ...]
"""

import sys
import time

import duckdb
import pandas as pd

from contract.oracles import oracles
from contract.queries import all_queries
from teamlines.session import local_session

TABLES = ["orders", "lineitem", "customer"]


def canonical(frame):
    """Rows as sorted tuples under sorted column names, missing values as None."""
    names = sorted(frame.columns)

    def plain(value):
        if pd.isna(value):
            return None
        if hasattr(value, "isoformat"):
            return value.isoformat()[:10]
        return value if isinstance(value, str) else float(value)

    rows = [tuple(map(plain, row)) for row in frame[names].astype(object).itertuples(index=False)]
    return names, sorted(rows, key=repr)


def duck(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def compare(spark, connection, folder, name):
    """None if equal, else a short description of the difference."""
    ours = canonical(all_queries()[name](spark, folder).toPandas())
    theirs = canonical(connection.sql(oracles()[name]).df())
    if ours[0] != theirs[0]:
        return f"columns differ: {sorted(set(ours[0]) ^ set(theirs[0]))}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows, expected {len(theirs[1])}"
    wrong = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    if wrong:
        a, b = wrong[0]
        fields = [(n, x, y) for n, x, y in zip(ours[0], a, b) if x != y]
        return f"{len(wrong)} rows differ, first in {fields[:4]}"
    return None


def main(folder="/root/testdata/sf0.001", *names):
    spark, connection = local_session(8), duck(folder)
    for name in names or all_queries():
        start = time.time()
        if name in oracles():
            found = compare(spark, connection, folder, name)
        else:
            rows = all_queries()[name](spark, folder).count()
            found = None if rows else "no rows"
        print(f"{name:28s} {time.time() - start:6.1f}s  {found or 'ok'}", flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
