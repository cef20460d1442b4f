"""Runs registered queries next to their SQL twins; also a script: ``python tests/compare.py SF_DIR [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([normal(row[i]) for i in order] for row in rows), key=repr)


def differences(spark, con, name, sf_dir, queries, oracles) -> list[str]:
    df = queries[name](spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    result = con.execute(oracles[name])
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    kinds = {type(v) for row in mine for v in row}, {type(v) for row in theirs for v in row}
    found = [] if kinds[0] == kinds[1] else [f"types {kinds[0]} != {kinds[1]}"]
    if len(mine) != len(theirs):
        found.append(f"{len(mine)} rows != {len(theirs)} rows")
    unequal = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if unequal:
        found.append(f"{len(unequal)} rows differ, first: {str(unequal[0][0])[:400]} != {str(unequal[0][1])[:400]}")
    return found


if __name__ == "__main__":
    import __spark_entry__ as entry

    from folioscope.session import build_session

    session = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    folder = sys.argv[1]
    chosen = sys.argv[2:] or list(entry.queries())
    connection = duck(folder)
    for each in chosen:
        start = time.time()
        try:
            if each in entry.oracle_sql():
                bad = differences(session, connection, each, folder, entry.queries(), entry.oracle_sql())
                print(f"{each}: {'ok' if not bad else bad} {time.time() - start:.1f}s", flush=True)
            else:
                print(f"{each}: {entry.queries()[each](session, folder).count()} rows {time.time() - start:.1f}s", flush=True)
        except Exception as error:  # noqa: BLE001
            print(f"{each}: FAILED {str(error)[:700]} {time.time() - start:.1f}s", flush=True)
