"""Run registered queries and their SQL side by side; also usable as a script.

python tests/oracle.py [folder] [name prefix ...]
"""

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "array<string>": "VARCHAR[]", "array<double>": "DOUBLE[]", "float": "FLOAT",
}


def sql_rows(folder, sql):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    con.execute(sql)
    columns = [(d[0], str(d[1])) for d in con.description]
    return columns, con.fetchall()


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def ordered(columns, rows):
    index = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(row[i]) for i in index) for row in rows]
    return sorted(out, key=lambda r: tuple((v is None, round(v, 3) if isinstance(v, float) else v) if not isinstance(v, tuple) else (False, str(v)) for v in r))


def compare(df, folder, sql):
    """Problems as text, empty when schema and values agree exactly."""
    columns, wanted = sql_rows(folder, sql)
    got = df.collect()
    problems = []
    kinds = {n: KINDS.get(t, t) for n, t in df.dtypes}
    if sorted(kinds) != sorted(c for c, _ in columns):
        return [f"columns {sorted(kinds)} != {sorted(c for c, _ in columns)}"]
    for name, kind in columns:
        if kinds[name] != kind:
            problems.append(f"type of {name}: {kinds[name]} != {kind}")
    if len(got) != len(wanted):
        problems.append(f"rows {len(got)} != {len(wanted)}")
        return problems
    a, b = ordered(df.columns, got), ordered([c for c, _ in columns], wanted)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        near = all(
            u == v or (isinstance(u, float) and isinstance(v, float) and math.isclose(u, v, rel_tol=1e-9, abs_tol=1e-9)) for x, y in wrong for u, v in zip(x, y)
        )
        problems.append(f"{len(wrong)} of {len(a)} rows differ{' in the last digits' if near else ''}, e.g. {wrong[0]}")
    return problems


if __name__ == "__main__":
    from parcelry.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    session = build_session("oracle", master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    session.sparkContext.setLogLevel("OFF")
    from catalogue import CHECKS, QUERIES

    bad = 0
    for name, fn in QUERIES.items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = fn(session, folder)
            if name in CHECKS:
                problems = compare(df, folder, CHECKS[name])
                note = "ok" if not problems else "; ".join(problems)[:700]
            else:
                rows = df.collect()
                problems, note = [], f"{len(rows)} rows, e.g. {str(rows[0])[:200] if rows else ''}"
        except Exception as e:
            problems, note = [e], f"{type(e).__name__}: {str(e)[:900]}"
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok '} {name} {time.time() - start:.1f}s {'' if note == 'ok' else note}", flush=True)
    print("bad:", bad)
