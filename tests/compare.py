"""Runs queries beside their SQL: python tests/compare.py SF_DIR [NAME...]. Prints one line a query; exit 1 if any differ."""

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings cve fix_commit commit_file func raw_record eval_item job_setting".split()


def duck(d: str):
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    return c


def plain(v):
    import datetime
    import decimal

    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.9g}"
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, int):
        return f"{float(v):.9g}" if abs(v) < 2**50 else str(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(plain(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{plain(k)}:{plain(x)}" for k, x in sorted(v.items())) + "}"
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, fn, sql, d):
    df = fn(spark, d)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return "rows", len(got), ""
    cur = con.execute(sql)
    cols = [x[0] for x in cur.description]
    want = rows_of(cols, cur.fetchall())
    if sorted(cols) != sorted(df.columns):
        return "COLUMNS", len(got), f"{sorted(df.columns)} {sorted(cols)}"
    if got == want:
        return "ok", len(got), ""
    a, b = sorted(set(got) - set(want)), sorted(set(want) - set(got))
    return "DIFF", len(got), f"{len(got)} rows against {len(want)}; only here {len(a)}: {a[:3]}; only SQL {len(b)}: {b[:3]}"


def main():
    import __spark_entry__ as e
    from codequarry.session import local_session

    d, names = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, qs, sql = duck(d), e.queries(), e.oracle_sql()
    bad = 0
    for n in [x for x in qs if not names or any(x == y or (y.endswith("*") and x.startswith(y[:-1])) for y in names)]:
        t = time.time()
        try:
            state, k, why = compare(spark, con, qs[n], sql.get(n), d)
        except Exception as ex:
            state, k, why = "ERROR", 0, str(ex)[:1500]
        bad += state not in ("ok", "rows")
        print(f"{n}: {state} {k} rows {time.time() - t:.1f}s {why}"[:2500], flush=True)
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
