"""Spark-vs-DuckDB parity check for the registered queries.

Usage: ``python -m tests.parity [sf_dir] [name ...]``. Compares column
names, row counts and order-insensitive values (exactly, after the shared
display rounding), reporting the largest numeric gap on a mismatch.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if hasattr(v, "item") and not isinstance(v, (list, tuple, dict)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, repr(x)) for x in row)


_FAMILY = {"IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
           "DateType": "DATE", "BooleanType": "BOOLEAN", "TimestampNTZType": "TIMESTAMP",
           "TimestampType": "TIMESTAMP", "FloatType": "FLOAT", "ShortType": "SMALLINT", "ByteType": "TINYINT"}


def spark_types(df):
    return {f.name: _FAMILY.get(type(f.dataType).__name__, type(f.dataType).__name__) for f in df.schema.fields}


def duck_types(con, sql):
    rel = con.sql(sql)
    return {n: str(t) for n, t in zip(rel.columns, rel.types)}


def rows_spark(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()), key=_key)


def rows_duck(con, sql):
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    data = res.fetchall()
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, sorted((tuple(_norm(r[i]) for i in idx) for r in data), key=_key)


def compare(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    df = fn(spark, sf_dir)
    sc, sr = rows_spark(df)
    ts = time.time() - t
    dc, dr = rows_duck(con, sql)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}", ts
    if len(sr) != len(dr):
        return False, f"rows differ: spark={len(sr)} duck={len(dr)}", ts
    bad = [(a, b) for a, b in zip(sr, dr) if a != b]
    st, dt_ = spark_types(df), duck_types(con, sql)
    tdiff = {c: (st[c], dt_.get(c)) for c in st if st[c] != dt_.get(c)}
    if not bad:
        return (not tdiff), f"{len(sr)} rows" + (f"; TYPES differ {tdiff}" if tdiff else ""), ts
    gap = 0.0
    for a, b in bad:
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, float):
                gap = max(gap, abs(x - y))
    return False, f"{len(bad)}/{len(sr)} rows differ, max numeric gap {gap:g}; first: {bad[0][0]} vs {bad[0][1]}", ts


def main(argv):
    sf_dir = "/root/testdata/sf0.01"
    if argv and argv[0].startswith("/"):
        sf_dir, argv = argv[0], argv[1:]
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from tillcast.session import get_session
    spark = get_session("local[8]", 8)
    qs, orc = queries(), oracle_sql()
    names = argv or list(qs)
    con = duck(sf_dir)
    ok = 0
    for n in names:
        if n not in orc:
            t = time.time()
            try:
                cnt = qs[n](spark, sf_dir).count()
                print(f"ROWS  {n}: {cnt} rows ({time.time() - t:.1f}s, no oracle)")
                ok += 1
            except Exception as e:  # noqa: BLE001
                print(f"ERROR {n}: {type(e).__name__}: {str(e)[:400]}")
            continue
        try:
            good, msg, ts = compare(spark, con, n, qs[n], orc[n], sf_dir)
        except Exception as e:  # noqa: BLE001
            good, msg, ts = False, f"{type(e).__name__}: {str(e)[:600]}", 0.0
        ok += good
        print(f"{'OK   ' if good else 'FAIL '} {n}: {msg} ({ts:.1f}s)")
    print(f"{ok}/{len(names)} passed")
    return 0 if ok == len(names) else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
