"""Runs queries and their SQL side by side: python tests/compare.py [--sf 0.01] [PATTERN ...]"""

from __future__ import annotations

import math
import re
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings eval_items health_systems hifld_hospitals locations mix_targets normalized_providers organizations provider_snapshots providers spool_resources".split()


def canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return f"{v:.6g}"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return str([canon(x) for x in v])
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), Counter(tuple(canon(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name, query, sql):
    """None if equal, else what differs."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None, sum(got[1].values())
    cur = con.execute(sql)
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} against {want[0]}", 0
    if got[1] != want[1]:
        return f"{sum(got[1].values())} rows against {sum(want[1].values())}; only here {list((got[1] - want[1]).items())[:3]}; only in SQL {list((want[1] - got[1]).items())[:3]}", 0
    return None, sum(got[1].values())


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main(args):
    import __spark_entry__ as e
    from rosterlake.session import build_session

    sf = args[args.index("--sf") + 1] if "--sf" in args else "0.01"
    pats = [a for i, a in enumerate(args) if a != "--sf" and (i == 0 or args[i - 1] != "--sf")] or ["."]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), e.oracle_sql(), 0
    for name, q in e.queries().items():
        if not any(re.search(p, name) for p in pats):
            continue
        t = time.time()
        try:
            said, n = compare(spark, con, sf_dir, name, q, sqls.get(name))
        except Exception as ex:  # noqa: BLE001
            said, n = f"{type(ex).__name__}: {str(ex)[:900]}", 0
        bad += said is not None
        print(f"{'ok ' if said is None else 'BAD'} {name} {n} rows {time.time() - t:.1f}s {'' if name in sqls else '(no SQL)'} {said or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
