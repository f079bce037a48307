"""Run registered queries in Spark and their SQL in DuckDB and compare the results.

Usage: ``python tests/oracle_check.py [sf_dir] [name ...]``; set ``ORACLE_REPORT=path.json`` to
also write the per-query results as JSON. ``SESSION_TZ`` and ``SESSION_CONF=k=v,...`` change the
Spark session settings for the run.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duckdb_conn(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].astype(object).itertuples(index=False, name=None)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, name: str, sf_dir: str, sql: str | None, query) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_pdf = sdf.toPandas()
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_pdf), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    d_pdf = con.execute(sql).df()
    res["duck_rows"] = len(d_pdf)
    sc, sr = _rows(s_pdf)
    dc, dr = _rows(d_pdf)
    if sc != dc:
        res["status"] = f"COLUMNS spark={sc} duck={dc}"
        return res
    sd, dd = s_pdf.dtypes.astype(str).to_dict(), d_pdf.dtypes.astype(str).to_dict()
    if sd != dd:
        res["status"] = f"DTYPES {[(c, sd[c], dd[c]) for c in sc if sd[c] != dd[c]]}"
        return res
    if len(sr) != len(dr):
        res["status"] = "ROWCOUNT"
        return res
    exact = sr == dr
    if exact:
        res["status"] = "MATCH"
        return res
    # find first difference
    for a, b in zip(sr, dr):
        if a != b:
            res["status"] = "VALUES"
            res["first_diff"] = (a, b)
            break
    return res


def main(argv):
    from staffmart.session import local_session
    from __spark_entry__ import oracle_sql, queries

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = local_session(8, 8)
    if os.environ.get("SESSION_TZ"):
        spark.conf.set("spark.sql.session.timeZone", os.environ["SESSION_TZ"])
    for kv in filter(None, os.environ.get("SESSION_CONF", "").split(",")):
        k, v = kv.split("=", 1)
        spark.conf.set(k, v)
    con = duckdb_conn(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    report = []
    for name in names or list(qs):
        try:
            r = compare(spark, con, name, sf_dir, sqls.get(name), qs[name])
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("MATCH", "rows-only"):
            bad += 1
        print(r, flush=True)
        report.append({k: (str(v) if k == "first_diff" else v) for k, v in r.items()})
    print(f"{bad} problems")
    if os.environ.get("ORACLE_REPORT"):
        import json

        with open(os.environ["ORACLE_REPORT"], "w") as fh:
            json.dump({"sf_dir": sf_dir, "problems": bad, "queries": report}, fh, indent=1)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
