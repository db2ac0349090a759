"""Side-by-side check of a registered query against its oracle SQL in
DuckDB (used by tests and by hand: ``python -m seqscore.plans.check``)."""

from __future__ import annotations

import hashlib
import math
import sys
import time


def duck_views(sf_dir: str):
    import duckdb
    from seqscore.sources.tables import TABLES, table_path
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    """Exact comparison: NaN counts as NULL and -0.0 as 0.0; doubles are not
    rounded here (both sides already round to the documented digits, and
    they agree bit for bit)."""
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canonical(rows: list[tuple]) -> list[tuple]:
    return sorted((tuple(_norm(v) for v in r) for r in rows), key=repr)


def digest(rows: list[tuple]) -> str:
    return hashlib.sha256(repr(canonical(rows)).encode()).hexdigest()[:16]


def compare(spark, sf_dir: str, name: str, con=None, verbose: bool = True) -> dict:
    from seqscore.plans.catalog import QUERIES
    from seqscore.plans.oracle import QUERIES as SQL
    con = con or duck_views(sf_dir)
    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir)
    cols = sorted(sdf.columns)
    srows = [tuple(r[c] for c in cols) for r in sdf.collect()]
    t1 = time.time()
    out = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if name not in SQL:
        out["oracle"] = None
        return out
    rel = con.execute(SQL[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    idx = {c: i for i, c in enumerate(dcols)}
    out["duck_sec"] = round(time.time() - t1, 2)
    out["oracle_rows"] = len(drows)
    out["schema_match"] = sorted(dcols) == cols
    if out["schema_match"]:
        drows = [tuple(r[idx[c]] for c in cols) for r in drows]
        a, b = canonical(srows), canonical(drows)
        out["match"] = a == b
        if not out["match"] and verbose:
            sa, sb = set(a), set(b)
            out["only_spark"] = [x for x in a if x not in sb][:3]
            out["only_oracle"] = [x for x in b if x not in sa][:3]
    else:
        out["match"] = False
        out["spark_cols"], out["oracle_cols"] = cols, sorted(dcols)
    return out


def main(argv: list[str]) -> int:
    from seqscore.session import local_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = local_session(4, 8)
    from seqscore.plans.catalog import QUERIES
    con = duck_views(sf_dir)
    bad = 0
    for n in names or list(QUERIES):
        try:
            r = compare(spark, sf_dir, n, con)
        except Exception as e:  # report and continue
            r = {"name": n, "error": repr(e)[:400]}
        print(r, flush=True)
        if not r.get("match", r.get("oracle", 1) is None):
            bad += 1
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
