"""Compare a registered query with its SQL on the same parquet tables."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return None
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, float):
            return f"{v:.9g}"
        if isinstance(v, int):
            return f"{float(v):.9g}" if abs(v) < 2 ** 53 else str(v)
        return str(v)
    columns = sorted(frame.columns)
    return sorted((tuple(cell(v) for v in row) for row in frame[columns].itertuples(index=False, name=None)),
                  key=lambda r: tuple((x is not None, x or "") for x in r))


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    for c in spark_frame.columns:
        kinds = [f[c].dtype.kind.replace("u", "i").replace("T", "O") for f in (spark_frame, sql_frame)]
        if kinds[0] != kinds[1] and not spark_frame[c].isna().all():
            return f"column {c}: {spark_frame[c].dtype} != {sql_frame[c].dtype}"
    a, b = canonical(spark_frame), canonical(sql_frame)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}; spark {a[:2]} sql {b[:2]}"
    for x, y in zip(a, b):
        if x != y:
            return f"first difference {x} != {y}"
    return ""


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from deckmill.session import build_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session("compare", "local[8]", 8, spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(sf_dir)
    sqls = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            got = query(spark, sf_dir).toPandas()
            note = difference(got, con.execute(sqls[name]).df()) if name in sqls else "(no SQL)"
        except Exception as error:
            got, note = pd.DataFrame(), f"ERROR {str(error)[:900]}"
        bad += note not in ("", "(no SQL)")
        print(f"{'ok ' if note == '' else 'BAD' if note != '(no SQL)' else '-- '} {name:34s} {len(got):7d} {time.time() - start:6.2f}s {note}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
