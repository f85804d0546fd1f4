"""Run the registered queries and their SQL side by side and compare rows, names and values."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from ledgerlake.session import build_session  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def difference(df, sql: str, con) -> str | None:
    """None when equal, else what differs: column names, column types, or rows as a bag."""
    con.register("mine", df.toArrow())
    con.sql(f"CREATE OR REPLACE TEMP TABLE theirs AS {sql}")
    mine, theirs = con.sql("SELECT * FROM mine"), con.sql("SELECT * FROM theirs")
    have, want = dict(zip(mine.columns, map(str, mine.types))), dict(zip(theirs.columns, map(str, theirs.types)))
    if have != want:
        return f"columns {sorted(set(have.items()) ^ set(want.items()))}"
    names = ", ".join(f'"{c}"' for c in sorted(have))
    a, b = f"SELECT {names} FROM mine", f"SELECT {names} FROM theirs"
    extra = con.sql(f"({a}) EXCEPT ALL ({b})").limit(2).fetchall()
    missing = con.sql(f"({b}) EXCEPT ALL ({a})").limit(2).fetchall()
    counts = [con.sql(f"SELECT count(*) FROM {t}").fetchall()[0][0] for t in ("mine", "theirs")]
    if extra or missing:
        return f"{counts} rows of {sorted(have)}; only here {extra}; only there {missing}"
    return None if counts[0] else "both are empty"


def main() -> int:
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    oracles = entry.oracle_sql()
    for name, q in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = difference(q(spark, sf_dir), oracles[name], con) if name in oracles else "no oracle"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
