"""Run registered queries beside their check SQL on the given tables.

    python tests/compare.py [--sf DIR] [key …]
"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def session(cores: str = "8"):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


def ordered(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].astype(object).where(frame[sorted(frame.columns)].notna(), None)
    frame = frame.map(lambda v: v.item() if hasattr(v, "item") else v)
    keyed = frame.map(lambda v: repr(v))
    return frame.loc[keyed.sort_values(list(keyed.columns)).index].reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None when both hold the same rows."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} against {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    got, want = ordered(got), ordered(want)
    same = (got == want) | (got.isna() & want.isna())
    if same.all().all():
        return None
    row = (~same.all(axis=1)).idxmax()
    return f"{(~same.all(axis=1)).sum()} rows differ, first: {got.loc[row].to_dict()} against {want.loc[row].to_dict()}"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("keys", nargs="*")
    options = parser.parse_args()
    import __spark_entry__ as entry

    spark, db = session(), database(options.sf)
    queries, checks, bad = entry.queries(), entry.oracle_sql(), 0
    for key in options.keys or queries:
        start = time.time()
        try:
            got = queries[key](spark, options.sf).toPandas()
            spent = time.time() - start
            if key in checks:
                begun = time.time()
                want = db.execute(checks[key]).df()
                verdict = difference(got, want)
                text = "same" if verdict is None else f"DIFFERENT {verdict}"
                text += f" (sql {time.time() - begun:.1f}s)"
            else:
                verdict, text = None, "no sql"
        except Exception as error:
            verdict = text = f"ERROR {str(error)[:600]}"
            spent, got = time.time() - start, []
        bad += verdict is not None
        print(f"{key:28} {len(got):7} rows {spent:6.1f}s {text}", flush=True)
    print(f"{bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
