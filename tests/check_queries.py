"""Check every query at one scale: ``python tests/check_queries.py [sf_dir] [name part]``."""

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from oracle import connect, difference  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    part = sys.argv[2] if len(sys.argv) > 2 else ""
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if part not in name:
            continue
        began = time.time()
        try:
            df = query(spark, sf_dir)
            found = difference(df, con, sql[name]) if name in sql else f"{df.count()} rows, no SQL"
        except Exception as e:
            found = f"{type(e).__name__}: {str(e)[:400]}"
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.time() - began:.2f}s "
              f"{found or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
