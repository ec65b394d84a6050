"""Run registered queries against their SQL by hand: ``check.py <sf_dir> [name …]``."""

from __future__ import annotations

import sys
import tempfile
import time
import traceback
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

import oracle  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


def main() -> None:
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="check-"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle.connect(sf_dir)
    sqls = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.perf_counter()
        try:
            df = query(spark, sf_dir)
            names, rows = oracle.spark_rows(df)
            seconds = time.perf_counter() - start
            if name not in sqls:
                print(f"rows  {name} {sum(rows.values())} {seconds:.2f}s", flush=True)
                continue
            sql_names, expected = oracle.sql_rows(connection, sqls[name])
            types, sql_types = oracle.spark_types(df), oracle.sql_types(connection, sqls[name])
            problems = []
            if names != sql_names:
                problems.append(f"columns {names} / {sql_names}")
            if types != sql_types:
                problems.append(f"types {types} / {sql_types}")
            if rows != expected:
                problems.append(
                    f"rows {sum(rows.values())} / {sum(expected.values())}"
                    f" spark-only {list((rows - expected).items())[:3]}"
                    f" sql-only {list((expected - rows).items())[:3]}"
                )
            verdict = "FAIL" if problems else "ok"
            print(f"{verdict:5} {name} {sum(rows.values())} {seconds:.2f}s", *problems, flush=True)
            bad += bool(problems)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            bad += 1
            text = str(error).splitlines()
            print("ERROR", name, type(error).__name__, *text[:3], flush=True)
            if wanted:
                traceback.print_exc()
    print("bad", bad)


if __name__ == "__main__":
    main()
