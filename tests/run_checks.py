"""python -m tests.run_checks [sf_dir] [name...]: every registered query against its SQL."""

import sys
import traceback

from tests.compare import check, connect


def main():
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries), set(sql) - set(queries)
    failed = 0
    for n, fn in queries.items():
        if names and n not in names:
            continue
        try:
            ok, k, t, note = check(spark, con, n, fn, sql.get(n), sf)
        except Exception as e:
            ok, k, t, note = False, 0, 0, "".join(traceback.format_exception_only(e))[-700:]
            if names:
                traceback.print_exc()
        failed += ok is False
        print(f"{'rows' if ok is None else 'ok' if ok else 'FAIL':5} {n:28} {k:8} {t:6.2f}s {note}", flush=True)
    print(len(queries), "queries", len(sql), "with SQL", failed, "failed")


if __name__ == "__main__":
    main()
