"""Registered queries on files: what a folder holds, and tables written and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kerbside.catalogue.tables import table
from kerbside.operators import clean, compare
from kerbside.session import shared_folder
from kerbside.sources import census, raw, schemas, sinks

QUERIES, SQL = {}, {}


def query(sql):
    def add(fn):
        QUERIES[fn.__name__] = fn
        SQL[fn.__name__] = sql
        return fn
    return add


def _folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@query(" UNION ALL ".join(f"""SELECT '{t}.parquet' AS file, 'parquet' AS kind, (SELECT count(*) FROM {t}) AS rows,
 (SELECT count(*) FROM duckdb_columns() WHERE table_name = '{t}')::BIGINT AS columns""" for t in _TABLES))
def folder_census(spark, sf):
    """The given tables, as files of a folder."""
    out = census.census(spark, sf)
    return out.filter(F.col("file").isin([f"{t}.parquet" for t in _TABLES])).select("file", "kind", "rows", "columns")


_O = "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(year(o_orderdate) AS INT) AS year, o_orderpriority FROM orders"


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("year"), "o_orderpriority")


def _yearly(spark, sf, folder, sep):
    """Orders as one raw file per year, in a single write."""
    named = _orders(spark, sf).withColumn("file", F.format_string("characteristics-%d.csv", F.col("year"))).drop("year")
    named.repartition("file").write.partitionBy("file").option("sep", sep).option("header", True).csv(folder)


@query(f"""WITH o AS ({_O}) SELECT 'characteristics-' || year || '.csv' AS file, year, '|' AS separator, count(*) AS rows, 4::BIGINT AS columns FROM o GROUP BY year""")
def yearly_census(spark, sf):
    """Years, separators, rows and columns of raw text files, found in one scan."""
    folder = _folder(spark, "raw")
    _yearly(spark, sf, folder, "|")
    return census.text_census(spark, [folder]).select("file", "year", "separator", "rows", "columns")


@query(f"WITH o AS ({_O}) SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus, o_orderpriority, 1996 AS year FROM o WHERE year = 1996")
def stage_year_read_back(spark, sf):
    """A stage written as CSV by year, one year of it read back."""
    folder = _folder(spark, "stages")
    sinks.write_stages({"F_selected": _orders(spark, sf)}, folder)
    back = raw.read_stage_year(spark, f"{folder}/F_selected", 1996, fmt="csv")
    return back.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.col("year").cast("int").alias("year"))


@query("""SELECT p AS part, true AS equal, 0::BIGINT AS only_left, 0::BIGINT AS only_right FROM (VALUES ('train_val_data.parquet'), ('train_val_data.csv'), ('train_val_data.csv.gz'),
 ('test_data.parquet'), ('test_data.csv'), ('test_data.csv.gz')) v(p)""")
def sets_read_back(spark, sf):
    """Both sets in all three formats, compared with what was written."""
    folder = _folder(spark, "sets")
    orders = _orders(spark, sf)
    train, test = clean.split_by_year(orders, "year", [2000])
    sinks.write_sets(train, test, folder)
    out = []
    for name, df in (("train_val_data", train), ("test_data", test)):
        for kind in ("parquet", "csv", "csv.gz"):
            path = f"{folder}/{name}.{kind}"
            back = spark.read.parquet(path) if kind == "parquet" else spark.read.schema(orders.schema).option("sep", ";").option("header", True).csv(path)
            out.append(compare.diff_summary(df, back).select(F.lit(f"{name}.{kind}").alias("part"), "equal", "only_left", "only_right"))
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole


_RAW = {"Num_Acc": "o_orderkey", "jour": "day(o_orderdate)", "an": "year(o_orderdate)", "com": "o_orderpriority"}


@query(f"""SELECT CAST(year(o_orderdate) AS INT) AS file_year, o_orderkey AS id_accident, day(o_orderdate)::INT AS day, year(o_orderdate)::INT AS year, o_orderpriority AS commune_code FROM orders""")
def raw_folder(spark, sf):
    """Yearly raw files written from a table, found by their years, read and typed."""
    folder = _folder(spark, "raw-files")
    o = table(spark, sf, "orders").select(*[F.expr(e).cast("string").alias(c) for c, e in _RAW.items()])
    named = o.withColumn("file", F.format_string("characteristics-%s.csv", F.col("an")))
    parts = f"{folder}-parts"
    named.repartition("file").write.partitionBy("file").option("sep", ";").option("header", True).csv(parts)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = place(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(place(folder))
    for path in raw._files(spark, f"{parts}/file=*/*.csv"):       # one part a year gets the year's name
        system.rename(place(path), place(f"{folder}/{path.split('file=')[1].split('/')[0]}"))
    found = raw.read_table(spark, folder, "circumstances")
    rows = raw.typed(clean.rename(found, schemas.RENAMES["circumstances"]))
    years = raw.years_in(spark, folder)
    return rows.filter(F.col("year").isin(years)).select("file_year", "id_accident", "day", "year", "commune_code")
