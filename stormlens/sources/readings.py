"""Sources and sinks for station readings.

Canonical raw schema (D1): ``station_id, name, data_timestamp, rain_mm, trace``.
NaN is turned into NULL at the door (trap T1) so every aggregate skips missing
values the way the original data-frame code did.
"""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names of the raw yearly rain-gauge CSV exports.
RAW_COLUMNS = {
    "POS HUJAN ID": "station_id",
    "NAME": "name",
    "DATA TIMESTAMP": "data_timestamp",
    "RAINFALL DAY MM": "rain_mm",
    "RAINFALL TRACE": "trace",
}

READINGS_SCHEMA = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("data_timestamp", T.StringType()),
    T.StructField("rain_mm", T.DoubleType()),
    T.StructField("trace", T.StringType()),
])


def nan_to_null(df: DataFrame, cols=None) -> DataFrame:
    """Replace floating NaN by NULL in the given (default: all floating) columns."""
    floats = [f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.DoubleType, T.FloatType))
              and (cols is None or f.name in cols)]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType))
                           for c in floats}) if floats else df


def _canonical(df: DataFrame) -> DataFrame:
    renamed = df.withColumnsRenamed({k: v for k, v in RAW_COLUMNS.items() if k in df.columns})
    for f in READINGS_SCHEMA.fields:
        if f.name not in renamed.columns:
            renamed = renamed.withColumn(f.name, F.lit(None).cast(f.dataType))
        else:
            # try_cast: an empty or malformed field becomes NULL instead of failing.
            renamed = renamed.withColumn(f.name, F.col(f"`{f.name}`").try_cast(f.dataType))
    return nan_to_null(renamed, ["rain_mm"])


def csv_headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """{header: files} of the CSV files that ``path`` (a file, a folder or a glob) names. Only
    the first line of each file is read, through Spark's file systems."""
    sc = spark.sparkContext
    jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(conf)
    found: dict[tuple[str, ...], list[str]] = {}
    for status in fs.globStatus(top) or []:
        inner = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        for f in inner:
            name = f.getPath().getName()
            if f.isDirectory() or name.startswith(("_", ".")):
                continue
            stream = jvm.java.io.InputStreamReader(fs.open(f.getPath()), "UTF-8")
            line = jvm.java.io.BufferedReader(stream)
            try:
                first = line.readLine()
            finally:
                line.close()
            header = tuple(next(csv.reader([(first or "").lstrip("\ufeff")]), []))
            found.setdefault(header, []).append(f.getPath().toString())
    return found


def read_readings(spark: SparkSession, paths, fmt: str = "csv") -> DataFrame:
    """Read every yearly export and union them by column name.

    ``paths`` is a glob or a list of globs. CSV files are grouped by their header, so files
    under one glob may differ in the order and the set of their columns; each group is
    one scan, groups are unioned by name with missing columns as NULL. Files without
    any line hold no rows."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    frames = []
    for p in paths:
        if fmt != "csv":
            frames.append(_canonical(spark.read.format(fmt).load(p)))
            continue
        for header, files in csv_headers(spark, p).items():
            if header:
                # All-string read: types are applied once in _canonical, never inferred.
                schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
                frames.append(_canonical(spark.read.schema(schema).option("header", True).csv(files)))
    if not frames:
        raise FileNotFoundError(f"no readings under {paths}")
    columns = [f.name for f in READINGS_SCHEMA.fields]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).select(
        *columns, *sorted({c for f in frames for c in f.columns} - set(columns)))


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType,
                   date_cols=()) -> DataFrame:
    """CSV with header and an explicit schema; listed columns parsed as dates."""
    df = (spark.read.schema(schema).option("header", True).option("nullValue", "")
          .option("mode", "PERMISSIVE").csv(path))
    return df.withColumns({c: F.to_date(F.col(c)) for c in date_cols}) if date_cols else df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=(),
                mode: str = "overwrite") -> None:
    """S3: write a result table (Parquet by default, CSV with header on request)."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_bucketed(df: DataFrame, name: str, path: str, by: str = "station", order=("station", "obs_date"), buckets: int = 8) -> DataFrame:
    """S3 as a stored layout: a table in ``buckets`` buckets by hash of ``by``, one sorted file each (rows of a key lie
    together). Windows and joins on ``by`` over tables of as many buckets need no exchange. ``path`` is the
    folder that the table's files stand in. Returns the table."""
    spark = df.sparkSession
    df.repartition(buckets, by).write.mode("overwrite").option("path", path).bucketBy(buckets, by).sortBy(*order).saveAsTable(name)
    return spark.table(name)


def write_sorted(df: DataFrame, path: str, order) -> None:
    """O3: write ``df`` in a total order over all files (range-partitioned, sorted within each file)."""
    df.orderBy(*order).write.mode("overwrite").parquet(path)


def read_in_order(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a sorted table with ``place``, their number over all files from 0: the sizes of the files before
    (one row a file) and the row's index within its own, both from the files' metadata."""
    rows = spark.read.parquet(path).select("*", F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("long").alias("_file"),
                                           F.col("_metadata.row_index").alias("_row"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(F.col("_file").alias("_of")).agg(F.count("*").alias("_n")).withColumnRenamed("_of", "_file") \
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return rows.join(sizes, "_file").withColumn("place", F.col("_before") + F.col("_row")).drop("_file", "_row", "_before")


# ---------------------------------------------------------------------------
# Portable fixture adapter: the driver's ``orders`` table seen as rain readings.
# The same mapping is written as SQL in ``plans/fixture.py`` for the DuckDB oracle.
# ---------------------------------------------------------------------------

def readings_from_orders(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    x = F.col("o_totalprice") / F.lit(5e5)
    rain = (F.when(k % 101 == 0, F.lit(9999.0))
            .when(k % 37 == 0, F.lit(8888.0))
            .when(k % 53 == 0, F.lit(None).cast("double"))
            .when(k % 2 == 0, F.lit(0.0))
            .otherwise(F.floor(x * x * x * x * F.lit(2500.0)) / F.lit(10.0)))
    return orders.select(
        k.alias("rid"),
        F.concat(F.when(F.col("o_orderstatus") == "P", F.lit("1301")).otherwise(F.lit("1371")),
                 F.substring("o_orderpriority", 1, 1), F.lit("0a")).alias("station_id"),
        F.expr("substr(o_orderpriority, 3)").alias("name"),
        F.concat(F.to_date("o_orderdate").cast("string"), F.lit(" 00:00:00.0 +0:00"))
         .alias("data_timestamp"),
        rain.alias("rain_mm"),
        F.when((k % 37 == 0) & (k % 5 == 0), F.lit("Y")).otherwise(F.lit("N")).alias("trace"),
    )


def load_fixture_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings derived from ``<sf_dir>/orders.parquet`` (only the six needed columns
    are read: the projection reaches the Parquet scan as ``ReadSchema``)."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return readings_from_orders(orders)
