"""Reading the lakehouse layers and listing their files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapflow.schemas import BRONZE, FILE_LISTING, SILVER, SOURCE_COLUMNS, STORED_SILVER
from snapflow.sources.tables import read_table


def object_store_conf(endpoint: str, path_style: bool = True, ssl: bool = False) -> dict[str, str]:
    """Session settings for an S3-compatible store reached through ``s3a://``.

    Credentials are left to the standard provider chain of the cluster.
    """
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def source_columns() -> list[Column]:
    """``SOURCE_COLUMNS`` of a Parquet scan of bronze, batch or stream."""
    path = F.regexp_extract(F.col("_metadata.file_path"), "(date=[^/]+/.+)$", 1)
    return [path.alias("__source"), F.col("_metadata.row_index").alias("__row")]


def read_bronze(spark: SparkSession, root: str, extra: Sequence[str] = (), sources: bool = False) -> DataFrame:
    """All bronze snapshots under ``root`` (``date=YYYY-MM-DD`` partitions).

    Reading the root and filtering ``date`` prunes partitions and works on an
    empty day, where a path glob would fail.  ``extra`` names further columns
    of the feed, kept as text; snapshots without them give NULL.  With
    ``sources`` each row says where it comes from.
    """
    schema = T.StructType([*BRONZE.fields, *[T.StructField(n, T.StringType(), True) for n in extra]])
    if not path_exists(spark, root):
        return spark.createDataFrame([], T.StructType([*schema.fields, *[STORED_SILVER[c] for c in SOURCE_COLUMNS if sources]]))
    scan = spark.read.schema(schema).option("basePath", root).parquet(root)
    return scan.select(*[F.col(f"`{n}`") for n in schema.fieldNames()], *(source_columns() if sources else []))


def bronze_dates(spark: SparkSession, root: str) -> list[dt.date]:
    """The days that have a bronze folder (a listing of metadata)."""
    if not path_exists(spark, root):
        return []
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(root)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory()]
    return sorted(dt.date.fromisoformat(n[5:]) for n in names if n.startswith("date=") and n[5:6].isdigit())


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    """The published silver table, in the table's column order."""
    return read_table(spark, root, SILVER)


def read_stored_silver(spark: SparkSession, root: str) -> DataFrame:
    """The published silver rows with their sources."""
    return read_table(spark, root, STORED_SILVER)


def list_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """File listing as a DataFrame: path, modificationTime, length.

    ``binaryFile`` with only these columns selected never opens the files.
    """
    if not path_exists(spark, root):
        return spark.createDataFrame([], FILE_LISTING)
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "modificationTime", "length")
    )


def partition_date(path_col: str = "path"):
    """``date=YYYY-MM-DD`` found in a path, as DATE; NULL when absent."""
    text = F.regexp_extract(F.col(path_col), r"date=(\d{4}-\d{2}-\d{2})", 1)
    return F.when(text == "", F.lit(None).cast("date")).otherwise(F.to_date(text, "yyyy-MM-dd"))
