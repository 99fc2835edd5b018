"""What is there, from the store's listing: keys, partitions and days as rows, without reading any file."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LISTED = "key string, size long, modified timestamp"
#: Folders of a layered table.
PARTS = ("year", "month", "day", "layer")


def listed(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """``key, size, modified`` of the files under a folder: keys are paths below it. No root, no rows.

    Spark lists the folders, in parallel where there are many; of the files nothing is read. Temporary and
    hidden files and folders aren't listed.
    """
    try:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        files = (reader.option("pathGlobFilter", pattern) if pattern else reader).load(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTED)
    path = F.regexp_replace("path", r"\A[a-z0-9]+:/+", "/")
    base = "/" + root.split(":", 1)[-1].strip("/") if ":" in root[:8] else root.rstrip("/")
    return files.select(F.substr(path, F.lit(len(base) + 2)).alias("key"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def part(key: Column, name: str) -> Column:
    """A key's ``name=`` folder, or null."""
    return F.nullif(F.regexp_extract(key, rf"(?:\A|/){name}=([^/]*)/", 1), F.lit(""))


def listed_partitions(spark: SparkSession, root: str, parts: tuple[str, ...] = PARTS) -> DataFrame:
    """``parts, ds, files, bytes`` of each partition that has Parquet files, quarantined ones too."""
    keys = listed(spark, root, "*.parquet")
    rows = keys.select(*[part(F.col("key"), p).alias(p) for p in parts], "size")
    rows = rows.where(" AND ".join(f"{p} IS NOT NULL" for p in parts)).groupBy(*parts).agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))
    return rows.withColumn("ds", F.concat_ws("-", "year", "month", "day")) if {"year", "month", "day"} <= set(parts) else rows


def days_there(spark: SparkSession, root: str, layer: str = "adjusted") -> DataFrame:
    """The days (``ds``) that a layer has files for: what a plan skips, or what goes on after a compaction."""
    return listed_partitions(spark, root).where(F.col("layer") == layer).select("ds").distinct()


def keys_there(spark: SparkSession, root: str) -> DataFrame:
    """``symbol, ds`` of the raw files that are there, whatever their type and compression."""
    keys = listed(spark, root)
    day = F.concat_ws("-", *[part(F.col("key"), p) for p in ("year", "month", "day")])
    return keys.select(F.regexp_extract("key", r"([^/]*)\.(?:json|csv|parquet)(?:\.gz)?\z", 1).alias("symbol"), day.alias("ds")).where("symbol <> '' AND length(ds) = 10").distinct()


def anything(spark: SparkSession, root: str) -> bool:
    """Whether there is any file under a folder, by its listing."""
    return not listed(spark, root).isEmpty()
