"""Raw files under keys of their own: one file for each symbol and day, written once.

A Python data source writes them: tasks write whole files beside the store's keys, and the driver moves them
to their keys when all tasks are done, as Spark's own committers do. Keys that exist are left alone.
"""

from __future__ import annotations

import gzip
import json
import uuid
from collections.abc import Iterator
from contextlib import ExitStack
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tidewell.functions.keys import raw_key
from tidewell.session import settle
from tidewell.sources.listing import listed

#: A raw record's columns in order.
COLUMNS = ("symbol", "timestamp", "open", "high", "low", "close", "adjusted_close", "volume")
STAGING = "_staging-"


def place(root: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a folder, which may be a URI of a shared store, and the folder's path in it."""
    return pa.fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:/") else (pa.fs.LocalFileSystem(), root)


def _line(record: dict, kind: str) -> str:
    if kind == "csv":
        return ",".join("" if (v := record[c]) is None else v if isinstance(v, str) else "%g" % v for c in COLUMNS) + "\n"
    return json.dumps({c: record[c] for c in COLUMNS}, ensure_ascii=False) + "\n"


@dataclass
class Written(WriterCommitMessage):
    #: (staged path, key) of each file of a task.
    files: list[tuple[str, str]]


class RawFilesWriter(DataSourceArrowWriter):
    """Rows ``key, *COLUMNS``, those of a key together: a file for each key."""

    def __init__(self, options: dict):
        self.root, self.kind, self.gzip = options["path"].rstrip("/"), options["kind"], options.get("gzip", "false") == "true"
        self.staging = f"{STAGING}{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = place(self.root)
        folder, files, key, out = f"{root}/{self.staging}/{uuid.uuid4().hex}", [], None, None
        with ExitStack() as open_file:
            for batch in iterator:
                for record in batch.to_pylist():
                    if record["key"] != key:
                        open_file.close()
                        key, out = record["key"], None
                        if fs.get_file_info(f"{root}/{key}").type == pa.fs.FileType.NotFound:
                            files.append((f"{folder}/{len(files)}", key))
                            fs.create_dir(folder, recursive=True)
                            out = open_file.enter_context(fs.open_output_stream(files[-1][0], compression=None))
                            out = open_file.enter_context(gzip.GzipFile(fileobj=out, mode="wb", mtime=0)) if self.gzip else out
                            if self.kind == "csv":
                                out.write((",".join(COLUMNS) + "\n").encode())
                    if out:
                        out.write(_line(record, self.kind).encode())
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = place(self.root)
        for m in messages:
            for staged, key in m.files if m else ():
                if fs.get_file_info(f"{root}/{key}").type == pa.fs.FileType.NotFound:
                    fs.create_dir(f"{root}/{key}".rpartition("/")[0], recursive=True)
                    fs.move(staged, f"{root}/{key}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = place(self.root)
        if fs.get_file_info(f"{root}/{self.staging}").type != pa.fs.FileType.NotFound:
            fs.delete_dir(f"{root}/{self.staging}")


class RawFiles(DataSource):
    """``df(key, *COLUMNS).write.format("tidewell_raw").option("path", ...).option("kind", "json" or "csv").option("gzip", ...).mode("append")``"""

    @classmethod
    def name(cls) -> str:
        return "tidewell_raw"

    def writer(self, schema, overwrite: bool) -> RawFilesWriter:
        if overwrite:
            raise ValueError("raw files are written once: append")
        return RawFilesWriter(self.options)


def file_kind(file_type: str) -> str:
    """Raw files are CSV or JSON lines; any other type is written as JSON."""
    return "csv" if file_type.lower() == "csv" else "json"


def with_raw_key(df: DataFrame, domain: Column, table_name: Column, interval: Column, source: Column, file_type: str = "json", gzip: bool = False) -> DataFrame:
    """``df(*COLUMNS)`` with ``ds``, the UTC day of ``timestamp``, and ``key``; rows without a symbol or a time have no key and are left out."""
    ds = F.date_format(F.try_to_timestamp("timestamp"), "yyyy-MM-dd")
    rows = df.withColumn("ds", ds)
    return rows.withColumn("key", raw_key(domain, table_name, interval, source, F.col("ds"), F.col("symbol"), file_kind(file_type), gzip)).where("key IS NOT NULL")


def write_raw_files(df: DataFrame, root: str, domain: str, table_name: str, interval: str, source: str, file_type: str = "json", gzip: bool = False) -> DataFrame:
    """Write the raw files of ``df(*COLUMNS)`` whose keys don't exist yet; ``ds, symbol, key, records`` of these, as manifests list them.

    Records of a file are in the order of their times. The keys that exist are found by listing the store, once,
    before anything is written; a key that another run writes meanwhile is left alone too. A failed run leaves no file.
    """
    spark = df.sparkSession
    lit = F.lit
    rows = with_raw_key(df, lit(domain), lit(table_name), lit(interval), lit(source), file_type, gzip)
    there = listed(spark, root).select(F.col("key"))
    new = settle(rows.groupBy("ds", "symbol", "key").agg(F.count("*").alias("records")).join(there, "key", "left_anti").select("ds", "symbol", "key", "records"))
    spark.dataSource.register(RawFiles)
    wanted = rows.join(new.select("key"), "key", "left_semi").select("key", *[F.col(c).cast("string" if c in COLUMNS[:2] else "double").alias(c) for c in COLUMNS])
    wanted.repartition("key").sortWithinPartitions("key", "timestamp").write.format("tidewell_raw").option("path", root).option("kind", file_kind(file_type)).option("gzip", str(gzip).lower()).mode("append").save()
    return new
