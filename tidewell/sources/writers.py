"""Writers of layered tables, manifests and messages."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tidewell.functions.prices import adjust
from tidewell.operators.batches import manifests
from tidewell.operators.load import ledger
from tidewell.operators.quality import Gate, day_verdicts, no_data, split_by_verdict
from tidewell.operators.schema_versions import fingerprint
from tidewell.session import settle
from tidewell.sources.catalog import ALL_LAYERS, shown_type, sync_table
from tidewell.sources.listing import listed_partitions
from tidewell.sources.readers import has_rows


def dated(df: DataFrame, **layer: str) -> DataFrame:
    parts = F.split("ds", "-")
    return df.withColumns({"year": parts[0], "month": parts[1], "day": parts[2]} | {k: F.lit(v) for k, v in layer.items()})


def write_layer(df: DataFrame, root: str, layer: str, codec: str = "zstd") -> None:
    """Days of a layer, each partition that has rows overwritten and no other; many days in one job.

    Rows meet by day and a spread, and Spark's rebalance splits the days with many rows over tasks.
    """
    out = dated(df, layer=layer).hint("rebalance", "year", "month", "day")
    out.write.partitionBy("year", "month", "day", "layer").option("partitionOverwriteMode", "dynamic").option("compression", codec).mode("overwrite").parquet(root)


@contextmanager
def advised(spark: SparkSession, megabytes: int) -> Iterator[None]:
    """Rebalanced partitions of about so many megabytes, of 32 at least; the session's own size comes back after."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name, None)
    spark.conf.set(name, f"{max(32, megabytes)}m")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def compact(df: DataFrame, path: str, codec: str = "zstd", max_records: int = 5_000_000, target_mb: int = 256) -> bool:
    """One folder of files of the target size, at least 32 MB. Without rows nothing is written; whether there were any."""
    if not has_rows(df):
        return False
    with advised(df.sparkSession, target_mb):
        df.hint("rebalance").write.option("compression", codec).option("maxRecordsPerFile", max_records).mode("overwrite").parquet(path)
    return True


def gate_and_write(df: DataFrame, root: str, gate: Gate = Gate(), fail: bool = True) -> DataFrame:
    """Quarantine the failing days' rows, write the others' curated rows, then raise with the failing days' messages if asked.

    Without rows nothing is written, and NO_RAW_DATA is raised if asked. Verdicts, one row per day, are
    written once and decide both layers; they are returned.
    """
    verdicts = settle(day_verdicts(df, gate))
    if verdicts.isEmpty():
        verdicts = no_data(df.sparkSession, gate)
        if fail:
            raise ValueError("; ".join(verdicts.first().messages))
        return verdicts
    good, bad = split_by_verdict(df, verdicts)
    curated = adjust(good)
    # Both layers are one table to a catalog, so columns that they share have one type.
    kinds = dict(curated.dtypes)
    write_layer(bad.select(*[F.col(c).cast(kinds[c]) for c in bad.columns]), root, "quarantine")
    write_layer(curated, root, "adjusted")
    failing = verdicts.where("action = 'quarantine'")
    if fail and (first := failing.orderBy("ds").first()):
        n = failing.count()
        raise ValueError("DQ_FAILED: " + "; ".join(first.messages) + (f" ({first.ds}; {n} days failed)" if n > 1 else ""))
    return verdicts


def land_raw(df: DataFrame, root: str, existing: DataFrame | None = None, file_type: str = "json", gzip: bool = False) -> None:
    """Raw rows in folders of symbol and day: pairs in ``existing(symbol, ds)`` are left alone. ``write_raw_files`` writes one file for each key."""
    if existing is not None:
        df = df.join(existing.select("symbol", "ds").distinct(), ["symbol", "ds"], "left_anti")
    writer = dated(df).hint("rebalance", "symbol", "ds").write.partitionBy("year", "month", "day", "symbol").mode("append")
    if gzip:
        writer = writer.option("compression", "gzip")
    writer.option("header", True).format(file_type).save(root)


def write_manifests(objects: DataFrame, path: str) -> None:
    manifests(objects).write.mode("overwrite").json(path)


def write_manifest_documents(documents: DataFrame, path: str) -> None:
    """Whole manifests, one JSON file in the folder of each day."""
    dated(documents).repartition("ds").write.partitionBy("year", "month", "day").mode("overwrite").json(path)


def write_messages(messages: DataFrame, path: str) -> None:
    """Messages by domain, which is their route: key, body and headers as a queue takes them."""
    messages.write.partitionBy("domain").mode("append").json(path)


def append_ledger(loaded: str, path: str, spark: SparkSession, correlation_id: str) -> None:
    """Append a row per file of a loaded layer to the ledger: domain, table, day, file, records, bytes, id and time."""
    part = lambda pattern: F.nullif(F.regexp_extract("_metadata.file_path", pattern, 1), F.lit(""))
    day = F.concat_ws("-", *[F.regexp_extract("_metadata.file_path", rf"/{n}=(\d+)", 1) for n in ("year", "month", "day")])
    rows = ledger(spark.read.parquet(loaded), part(r"([^/]+)/[^/]+/interval=").alias("domain"), part(r"([^/]+)/interval=").alias("table_name"), F.try_to_date(day).alias("partition_date"))
    rows.withColumns({"correlation_id": F.lit(correlation_id), "processed_at": F.current_timestamp()}).write.mode("append").parquet(path)


def append_version(schema: T.StructType, table_name: str, path: str, spark: SparkSession, codec: str = "zstd") -> int:
    """Append a table's schema version unless its hash is the latest one's; its number."""
    print_ = fingerprint(schema, codec)
    try:
        last = spark.read.parquet(path).where(F.col("table_name") == table_name).orderBy(F.col("version").desc()).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        last = None
    if last and last.hash == print_["hash"]:
        return last.version
    version = last.version + 1 if last else 1
    columns = [(c["name"], c["type"]) for c in print_["columns"]]
    row = spark.createDataFrame([(table_name, version, columns, codec, print_["hash"])], "table_name string, version int, columns array<struct<name:string,type:string>>, codec string, hash string")
    row.write.mode("append").parquet(path)
    return version


def report_by_layer(rows: DataFrame, layers: tuple[str, ...]) -> DataFrame:
    """``layer, records, days, first_ds, last_ds`` of rows that say their ``layer``, from one pass over them; a layer without rows has zero records."""
    counted = rows.groupBy("layer").agg(F.count("*").alias("records"), F.count_distinct("ds").alias("days"), F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"))
    names = rows.sparkSession.createDataFrame([(x,) for x in layers], "layer string")
    return names.join(counted, "layer", "left").select("layer", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("records", "days")], "first_ds", "last_ds")


def write_report(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").json(path)


def register_table(spark: SparkSession, name: str, root: str) -> DataFrame:
    """Catalog tables over a layered root, brought up to date by ``sync_table``; what has changed.

    All layers are one table, ``name``. Where a layer's columns can't be combined with the others', each layer
    but the quarantined one is a table of its own, ``<name>_<layer>``. The view ``<name>_good`` has the rows of
    all that aren't quarantined, with columns cast to a type that holds both.
    """
    try:
        changes = sync_table(spark, name, root, layers=ALL_LAYERS)
        tables = [name] if spark.catalog.tableExists(name) else []
    except ValueError:
        layers = sorted(r.layer for r in listed_partitions(spark, root).select("layer").distinct().collect() if r.layer != "quarantine")
        tables = [f"{name}_{layer}" for layer in layers]
        changes = reduce(DataFrame.unionByName, [sync_table(spark, t, root, layers=(layer,)) for t, layer in zip(tables, layers)])
    if tables:
        kinds: dict[str, T.DataType] = {}
        for t in tables:
            for f in spark.table(t).schema.fields:
                kinds[f.name] = shown_type(kinds.get(f.name, f.dataType), f.dataType)
        cast = lambda t, c: f"CAST({f'`{c}`' if c in spark.table(t).columns else 'NULL'} AS {kinds[c].simpleString()}) AS `{c}`"
        spark.sql(f"CREATE OR REPLACE VIEW {name}_good AS " + " UNION ALL ".join(f"SELECT {', '.join(cast(t, c) for c in kinds)} FROM {t} WHERE layer <> 'quarantine'" for t in tables))
    return changes


def append_once(df: DataFrame, path: str, query: str, batch_id: int) -> None:
    """Append a micro-batch to Parquet so that a replay of it changes nothing: for ``foreachBatch``.

    A batch has a folder of its own, named by query and number, which its replay writes anew; the folder's files
    are there in whole or not at all to readers of the table, which look for the mark of its commit.
    """
    df.withColumns({"query": F.lit(query), "batch": F.lit(batch_id)}).write.partitionBy("query", "batch").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def ledger_stream(files: DataFrame, path: str, query: str, checkpoint: str) -> StreamingQuery:
    """Append a stream's loaded files to the ledger, each row once however often a micro-batch is run; over all that is there.

    ``files`` are a ledger's rows; ``processed_at`` is the time of the write.
    """

    def put(batch: DataFrame, n: int) -> None:
        append_once(batch.withColumn("processed_at", F.current_timestamp()), path, query, n)

    started = files.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    started.awaitTermination()
    return started
