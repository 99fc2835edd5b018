"""Chunks, manifests and batches as set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.functions.keys import manifest_ds, manifest_key


#: Ranks are counted over at most so many blocks of values, one row each in one task.
BLOCKS = 1 << 16


def rank_all(df: DataFrame, order: str, out: str, step: int = 4096) -> DataFrame:
    """``df`` with its 0-based rank by a long column, without one task that sorts all rows.

    Rows are counted per block of ``step`` values, or of more where values are so sparse that there would be
    over ``BLOCKS`` blocks; only these counts are summed in order.
    """
    lo, hi = df.agg(F.min(order), F.max(order)).first()
    step = max(step, -(-((hi or 0) - (lo or 0) + 1) // BLOCKS))
    blocks = df.withColumn("_block", F.expr(f"({order} - {lo or 0}L) div {step}L"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    first = blocks.groupBy("_block").count().select("_block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("_block").orderBy(order)
    return blocks.withColumn("_n", F.row_number().over(within)).join(first, "_block").withColumn(out, (F.col("_first") + F.col("_n") - 1).cast("long")).drop("_block", "_n", "_first")


def chunk(df: DataFrame, order: str, value: str, size: int) -> DataFrame:
    """Consecutive values in chunks of ``size``, in order and without dedupe: ``chunk_no, total_chunks, members``."""
    ranked = rank_all(df.select(order, value), order, "_rank").withColumn("chunk_no", F.expr(f"_rank div {size}"))
    total = df.agg(F.ceil(F.count("*") / size).cast("long").alias("total_chunks"))
    members = F.transform(F.array_sort(F.collect_list(F.struct("_rank", value))), lambda x: x[value])
    return ranked.groupBy("chunk_no").agg(members.alias("members")).crossJoin(F.broadcast(total))


def manifests(objects: DataFrame) -> DataFrame:
    """Per day: number of objects and records, and the sorted object list; ``objects(ds, symbol, records)`` are counted first."""
    return objects.groupBy("ds").agg(F.count("*").alias("objects_n"), F.sum("records").alias("records"), F.array_sort(F.collect_list(F.struct("symbol", "records"))).alias("objects"))


def manifest_documents(objects: DataFrame, batch_id: str, domain: str, table_name: str, interval: str, data_source: str, environment: str = "dev",
                       basename: str = "_batch", suffix: str = ".manifest.json") -> DataFrame:
    """One whole manifest per day of ``objects(ds, symbol, key, records)``, with its ``manifest_key``; a day that is none has no key and is left out."""
    rows = objects.groupBy("ds").agg(F.array_sort(F.collect_list(F.struct("symbol", "key", "records"))).alias("objects"))
    key = manifest_key(F.lit(domain), F.lit(table_name), F.lit(interval), F.lit(data_source), F.col("ds"), basename, suffix)
    given = {"environment": environment, "domain": domain, "table_name": table_name, "data_source": data_source, "interval": interval, "batch_id": batch_id}
    return rows.select(key.alias("manifest_key"), *[F.lit(v).alias(n) for n, v in given.items()], "ds", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("generated_at"), "objects").where("manifest_key IS NOT NULL")


def merge_chunks(chunks: DataFrame) -> DataFrame:
    """Summaries ``(ds, seq, raw_prefix, n_objects)`` per day: the first one's prefix, all objects, no dedupe."""
    return chunks.groupBy("ds").agg(F.min_by("raw_prefix", "seq").alias("raw_prefix"), F.sum("n_objects").alias("n_objects"), F.count("*").alias("n_chunks"))


def merged_objects(summaries: DataFrame) -> DataFrame:
    """Objects of all summaries ``(ds, seq, raw_prefix, objects)``, one row each: ``ds, raw_prefix, place, object``, without dedupe.

    The prefix is that of a day's first summary. Objects stay rows, so a day with many is never one value;
    ``place`` (a summary's number and the place in it) is their order. Summaries without a day are left out.
    """
    days = summaries.where("coalesce(ds, '') <> ''")
    prefix = days.groupBy("ds").agg(F.min_by("raw_prefix", "seq").alias("raw_prefix"))
    rows = days.select("ds", "seq", F.posexplode("objects").alias("pos", "object"))
    return rows.join(prefix, "ds").select("ds", "raw_prefix", F.struct("seq", "pos").alias("place"), "object")


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key, nulls being keys: landed records per symbol and day, objects per partition."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def any_true(decisions: DataFrame, by: str, decision: Column) -> DataFrame:
    """``by, refresh``: whether any decision of a batch is true; a null one isn't."""
    return decisions.groupBy(by).agg(F.bool_or(F.coalesce(decision, F.lit(False))).alias("refresh"))


def days_of(df: DataFrame, ds: str = "ds") -> DataFrame:
    """The days that occur, in order."""
    return df.select(ds).where(F.col(ds).isNotNull()).distinct().orderBy(ds)


def only_done(requested: DataFrame, done: DataFrame, on: tuple[str, ...] = ("ds",)) -> DataFrame:
    """Rows whose partition has been compacted."""
    return requested.join(done.select(*on), list(on), "left_semi")


def reconcile(left: DataFrame, right: DataFrame, on: tuple[str, ...], names: tuple[str, str]) -> DataFrame:
    """Counts of two sides per key, and whether they are the ``same``; a key of one side only has a null count on the other."""
    counted = [df.groupBy(*on).agg(F.count("*").alias(n)) for df, n in zip((left, right), names)]
    both = counted[0].join(counted[1], list(on), "full_outer")
    return both.withColumn("same", F.coalesce(names[0], F.lit(0)) == F.coalesce(names[1], F.lit(0)))


def progress(chunks: DataFrame, expected: DataFrame) -> DataFrame:
    """Per batch: distinct chunks that came, those expected, and the status; a chunk that comes twice counts once."""
    came = chunks.groupBy("batch_id").agg(F.count_distinct("chunk_id").alias("processed_chunks"))
    joined = expected.join(came, "batch_id", "left").withColumn("processed_chunks", F.coalesce("processed_chunks", F.lit(0)))
    return joined.withColumn("status", F.when(F.col("processed_chunks") >= F.col("expected_chunks"), "complete").otherwise("processing"))


#: Where a batch's manifests are named, best first; the last counts only for batches that the others say nothing of.
SOURCES = ("manifest_keys", "finalizing", "combined", "payload", "chunk_summary")


def manifest_entries(found: DataFrame, domain: Column, table_name: Column, interval: Column, data_source: Column) -> DataFrame:
    """``batch_id, ds, manifest_key, source`` of ``found(batch_id, place, seq, ds, manifest_key)``, one row per batch and day.

    ``place`` is one of ``SOURCES``. A tracker's keys give their own day; elsewhere a blank key is built from
    the day. The first by place and ``seq`` wins a day. Chunk summaries count only for batches without any
    entry of the tracker. ``source`` is dynamodb, computed or chunk_summary. Rows without a usable day or
    key, or of another place, are left out.
    """
    given = F.nullif(F.trim("manifest_key"), F.lit(""))
    listed = F.col("place") == SOURCES[0]
    ds = F.when(listed, manifest_ds(given)).otherwise(F.nullif(F.trim("ds"), F.lit("")))
    rank = F.array_position(F.array(*[F.lit(x) for x in SOURCES]), F.col("place"))
    rows = found.where(rank > 0).withColumns({"_rank": rank, "ds": ds, "_given": given})
    key = F.coalesce("_given", manifest_key(domain, table_name, interval, data_source, F.col("ds")))
    source = F.when(F.col("place") == SOURCES[-1], SOURCES[-1]).when(F.col("_given").isNull(), "computed").otherwise("dynamodb")
    rows = rows.select("batch_id", "ds", key.alias("manifest_key"), source.alias("source"), "_rank", "seq").where("ds IS NOT NULL AND manifest_key IS NOT NULL")
    tracked = F.max(F.when(F.col("source") != SOURCES[-1], 1)).over(Window.partitionBy("batch_id"))
    rows = rows.withColumn("_tracked", tracked).where((F.col("source") != SOURCES[-1]) | F.col("_tracked").isNull())
    best = Window.partitionBy("batch_id", "ds").orderBy("_rank", "seq", "manifest_key")
    return rows.withColumn("_n", F.row_number().over(best)).where("_n = 1").select("batch_id", "ds", "manifest_key", "source")


def completed(changes: DataFrame) -> DataFrame:
    """Changes that complete a batch for the first time and have no run yet; statuses in any case."""
    done: Column = (F.lower("new_status") == "complete") & (F.lower(F.coalesce("old_status", F.lit(""))) != "complete")
    return changes.where((F.col("change") == "MODIFY") & done & F.col("run_id").isNull() & F.col("batch_id").isNotNull())
