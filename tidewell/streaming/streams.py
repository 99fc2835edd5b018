"""Structured Streaming over landed tables: intake, completion, dedupe, progress and alarms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidewell.operators.load import outcome
from tidewell.operators.metrics import dead_letters
from tidewell.session import fresh_path
from tidewell.streaming.stateful import run_stateful


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table's files as a stream; times without a zone become UTC ones, which watermarks need."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    df = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return df.withColumns({c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"})


def drain(stream: DataFrame, state: str | None = None) -> DataFrame:
    """Run a stream over all that is there, append to Parquet in the shared folder, and read that back; ``state`` machines go by "clock" or "event" time."""
    spark, path = stream.sparkSession, fresh_path(stream.sparkSession)
    writer = stream.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True)
    query = run_stateful(spark, writer, ends=state == "clock") if state else writer.start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


def drain_complete(stream: DataFrame) -> DataFrame:
    """Run an aggregating stream over all that is there; the last complete result is what counts."""
    spark, path = stream.sparkSession, fresh_path(stream.sparkSession)

    def put(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rows")

    stream.writeStream.outputMode("complete").foreachBatch(put).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


def intake(messages: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """(parsed bodies, rejected rows) of ``messages(id, body)``; one bad record fails alone."""
    parsed = messages.withColumn("m", F.from_json("body", schema, {"mode": "PERMISSIVE"}))
    good = F.col("m").isNotNull() & F.col("m.kind").isNotNull()
    return parsed.where(good).select("id", "m.*"), parsed.where(~good).select("id", "body")


def land_intake(messages: DataFrame, schema: str, path: str, checkpoint: str) -> StreamingQuery:
    """Write parsed bodies and rejects of ``messages(id, body)`` in one pass, and count both on the way; over all that is there.

    A row is parsed once and goes to the folder of what it is; ``landed_intake`` reads them. The query's progress
    has the counts of each micro-batch as the observed metrics ``intake``.
    """
    parsed = messages.withColumn("m", F.from_json("body", schema, {"mode": "PERMISSIVE"}))
    good = F.col("m").isNotNull() & F.col("m.kind").isNotNull()
    rows = parsed.select("id", F.when(good, F.col("m")).alias("m"), F.when(~good, F.col("body")).alias("body"), good.alias("accepted"))
    rows = rows.observe("intake", F.count_if(F.col("accepted")).alias("accepted"), F.count_if(~F.col("accepted")).alias("rejected"))
    query = rows.writeStream.format("parquet").partitionBy("accepted").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def landed_intake(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(parsed bodies, rejected rows) that ``land_intake`` has written."""
    rows = spark.read.schema(f"id long, m struct<{schema.replace(' ', ':').replace(',:', ',')}>, body string, accepted boolean").parquet(path)
    return rows.where("accepted").select("id", "m.*"), rows.where("NOT accepted").select("id", "body")


def first_starts(changes: DataFrame, delay: str = "7 days") -> DataFrame:
    """At most one start per batch id within the watermark, which is how long its state is kept; a checkpoint makes replays safe."""
    return changes.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["batch_id"])


def batch_progress(chunks: DataFrame) -> DataFrame:
    """Chunks that came per batch, each counted once however often it is delivered."""
    return chunks.groupBy("batch_id").agg(F.size(F.collect_set("chunk_id")).cast("long").alias("processed_chunks"))


def attempts_by_message(attempts: DataFrame, max_receives: int) -> DataFrame:
    """Where the messages of a stream of attempts ``(message_id, seq, error_code)`` stand, for ``drain_complete``; see ``dead_letters``.

    A column ``action``, if there is one, is what the load answered: SUCCESS, RETRY or FAIL.
    All messages stay in the state, as a complete result lists all; ``redelivery`` lets go of those that have ended.
    """
    return dead_letters(attempts.withColumn("outcome", outcome(F.col("error_code"), F.col("action") if "action" in attempts.columns else None)), max_receives)
