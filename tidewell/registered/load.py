from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions.keys import is_curated_key, parse_curated_key
from tidewell.operators.load import load_gate, load_messages as messages_of, message_error, without_quarantine
from tidewell.registered.prices import KEY_SQL
from tidewell.registered.registry import query
from tidewell.views import view

LAYERS = ("adjusted", "compacted")
GATED = KEY_SQL + """, q AS (SELECT *, CASE WHEN size IS NULL OR size < 1024 THEN 'File size below threshold' WHEN source <> 'aws.s3' OR detail_type <> 'Object Created' THEN 'Unsupported event type'
 WHEN bucket = 'Bad_Bucket' AND error IS NULL THEN 'Invalid S3 bucket format' WHEN error IS NOT NULL THEN error WHEN layer NOT IN ('adjusted', 'compacted') THEN 'Layer not allowed: ' || layer
 WHEN domain NOT IN ('market', 'daily-prices-data', 'product', 'analytics') THEN 'Unknown domain' END AS skip_reason FROM k)"""


@query(f"{GATED} SELECT event_id, key, skip_reason FROM q")
def load_event_gate(spark, sf_dir):
    return load_gate(view(spark, sf_dir, "file_events"), LAYERS).select("event_id", "key", "skip_reason")


@query(f"{GATED} SELECT bucket, key, domain, table_name, interval_value, data_source, year, month, day, layer, year || '-' || month || '-' || day AS ds, size AS file_size, CASE domain WHEN 'market' THEN '1' WHEN 'daily-prices-data' THEN '2' ELSE '3' END AS priority FROM q WHERE skip_reason IS NULL")
def load_messages(spark, sf_dir):
    out = messages_of(view(spark, sf_dir, "file_events"), LAYERS).withColumnRenamed("interval", "interval_value")
    return out.select("bucket", "key", "domain", "table_name", "interval_value", "data_source", "year", "month", "day", "layer", "ds", "file_size", "priority")


@query(f"{KEY_SQL} SELECT event_id, TRUE AS kept FROM k WHERE error IS NULL AND layer <> 'quarantine' AND event_id % 19 <> 0")
def exclude_quarantine(spark, sf_dir):
    hidden = F.when(F.col("event_id") % 38 == 0, F.regexp_replace("key", "/part-", "/_temporary/part-")).when(F.col("event_id") % 19 == 0, F.regexp_replace("key", "/part-[^/]*", "/_SUCCESS"))
    files = view(spark, sf_dir, "file_events").where(is_curated_key(F.col("key"))).withColumn("key", F.coalesce(hidden, "key"))
    return without_quarantine(files).select("event_id", F.lit(True).alias("kept"))


@query(f"""{KEY_SQL} SELECT event_id, CASE WHEN bucket = 'Bad_Bucket' THEN 'Invalid S3 bucket format' WHEN error IS NOT NULL THEN error
 WHEN event_id % 43 = 0 THEN 'Domain does not match S3 key' WHEN event_id % 47 = 0 THEN 'Day does not match S3 key' WHEN data_source IS NULL THEN 'Data source does not match S3 key'
 WHEN event_id % 53 = 0 THEN 'Invalid correlation_id' WHEN event_id % 59 = 0 THEN 'file_size must be positive' WHEN event_id % 61 = 0 THEN 'presigned_url must be https' END AS error FROM k""")
def validate_load_message(spark, sf_dir):
    n = F.col("event_id")
    fields = parse_curated_key(F.col("key")) | {"data_source": F.lit("yahoo_finance")}
    # Any well-formed UUID will do, in any of its forms.
    uuids = F.when(n % 53 == 0, "550e8400-e29b-11d4-a716").when(n % 2 == 0, "550e8400-e29b-11d4-a716-446655440000").when(n % 3 == 0, "{550E8400e29b41d4a716446655440000}").otherwise("urn:uuid:550e8400-e29b-41d4-a716-446655440000")
    df = view(spark, sf_dir, "file_events").select("event_id", "bucket", "key", *[c.alias(k) for k, c in fields.items()]).withColumns({
        "domain": F.when(n % 43 == 0, "other").otherwise(F.col("domain")), "day": F.when(n % 47 == 0, "x").otherwise(F.col("day")), "correlation_id": uuids,
        "file_size": F.when(n % 59 == 0, 0).otherwise(5000), "presigned_url": F.when(n % 61 == 0, "http://x").when(n % 2 == 0, "https://x")})
    return df.select("event_id", message_error().alias("error"))
