from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions.keys import ds_of_key, fill_from_key, layer_path, manifest_ds, manifest_key, parse_curated_key, curated_key_error, raw_key
from tidewell.functions.prices import adjust
from tidewell.functions.scalars import correlation_id as first_id
from tidewell.functions.scalars import filled, normalize_symbol as symbol_of, priority, safe_double as number, status_subject, status_text as message, utc_day as day
from tidewell.operators.metrics import error_counts as counts_of
from tidewell.operators.metrics import normalized_errors
from tidewell.registered.registry import query
from tidewell.session import table
from tidewell.views import VIEWS, view, view_sql

PRICES = view_sql("prices")
FACTOR = "CASE WHEN adjusted_close IS NOT NULL AND close IS NOT NULL AND close <> 0 THEN adjusted_close / close END"
ADJUSTED = f"{PRICES}, f AS (SELECT *, {FACTOR} AS adjustment_factor FROM prices)"
OHL = ", ".join(f"CASE WHEN {c} IS NOT NULL AND adjustment_factor IS NOT NULL THEN {c} * adjustment_factor ELSE {c} END AS {c}" for c in ("open", "high", "low"))
VOLUME = "CASE WHEN adjustment_factor IS NOT NULL AND adjustment_factor <> 0 THEN volume / adjustment_factor ELSE CAST(volume AS DOUBLE) END AS volume"


@query(f"{ADJUSTED} SELECT symbol, ds, {OHL}, coalesce(adjusted_close, close) AS close, adjusted_close, {VOLUME}, close AS raw_close, open AS raw_open, high AS raw_high, low AS raw_low, volume AS raw_volume, adjustment_factor, 'adjusted' AS layer FROM f")
def adjusted_prices(spark, sf_dir):
    return adjust(view(spark, sf_dir, "prices")).withColumn("layer", F.lit("adjusted"))


@query(f"{ADJUSTED} SELECT symbol, ds, adjustment_factor FROM f")
def adjustment_factor(spark, sf_dir):
    return adjust(view(spark, sf_dir, "prices"), audit=False).select("symbol", "ds", "adjustment_factor")


@query(f"{ADJUSTED} SELECT symbol, ds, {OHL} FROM f")
def adjust_ohl(spark, sf_dir):
    return adjust(view(spark, sf_dir, "prices"), audit=False).select("symbol", "ds", "open", "high", "low")


@query(f"{ADJUSTED} SELECT symbol, ds, coalesce(adjusted_close, close) AS close FROM f")
def adjust_close(spark, sf_dir):
    return adjust(view(spark, sf_dir, "prices"), audit=False).select("symbol", "ds", "close")


@query(f"{ADJUSTED} SELECT symbol, ds, {VOLUME} FROM f")
def adjust_volume(spark, sf_dir):
    return adjust(view(spark, sf_dir, "prices"), audit=False).select("symbol", "ds", "volume")


@query("SELECT CAST(CAST(ts AS DATE) AS STRING) AS ds, count(*) AS n FROM events GROUP BY 1")
def utc_day(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(day(F.col("ts")).alias("ds")).agg(F.count("*").alias("n"))


EVENTS = view_sql("file_events")
#: Key parts in SQL: a list of segments, with the place of the year after an optional data source.
KEY_SQL = EVENTS + """,
s AS (SELECT *, string_split(key, '/') AS p FROM file_events),
a AS (SELECT *, CASE WHEN len(p) > 7 AND starts_with(p[4], 'data_source=') THEN 5 ELSE 4 END AS y FROM s),
e AS (SELECT *, CASE WHEN y = 5 THEN p[4] END AS src, CASE
  WHEN len(p) < 8 AND y = 4 AND len(p) < 8 THEN 'Invalid curated key format'
  WHEN NOT regexp_full_match(p[1], '[a-z0-9-]{1,50}') THEN 'Invalid domain in key'
  WHEN NOT regexp_full_match(p[2], '[a-z0-9_]{1,50}') THEN 'Invalid table in key'
  WHEN NOT regexp_full_match(p[3], 'interval=[a-z0-9_-]{1,50}') THEN 'Invalid interval segment in key'
  WHEN y = 5 AND NOT regexp_full_match(p[4], 'data_source=[a-z0-9_-]{1,100}') THEN 'Invalid data_source segment in key'
  WHEN NOT regexp_full_match(p[y], 'year=[0-9]{4}') THEN 'Invalid year segment in key'
  WHEN NOT regexp_full_match(p[y+1], 'month=(0[1-9]|1[0-2])') THEN 'Invalid month segment in key'
  WHEN NOT regexp_full_match(p[y+2], 'day=(0[1-9]|[12][0-9]|3[01])') THEN 'Invalid day segment in key'
  WHEN NOT regexp_full_match(p[y+3], 'layer=[a-z0-9_-]{1,50}') THEN 'Invalid layer segment in key'
  WHEN NOT ends_with(key, '.parquet') THEN 'Load objects must be Parquet files' END AS error FROM a),
k AS (SELECT *, p[1] AS domain, p[2] AS table_name, substr(p[3], 10) AS interval_value, substr(src, 13) AS data_source, substr(p[y], 6) AS year, substr(p[y+1], 7) AS month,
  substr(p[y+2], 5) AS day, substr(p[y+3], 7) AS layer FROM e)
"""


@query(f"{KEY_SQL} SELECT event_id, key, error, CASE WHEN error IS NULL THEN domain END AS domain, CASE WHEN error IS NULL THEN data_source END AS data_source, CASE WHEN error IS NULL THEN layer END AS layer,"
       " CASE WHEN error IS NULL THEN year || '-' || month || '-' || day END AS ds FROM k", name="parse_curated_key")
def parse_keys(spark, sf_dir):
    fields = parse_curated_key(F.col("key"))
    df = view(spark, sf_dir, "file_events").withColumn("error", curated_key_error(F.col("key")))
    return df.select("event_id", "key", "error", *[F.when(F.col("error").isNull(), fields[n]).alias(n) for n in ("domain", "data_source", "layer", "ds")])


#: Raw keys of both forms, from orders.
_RAW = ("CASE WHEN event_id % 3 = 0 THEN concat('raw/ingestion_date=', ds, '/x.json') WHEN event_id % 3 = 1 THEN replace(key, 'layer=', 'l=')"
        " WHEN event_id % 7 = 0 THEN concat('m/ds=', ds, '.json') ELSE 'raw/none.csv' END AS raw_key")
RAW_SQL = f"{EVENTS}, r AS (SELECT *, {_RAW} FROM file_events)"
_DSK = "CASE WHEN raw_key LIKE '%ingestion_date=%' THEN ds WHEN event_id % 3 = 1 THEN regexp_extract(raw_key, 'year=([0-9]{4})', 1) || '-' || regexp_extract(raw_key, 'month=([0-9]{2})', 1) || '-' || regexp_extract(raw_key, 'day=([0-9]{2})', 1) END"


@query(f"{RAW_SQL} SELECT event_id, {_DSK} AS ds_preflight, CASE WHEN event_id % 3 = 1 THEN {_DSK} WHEN raw_key LIKE 'm/ds=%' THEN ds END AS ds_manifest FROM r")
def extract_ds(spark, sf_dir):
    df = view(spark, sf_dir, "file_events").selectExpr("*", _RAW)
    return df.select("event_id", ds_of_key(F.col("raw_key")).alias("ds_preflight"), manifest_ds(F.col("raw_key")).alias("ds_manifest"))


@query(f"{EVENTS} SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '1wk' ELSE '1d' END AS interval_value, CASE WHEN key LIKE '%data_source=%' THEN 'yahoo_finance' END AS data_source FROM file_events")
def extract_interval_source(spark, sf_dir):
    df = view(spark, sf_dir, "file_events").withColumn("given", F.when(F.col("event_id") % 2 == 0, " 1wk ").otherwise(" "))
    return df.select("event_id", fill_from_key(F.col("given"), F.col("key"), "interval").alias("interval_value"), fill_from_key(F.lit(None).cast("string"), F.col("key"), "data_source").alias("data_source"))


@query(f"{EVENTS} SELECT event_id, CASE WHEN event_id % 19 = 0 THEN NULL ELSE 'market/prices/interval=1d' || CASE WHEN event_id % 11 = 0 THEN '' ELSE '/data_source=yahoo' END || '/year=' || substr(ds,1,4) || '/month=' || substr(ds,6,2) || '/day=' || substr(ds,9,2) || '/layer=adjusted' END AS path FROM file_events")
def build_layer_path(spark, sf_dir):
    source = F.when(F.col("event_id") % 11 == 0, "").otherwise("yahoo")
    ds = F.when(F.col("event_id") % 19 == 0, "2024/01/01").otherwise(F.col("ds"))
    return view(spark, sf_dir, "file_events").select("event_id", layer_path(F.lit("market"), F.lit("prices"), F.lit("1d"), source, ds, F.lit("adjusted")).alias("path"))


@query(f"""{EVENTS}, d AS (SELECT event_id, 'market/prices/interval=1d/data_source=yahoo/year=' || substr(ds,1,4) || '/month=' || substr(ds,6,2) || '/day=' || substr(ds,9,2) || '/' AS day FROM file_events)
 SELECT event_id, day || 'S' || CAST(event_id AS STRING) || '.csv.gz' AS raw_key, day || '_batch.done.json' AS manifest_key FROM d""")
def build_raw_keys(spark, sf_dir):
    place = [F.lit("market"), F.lit("prices"), F.lit("1d"), F.lit("yahoo"), F.col("ds")]
    raw = raw_key(*place, F.concat(F.lit("S"), F.col("event_id").cast("string")), "CSV", gzip=True)
    return view(spark, sf_dir, "file_events").select("event_id", raw.alias("raw_key"), manifest_key(*place, "", "done.json").alias("manifest_key"))


@query("SELECT p_partkey, replace(upper(trim(concat(' ', substr(p_name, 1, 3), '.', p_brand, ' '))), '.', '-') AS symbol FROM part")
def normalize_symbol(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", symbol_of(F.concat(F.lit(" "), F.substring("p_name", 1, 3), F.lit("."), "p_brand", F.lit(" "))).alias("symbol"))


@query("SELECT event_id, TRY_CAST(CASE WHEN event_id % 3 = 0 THEN event_type WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id AS STRING) END AS DOUBLE) AS number FROM events")
def safe_double(spark, sf_dir):
    raw = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).when(F.col("event_id") % 5 != 0, F.col("event_id").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", number(raw).alias("number"))


CHANGES = view_sql("batch_changes")


@query(f"{CHANGES} SELECT event_id, coalesce(nullif(meta_domain, ''), 'market') AS domain, coalesce(nullif(meta_table_name, ''), 'prices') AS table_name, '1d' AS interval_value FROM batch_changes")
def tracker_defaults(spark, sf_dir):
    return view(spark, sf_dir, "batch_changes").select("event_id", filled(F.col("meta_domain"), "market").alias("domain"), filled(F.col("meta_table_name"), "prices").alias("table_name"),
                                                       filled(F.lit(None).cast("string"), "1d").alias("interval_value"))


@query(f"{EVENTS}, d AS (SELECT event_id, string_split(key, '/')[1] AS domain FROM file_events) SELECT event_id, domain, CASE domain WHEN 'market' THEN '1' WHEN 'daily-prices-data' THEN '2' ELSE '3' END AS priority FROM d")
def route_priority(spark, sf_dir):
    return view(spark, sf_dir, "file_events").select("event_id", F.split("key", "/")[0].alias("domain")).withColumn("priority", priority(F.col("domain")))


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'a' || CAST(user_id AS STRING) WHEN event_id % 4 < 3 THEN 'h' || CAST(user_id AS STRING) END AS given, TRUE AS has_id FROM events")
def correlation_id(spark, sf_dir):
    user, n = F.col("user_id").cast("string"), F.col("event_id") % 4
    a, h = F.when(n == 0, F.concat(F.lit("a"), user)).when(n == 1, F.lit(" ")), F.when(n < 3, F.concat(F.lit("h"), user))
    made = first_id(a, h)
    return table(spark, sf_dir, "events").select("event_id", F.coalesce(F.nullif(F.trim(a), F.lit("")), h).alias("given"), (F.length(made) > 0).alias("has_id"))


ERRORS = view_sql("errors") + ", n AS (SELECT event_id, source, error_message, coalesce(severity, 'ERROR') AS severity, coalesce(error_type, 'UnknownError') AS error_type, domain FROM errors WHERE error_message IS NOT NULL)"


@query(f"{ERRORS} SELECT * FROM n")
def error_normalize(spark, sf_dir):
    return normalized_errors(view(spark, sf_dir, "errors")).select("event_id", "source", "error_message", "severity", "error_type", "domain")


@query(f"{ERRORS} SELECT unnest(['ErrorCount', severity || 'Count']) AS metric, source, error_type, severity, domain, count(*) AS n FROM n GROUP BY source, error_type, severity, domain")
def error_counts(spark, sf_dir):
    return counts_of(view(spark, sf_dir, "errors"))


_STATUS = "CASE event_id % 4 WHEN 0 THEN 'SUCCEEDED' WHEN 1 THEN 'FAILED' WHEN 2 THEN 'RUNNING' ELSE 'PAUSED' END"


@query(f"""SELECT event_id, 'Pipeline: p' || chr(10) || 'Domain: market' || chr(10) || 'Table: ' || event_type || chr(10) || 'Status: ' || {_STATUS} || chr(10) || 'Environment: dev' || chr(10) || 'Timestamp: t'
 || CASE WHEN event_id % 4 = 1 THEN chr(10) || chr(10) || 'Error Details:' || chr(10) || '  Error Type: E' || chr(10) || '  Error Message: No details available' WHEN event_id % 4 = 0 THEN chr(10) || chr(10) || 'Success Details:' || chr(10) || '  Records Processed: ' || user_id || chr(10) || '  Output Location: N/A' ELSE '' END AS message,
 CASE event_id % 4 WHEN 0 THEN '✅' WHEN 1 THEN '❌' WHEN 2 THEN '🔄' ELSE '❓' END || ' Pipeline ' || {_STATUS} || ' - market/' || event_type || ' (dev)' AS subject FROM events""")
def status_text(spark, sf_dir):
    lit, none = F.lit, F.lit(None).cast("string")
    e = {"pipeline": lit("p"), "domain": lit("market"), "table": F.col("event_type"), "status": F.expr(_STATUS), "environment": lit("dev"), "timestamp": lit("t"),
         "error_type": lit("E"), "error_message": none, "records": F.col("user_id"), "location": none}
    return table(spark, sf_dir, "events").select("event_id", message(e).alias("message"), status_subject(e["status"], e["domain"], e["table"], e["environment"]).alias("subject"))
