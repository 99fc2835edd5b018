from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.operators.batches import completed
from tidewell.operators.load import load_messages, message_rejects
from tidewell.operators.metrics import dead_letters, metric_alarms, windowed
from tidewell.registered.load import GATED, LAYERS
from tidewell.registered.prices import CHANGES
from tidewell.registered.registry import query
from tidewell.session import fresh_path, table
from tidewell.streaming.stateful import batch_starts, completions, redelivery, stream_m_of_n
from tidewell.streaming.streams import attempts_by_message, batch_progress, drain, drain_complete, first_starts, intake, land_intake, landed_intake, table_stream
from tidewell.views import VIEWS, view, view_sql


def _view_stream(spark, sf_dir, name):
    base, columns = VIEWS[name]
    return table_stream(spark, sf_dir, base).selectExpr(*columns)


_BODY = "CASE WHEN event_id % 9 = 0 THEN concat('{\"kind\": ', CAST(user_id AS STRING)) ELSE concat('{\"kind\": \"', event_type, '\", \"user\": ', CAST(user_id AS STRING), '}') END AS body"


def _messages(spark, sf_dir):
    return intake(table_stream(spark, sf_dir, "events").selectExpr("event_id AS id", _BODY), "kind string, user long")


@query("SELECT event_id AS id, event_type AS kind, user_id AS \"user\" FROM events WHERE event_id % 9 <> 0")
def stream_intake_good(spark, sf_dir):
    return drain(_messages(spark, sf_dir)[0])


@query("SELECT event_id AS id, concat('{\"kind\": ', CAST(user_id AS STRING)) AS body FROM events WHERE event_id % 9 = 0")
def stream_intake_bad(spark, sf_dir):
    return drain(_messages(spark, sf_dir)[1])


@query("SELECT event_id AS id, event_id % 9 <> 0 AS accepted, CASE WHEN event_id % 9 <> 0 THEN event_type END AS kind, CASE WHEN event_id % 9 = 0 THEN concat('{\"kind\": ', CAST(user_id AS STRING)) END AS body FROM events")
def stream_intake_once(spark, sf_dir):
    """Parsed bodies and rejects of one pass."""
    path = fresh_path(spark)
    land_intake(table_stream(spark, sf_dir, "events").selectExpr("event_id AS id", _BODY), "kind string, user long", f"{path}/rows", f"{path}/checkpoint")
    good, bad = landed_intake(spark, f"{path}/rows", "kind string, user long")
    none = F.lit(None).cast("string")
    return good.select("id", F.lit(True).alias("accepted"), "kind", none.alias("body")).unionByName(bad.select("id", F.lit(False).alias("accepted"), none.alias("kind"), "body"))


DONE = f"{CHANGES}, c AS (SELECT * FROM batch_changes WHERE change = 'MODIFY' AND lower(new_status) = 'complete' AND lower(old_status) <> 'complete' AND run_id IS NULL)"


@query(f"{DONE} SELECT event_id, batch_id FROM c")
def stream_completed(spark, sf_dir):
    return drain(completed(_view_stream(spark, sf_dir, "batch_changes")).select("event_id", "batch_id"))


@query(f"{DONE} SELECT DISTINCT batch_id FROM c")
def stream_dedupe(spark, sf_dir):
    return drain(first_starts(completed(_view_stream(spark, sf_dir, "batch_changes"))).select("batch_id"))


@query("SELECT l_orderkey AS batch_id, count(DISTINCT l_linenumber) AS processed_chunks FROM lineitem GROUP BY 1")
def stream_batch_progress(spark, sf_dir):
    return drain_complete(batch_progress(_view_stream(spark, sf_dir, "chunks")))


@query(f"{GATED} SELECT key, domain, size AS file_size FROM q WHERE skip_reason IS NULL")
def stream_load_messages(spark, sf_dir):
    return drain(load_messages(_view_stream(spark, sf_dir, "file_events"), LAYERS).select("key", "domain", "file_size"))


@query("""WITH a AS (SELECT user_id AS message_id, count(*) AS attempts, arg_max(CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAIL' ELSE 'RETRY' END, event_id) AS last_outcome FROM events GROUP BY 1)
 SELECT *, CASE WHEN last_outcome = 'SUCCESS' THEN 'DONE' WHEN attempts > 3 THEN 'DLQ' ELSE 'RETRY' END AS disposition FROM a""")
def dead_letter(spark, sf_dir):
    outcome = F.expr("CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAIL' ELSE 'RETRY' END AS outcome")
    return dead_letters(table(spark, sf_dir, "events").select(F.col("user_id").alias("message_id"), F.col("event_id").alias("seq"), outcome), 3)


ALARMS = view_sql("errors") + """ SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, count(*) FILTER (WHERE source = 'error') AS errors, count(*) AS n,
 count(*) FILTER (WHERE source = 'error') >= 1 AS alarm FROM errors GROUP BY 1"""


def _alarms(df):
    return windowed(df).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "errors", "n", (F.col("errors") >= 1).alias("alarm"))


@query(ALARMS)
def alarm_windows(spark, sf_dir):
    return _alarms(view(spark, sf_dir, "errors").withColumn("ts", F.col("ts").cast("timestamp")))


@query(ALARMS)
def stream_alarms(spark, sf_dir):
    return drain_complete(_alarms(_view_stream(spark, sf_dir, "errors").withWatermark("ts", "10 minutes")))


@query("WITH c AS (SELECT l_orderkey, count(DISTINCT l_linenumber) AS n FROM lineitem GROUP BY 1) SELECT o_orderkey AS batch_id, CAST(o_custkey % 6 + 1 AS BIGINT) AS expected_chunks FROM orders JOIN c ON l_orderkey = o_orderkey WHERE n >= o_custkey % 6 + 1")
def stream_batch_completed(spark, sf_dir):
    """Batches whose distinct chunks reach the expected number, each once."""
    expected = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS batch_id", "CAST(o_custkey % 6 + 1 AS BIGINT) AS expected_chunks")
    chunks = table_stream(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS batch_id", "l_linenumber AS chunk_id")
    return drain(completions(chunks.join(expected, "batch_id")), state="clock")


@query(f"{GATED} SELECT event_id, skip_reason FROM q WHERE skip_reason IS NOT NULL")
def stream_load_rejects(spark, sf_dir):
    return drain(message_rejects(_view_stream(spark, sf_dir, "file_events"), LAYERS).select("event_id", "skip_reason"))


_METRICS = ["CAST(ts AS TIMESTAMP) AS ts", "CASE event_type WHEN 'error' THEN 'errors' WHEN 'click' THEN 'queue_depth' WHEN 'view' THEN 'oldest_age' WHEN 'signup' THEN 'throttles' ELSE 'job_failures' END AS metric",
            "CASE event_type WHEN 'view' THEN value * 3.0E0 WHEN 'click' THEN value ELSE CAST(event_id % 2 AS DOUBLE) END AS value"]
METRICS = f"""WITH m AS (SELECT {', '.join(_METRICS)} FROM events), w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, metric, avg(value) AS a, max(value) AS m, sum(value) AS s FROM m GROUP BY 1, 2),
 t AS (SELECT *, CASE metric WHEN 'queue_depth' THEN a WHEN 'oldest_age' THEN m ELSE s END AS value, CASE metric WHEN 'queue_depth' THEN 100.0E0 WHEN 'oldest_age' THEN 300.0E0 ELSE 1.0E0 END AS threshold FROM w)
 SELECT window_start, metric, threshold, coalesce(value >= threshold, FALSE) AS alarm FROM t"""


def _shown(df):
    return metric_alarms(df).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "metric", "threshold", "alarm")


@query(METRICS)
def metric_alarm_windows(spark, sf_dir):
    """All five alarms, each by its own statistic and threshold."""
    return _shown(table(spark, sf_dir, "events").selectExpr(*_METRICS))


@query(METRICS)
def stream_metric_alarms(spark, sf_dir):
    return drain_complete(_shown(table_stream(spark, sf_dir, "events").selectExpr(*_METRICS).withWatermark("ts", "10 minutes")))


#: Loads answer success (a blank code), failure or another try, raise an error, or get a body that can't be parsed.
_ATTEMPTS = ["user_id AS message_id", "event_id AS seq", "CASE WHEN event_type IN ('purchase', 'error', 'click') THEN ' ' WHEN event_type = 'view' THEN 'PARSE_ERROR' ELSE 'UNHEARD_OF' END AS error_code",
             "CASE event_type WHEN 'error' THEN 'FAIL' WHEN 'click' THEN 'RETRY' END AS action"]


@query("""WITH a AS (SELECT user_id AS message_id, count(*) AS attempts, arg_max(CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAIL' WHEN 'click' THEN 'RETRY' WHEN 'view' THEN 'PARSE_ERROR' ELSE 'EXCEPTION' END, event_id) AS last_outcome FROM events GROUP BY 1)
 SELECT *, CASE WHEN last_outcome = 'SUCCESS' THEN 'DONE' WHEN attempts > 3 THEN 'DLQ' ELSE 'RETRY' END AS disposition FROM a""")
def stream_dead_letter(spark, sf_dir):
    return drain_complete(attempts_by_message(table_stream(spark, sf_dir, "events").selectExpr(*_ATTEMPTS), 3))


@query(f"""{DONE}, m AS (SELECT DISTINCT o_custkey AS batch_id, CAST(CAST(o_orderdate AS DATE) AS STRING) AS ds FROM orders WHERE o_orderpriority <> '5-LOW')
 SELECT CAST(c.batch_id AS STRING) AS batch_id, 1 AS attempt, 'yahoo_finance' AS data_source, string_agg(DISTINCT ds || '=' || CAST(c.batch_id AS STRING) || '/' || ds || '.json', ',' ORDER BY ds || '=' || CAST(c.batch_id AS STRING) || '/' || ds || '.json') AS manifests
 FROM c JOIN m ON m.batch_id = c.batch_id GROUP BY c.batch_id""")
def stream_batch_starts(spark, sf_dir):
    """Batches that are complete and have manifests, each started once with all of them; a batch without any isn't started."""
    manifests = table_stream(spark, sf_dir, "orders").where("o_orderpriority <> '5-LOW'").selectExpr("o_custkey AS batch_id", "CAST(CAST(o_orderdate AS DATE) AS STRING) AS ds", "concat(CAST(o_custkey AS STRING), '/', CAST(CAST(o_orderdate AS DATE) AS STRING), '.json') AS manifest_key", "'dynamodb' AS source")
    starts = batch_starts(_view_stream(spark, sf_dir, "batch_changes"), manifests, {"domain": "market", "data_source": "yahoo_finance"})
    shown = F.array_join(F.transform("manifests", lambda m: F.concat(m["ds"], F.lit("="), m["manifest_key"])), ",")
    return drain(starts.select("batch_id", "attempt", F.col("fields")["data_source"].alias("data_source"), shown.alias("manifests")), state="clock")


#: A message is hidden for 6, 12 and 24 hours after its first, second and third receive; the watermark ends an hour before the last event.
@query("""WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_ms(ts) AS ms, CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'EXCEPTION' WHEN 'view' THEN 'PARSE_ERROR' ELSE 'RETRY' END AS outcome,
  row_number() OVER (PARTITION BY user_id ORDER BY epoch_ms(ts), event_id) AS n FROM events),
 w AS (SELECT max(epoch_ms(ts)) - 3600000 AS mark FROM events),
 r AS (SELECT user_id, n, ms, outcome, 1 AS received, CAST(NULL AS STRING) AS before, outcome = 'SUCCESS' AS ended FROM e WHERE n = 1
  UNION ALL SELECT e.user_id, e.n, e.ms, e.outcome, CASE WHEN r.ended OR (r.received = 3 AND e.ms >= r.ms + 86400000) OR (e.ms >= r.ms + CASE r.received WHEN 1 THEN 21600000 ELSE 43200000 END + 259200000 AND r.received < 3) THEN 1 ELSE r.received + 1 END,
   CASE WHEN r.ended THEN NULL WHEN r.received = 3 AND e.ms >= r.ms + 86400000 THEN 'DLQ' WHEN e.ms >= r.ms + CASE r.received WHEN 1 THEN 21600000 ELSE 43200000 END + 259200000 AND r.received < 3 THEN 'EXPIRED' END,
   e.outcome = 'SUCCESS' OR (NOT r.ended AND r.received = 3 AND e.ms < r.ms + 86400000) FROM r JOIN e ON e.user_id = r.user_id AND e.n = r.n + 1),
 l AS (SELECT *, lead(before) OVER (PARTITION BY user_id ORDER BY n) AS after, lead(n) OVER (PARTITION BY user_id ORDER BY n) IS NULL AS final FROM r),
 o AS (SELECT user_id, received, outcome, CASE WHEN outcome = 'SUCCESS' THEN 'DONE' ELSE 'DLQ' END AS disposition FROM l WHERE ended
  UNION ALL SELECT user_id, received, outcome, after FROM l WHERE NOT ended AND after IS NOT NULL
  UNION ALL SELECT user_id, received, outcome, CASE WHEN received = 3 THEN 'DLQ' ELSE 'EXPIRED' END FROM l, w WHERE NOT ended AND final AND mark >= ms + CASE received WHEN 1 THEN 21600000 + 259200000 WHEN 2 THEN 43200000 + 259200000 ELSE 86400000 END)
 SELECT CAST(user_id AS STRING) AS message_id, received AS attempts, outcome AS last_outcome, disposition FROM o""")
def stream_redelivery(spark, sf_dir):
    """How messages end: done, dead after three receives, or never received again within three days of being due."""
    rows = table_stream(spark, sf_dir, "events").selectExpr("user_id AS message_id", "event_id AS seq", "ts", "CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'EXCEPTION' WHEN 'view' THEN 'PARSE_ERROR' ELSE 'RETRY' END AS outcome")
    ends = redelivery(rows, 3, ("6 hours", "12 hours", "24 hours"), delay="1 hours", keep="3 days")
    return drain(ends, state="event").where("disposition <> 'REDELIVER'").select("message_id", "attempts", "last_outcome", "disposition")


@query("""WITH c AS (SELECT event_type AS series, CAST(floor(epoch(ts) / 21600) * 21600 AS BIGINT) AS window_start, count(*) AS value FROM events GROUP BY ALL),
 w AS (SELECT * FROM c WHERE window_start + 21600 <= (SELECT max(epoch(ts)) FROM events)),
 g AS (SELECT series, unnest(generate_series(min(window_start), max(window_start), 21600)) AS window_start FROM w GROUP BY series),
 f AS (SELECT g.series, g.window_start, coalesce(w.value, 0) AS value FROM g LEFT JOIN w USING (series, window_start))
 SELECT series, window_start, value::DOUBLE AS value, sum(CASE WHEN value > 3 THEN 1 ELSE 0 END) OVER (PARTITION BY series ORDER BY window_start ROWS 1 PRECEDING) = 2 AS alarm FROM f""")
def stream_alarm_m_of_n(spark, sf_dir):
    """Two of two windows above the threshold, for the windows that the stream's time has closed."""
    counts = table_stream(spark, sf_dir, "events").withWatermark("ts", "0 seconds").groupBy("event_type", F.window("ts", "6 hours")).agg(F.count("*").alias("value"))
    windows = counts.select(F.col("event_type").alias("series"), F.unix_timestamp("window.start").alias("window_start"), "value", "window")
    return drain(stream_m_of_n(windows, 2, 3, minutes=360), state="event")
