from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.operators.batches import any_true, chunk, completed, counts_by, days_of, manifest_entries, manifests, merge_chunks as merged, merged_objects, only_done, progress, reconcile as reconciled
from tidewell.operators.metrics import m_of_n
from tidewell.operators.schema_versions import diff, previous_hash, refresh_needed
from tidewell.plans.backfill import JobSettings, backfill_days, backfill_items, idempotent, job_arguments, normalized_request, preflight_code
from tidewell.registered.prices import CHANGES, EVENTS, PRICES
from tidewell.registered.registry import query
from tidewell.session import fresh_path, table
from tidewell.sources.readers import file_type_allowed, first_symbols, listed_symbols, parse_symbols, read_listing, split_symbols, universe
from tidewell.functions.scalars import normalize_symbol
from tidewell.views import view, view_sql

#: Date ranges from all orders: about half are reversed, and those of over 31 days are clamped.
_RANGES = "SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + CAST(o_custkey % 101 - 50 AS INT) AS b FROM orders"
_RANGE_COLUMNS = ["o_orderkey AS id", "CAST(o_orderdate AS DATE) AS a", "date_add(CAST(o_orderdate AS DATE), CAST(o_custkey % 101 - 50 AS INT)) AS b"]
DAYS = f"WITH r AS ({_RANGES}), x AS (SELECT id, CAST(CAST(unnest(generate_series(least(a, b), least(greatest(a, b), least(a, b) + 30), INTERVAL 1 DAY)) AS DATE) AS STRING) AS ds FROM r)"
_DONE = "SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS STRING) AS ds FROM orders WHERE o_orderpriority = '1-URGENT'"


def _days(spark, sf_dir):
    ranges = table(spark, sf_dir, "orders").selectExpr(*_RANGE_COLUMNS)
    return backfill_days(ranges, "a", "b").select("id", "ds")


def _done(spark, sf_dir):
    return table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").selectExpr("CAST(CAST(o_orderdate AS DATE) AS STRING) AS ds").distinct()


@query(f"{DAYS} SELECT id, ds FROM x")
def backfill_dates(spark, sf_dir):
    return _days(spark, sf_dir)


PLAN = f"{DAYS}, d AS ({_DONE}), p AS (SELECT x.id, x.ds, d.ds IS NULL AS proceed, CASE WHEN d.ds IS NOT NULL THEN 'IDEMPOTENT_SKIP' END AS code FROM x LEFT JOIN d ON x.ds = d.ds)"


@query(f"{PLAN} SELECT * FROM p")
def idempotent_plan(spark, sf_dir):
    return idempotent(_days(spark, sf_dir), _done(spark, sf_dir), ["ds"]).select("id", "ds", "proceed", "code")


_PATH = "'market/prices/interval=1d/data_source=yahoo_finance/year=' || substr(ds,1,4) || '/month=' || substr(ds,6,2) || '/day=' || substr(ds,9,2) || '/layer='"
#: Arguments of a job, which is a SQL text each.
_ARGUMENTS = {
    "environment": "'prod'", "domain": "'market'", "table_name": "'prices'", "raw_bucket": "'raw'", "raw_prefix": "'market/prices/interval=1d/data_source=yahoo_finance/'", "compacted_bucket": "'curated'", "curated_bucket": "'curated'",
    "curated_layer": "'adjusted'", "compacted_layer": "'merged'", "schema_fingerprint_s3_uri": "'s3://artifacts/market/prices/_schema/latest.json'", "codec": "'zstd'", "target_file_mb": "'256'", "expected_min_records": "'20'",
    "max_critical_error_rate": "'2.5'", "file_type": "'csv'", "interval_value": "'1d'", "data_source": "'yahoo_finance'", "output_partitions": "'1'",
    "compacted_path": f"{_PATH} || 'merged'", "curated_path": f"{_PATH} || 'adjusted'", "quarantine_path": f"{_PATH} || 'quarantine'",
}
_SETTINGS = JobSettings("prod", "raw", "curated", "artifacts", "merged", "20", "2.5", "0")


def _of():
    return [F.lit(x) for x in ("market", "prices", "1d", "yahoo_finance", "csv")]


def _args(given="TRUE"):
    return ", ".join(f"CASE WHEN {given} THEN {sql} END AS {n}" for n, sql in _ARGUMENTS.items())


@query(f"{DAYS} SELECT id, ds, {_args()} FROM x")
def plan_rows(spark, sf_dir):
    return job_arguments(_days(spark, sf_dir), *_of(), _SETTINGS).withColumnRenamed("interval", "interval_value")


@query(f"""{PLAN} SELECT id, ds, proceed, code, CASE WHEN NOT proceed THEN 'Already processed' END AS reason, CASE WHEN NOT proceed THEN 'Curated partition already exists' END AS message,
 CASE id % 3 WHEN 0 THEN 'on_schema_change' WHEN 1 THEN 'never' END AS catalog_update, {_args('proceed')} FROM p""")
def backfill_plan(spark, sf_dir):
    """Each day of each range: its job's arguments, or why there is none; the request's policy, if it has one."""
    policy = F.expr("CASE id % 3 WHEN 0 THEN ' on_schema_change' WHEN 1 THEN 'never' ELSE ' ' END")
    return backfill_items(_days(spark, sf_dir), _done(spark, sf_dir), *_of(), policy, _SETTINGS).withColumnRenamed("interval", "interval_value")


_REQUEST = ["event_id", "CASE event_id % 3 WHEN 0 THEN ' CSV ' WHEN 1 THEN '' ELSE NULL END AS file_type", "CASE WHEN event_id % 2 = 0 THEN ' prices ' ELSE '' END AS table_name",
            "event_type AS legacy_table", "CASE WHEN event_id % 5 = 0 THEN NULL ELSE '2024-01-01' END AS range_start", "CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN '' ELSE '2024-01-05' END AS range_end"]


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'csv' ELSE 'json' END AS file_type, CASE WHEN event_id % 2 = 0 THEN 'prices' ELSE event_type END AS table_name, event_id % 5 <> 0 AND event_id % 7 <> 0 AND event_id % 11 <> 0 AS has_range, '.json,.csv' AS suffixes FROM events")
def plan_request(spark, sf_dir):
    df = table(spark, sf_dir, "events").selectExpr(*_REQUEST).withColumn("suffixes", F.array(F.lit(" .json"), F.lit(" "), F.lit(".csv ")))
    return normalized_request(df).select("event_id", "file_type", "table_name", "has_range", F.array_join("suffixes", ",").alias("suffixes"))


@query(f"""{EVENTS} SELECT event_id, CASE WHEN event_id % 6 = 0 OR key NOT LIKE '%data_source=%' THEN 'PRE_VALIDATION_FAILED' WHEN event_id % 5 = 1 THEN NULL WHEN event_id % 7 = 3 THEN 'PRE_VALIDATION_FAILED'
 WHEN NOT ends_with(key, '.parquet') THEN 'IGNORED_OBJECT' END AS code FROM file_events""")
def preflight_codes(spark, sf_dir):
    # Without a key there is no source either; the source is given then.
    none = F.lit(None).cast("string")
    key = F.when(F.col("event_id") % 7 == 3, F.lit("")).otherwise(F.col("key"))
    domain = F.when(F.col("event_id") % 6 == 0, " ").otherwise("market")
    sourced = F.when((F.col("event_id") % 7 == 3) & F.contains("key", F.lit("data_source=")), "yahoo").otherwise(none)
    interval = F.when(F.col("event_id") % 7 == 3, "1d").otherwise(none)
    ds = F.when(F.col("event_id") % 5 == 1, F.col("ds"))
    return view(spark, sf_dir, "file_events").select("event_id", preflight_code(domain, F.lit("prices"), interval, sourced, key, ds, (".PARQUET",)).alias("code"))


@query(f"{EVENTS} SELECT event_id, ends_with(lower(key), '.parquet') AS allowed FROM file_events")
def suffix_filter(spark, sf_dir):
    allowed = F.array(F.lit(".PARQUET"), F.lit(".avro"))
    return view(spark, sf_dir, "file_events").select("event_id", F.exists(allowed, lambda s: F.endswith(F.lower("key"), F.lower(s))).alias("allowed"))


@query("SELECT event_id, lower(CASE event_id % 4 WHEN 0 THEN 'JSON' WHEN 1 THEN 'csv' WHEN 2 THEN 'Parquet' ELSE 'avro' END) AS file_type, event_id % 4 <> 3 AS allowed FROM events")
def file_type_check(spark, sf_dir):
    kind = F.lower(F.expr("CASE event_id % 4 WHEN 0 THEN 'JSON' WHEN 1 THEN 'csv' WHEN 2 THEN 'Parquet' ELSE 'avro' END"))
    return table(spark, sf_dir, "events").select("event_id", kind.alias("file_type"), file_type_allowed(kind).alias("allowed"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_brand END AS symbol, p_partkey % 5 <> 0 AS valid FROM part")
def symbol_split(spark, sf_dir):
    raw = F.when(F.col("p_partkey") % 10 == 0, "  ").when(F.col("p_partkey") % 5 != 0, F.concat(F.lit(" "), "p_brand"))
    good, bad = split_symbols(table(spark, sf_dir, "part").select("p_partkey", raw.alias("symbol")), "symbol")
    return good.withColumn("valid", F.lit(True)).unionByName(bad.select("p_partkey", F.lit(None).cast("string").alias("symbol"), F.lit(False).alias("valid")))


@query("WITH s AS (SELECT p_partkey, p_brand || CAST(p_partkey AS STRING) AS symbol, row_number() OVER (ORDER BY p_partkey) - 1 AS r FROM part) SELECT r // 50 AS chunk_no, string_agg(symbol, ',' ORDER BY r) AS members, CAST(ceil((SELECT count(*) FROM s) / 50.0E0) AS BIGINT) AS total_chunks FROM s GROUP BY 1")
def symbol_chunks(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", F.concat("p_brand", F.col("p_partkey").cast("string")).alias("symbol"))
    return chunk(parts, "p_partkey", "symbol", 50).withColumn("members", F.array_join("members", ","))


_UNIVERSE = "SELECT upper(trim(p_brand)) AS s FROM part UNION SELECT upper(trim(s_name)) FROM supplier UNION SELECT upper(trim(c_mktsegment)) FROM customer"


@query(f"SELECT DISTINCT s AS symbol FROM ({_UNIVERSE}) WHERE s <> ''")
def universe_union(spark, sf_dir):
    lists = [table(spark, sf_dir, t).select(normalize_symbol(F.col(c)).alias("symbol")) for t, c in (("part", "p_brand"), ("supplier", "s_name"), ("customer", "c_mktsegment"))]
    return universe(*lists)


_LISTED = ["CASE WHEN p_partkey % 9 = 0 THEN 'File Creation Time: 0101' WHEN p_partkey % 13 = 0 THEN NULL ELSE concat(p_brand, '.', CAST(p_partkey AS STRING)) END AS symbol",
           "p_name AS name", "CASE WHEN p_partkey % 4 = 0 THEN 'Y' ELSE 'N' END AS test_issue", "CASE WHEN p_size % 2 = 0 THEN 'N' ELSE 'A' END AS exchange"]


def _listing(sep):
    def run(spark, sf_dir):
        """A landed listing with a header, test issues, other exchanges' issues and trailer rows: the real issues of the exchange."""
        path = fresh_path(spark)
        table(spark, sf_dir, "part").selectExpr(*_LISTED).write.option("header", True).option("sep", sep).csv(path)
        return listed_symbols(read_listing(spark, path, sep), "symbol", "test_issue", ("exchange", "N") if sep == "|" else None)

    return run


_ISSUES = "SELECT upper(trim(p_brand)) || '-' || CAST(p_partkey AS STRING) AS symbol FROM part WHERE p_partkey % 4 <> 0 AND p_partkey % 9 <> 0 AND p_partkey % 13 <> 0"
query(_ISSUES, name="universe_listing_csv")(_listing(","))
query(f"{_ISSUES} AND p_size % 2 = 0", name="universe_exchange")(_listing("|"))


@query("SELECT o_orderkey, trim(unnest(['A' || o_custkey, 'B-' || o_orderkey])) AS symbol FROM orders")
def symbol_universe_parse(spark, sf_dir):
    text = F.expr("CASE WHEN o_orderkey % 2 = 0 THEN concat('[\"A', o_custkey, '\", \" \", \"B-', o_orderkey, ' \"]') ELSE concat('A', o_custkey, '\\n\\n B-', o_orderkey, '\\n') END")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.explode(parse_symbols(text)).alias("symbol"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'P1,P2' WHEN o_orderkey % 3 = 1 THEN 'C' || o_custkey ELSE 'AAPL' END AS symbols FROM orders")
def symbol_source_precedence(spark, sf_dir):
    """The first source that has symbols: a stored parameter, an object, the event, or the default."""
    texts = ["CASE WHEN o_orderkey % 3 = 0 THEN '[\"P1\", \" P2 \"]' WHEN o_orderkey % 3 = 1 THEN ' \n ' END", "CASE WHEN o_orderkey % 3 = 1 THEN concat('C', o_custkey, '\n') WHEN o_orderkey % 3 = 2 THEN '[]' END", "CAST(NULL AS STRING)"]
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(first_symbols(*map(F.expr, texts)), ",").alias("symbols"))


CHUNKS = view_sql("chunks")


@query(f"{CHUNKS} SELECT symbol, ds, count(*) AS n FROM chunks GROUP BY ALL")
def land_raw_counts(spark, sf_dir):
    return counts_by(view(spark, sf_dir, "chunks"), "symbol", "ds")


@query(f"{CHUNKS}, o AS (SELECT ds, symbol, sum(records)::BIGINT AS records FROM chunks GROUP BY ALL) SELECT ds, count(*) AS objects_n, sum(records)::BIGINT AS records, string_agg(symbol || ':' || records, ',' ORDER BY symbol) AS objects FROM o GROUP BY ds")
def manifest_build(spark, sf_dir):
    objects = view(spark, sf_dir, "chunks").groupBy("ds", "symbol").agg(F.sum("records").alias("records"))
    shown = F.array_join(F.transform("objects", lambda o: F.concat_ws(":", o["symbol"], o["records"])), ",")
    return manifests(objects).withColumn("objects", shown)


@query(f"{CHUNKS}, s AS (SELECT ds, batch_id AS seq, 'raw/' || batch_id AS raw_prefix, count(*) AS n FROM chunks GROUP BY ALL) SELECT ds, arg_min(raw_prefix, seq) AS raw_prefix, sum(n)::BIGINT AS n_objects, count(*) AS n_chunks FROM s GROUP BY ds")
def merge_chunks(spark, sf_dir):
    s = view(spark, sf_dir, "chunks").groupBy("ds", F.col("batch_id").alias("seq"), F.concat(F.lit("raw/"), F.col("batch_id").cast("string")).alias("raw_prefix")).agg(F.count("*").alias("n_objects"))
    return merged(s)


@query(f"""{CHUNKS}, p AS (SELECT ds, 'raw/' || min(batch_id) AS raw_prefix FROM chunks GROUP BY ds)
 SELECT ds, raw_prefix, batch_id, symbol, records FROM chunks JOIN p USING (ds)""")
def merge_chunk_objects(spark, sf_dir):
    objects = F.collect_list(F.struct("symbol", "records")).alias("objects")
    s = view(spark, sf_dir, "chunks").groupBy("ds", F.col("batch_id").alias("seq"), F.concat(F.lit("raw/"), F.col("batch_id").cast("string")).alias("raw_prefix")).agg(objects)
    return merged_objects(s).select("ds", "raw_prefix", F.col("place.seq").alias("batch_id"), "object.symbol", "object.records")


_EXPECTED = "SELECT o_orderkey AS batch_id, CAST(o_custkey % 6 + 1 AS BIGINT) AS expected_chunks FROM orders"


@query(f"{CHUNKS}, e AS ({_EXPECTED}), c AS (SELECT batch_id, count(DISTINCT chunk_id) AS n FROM chunks GROUP BY 1) SELECT e.batch_id, expected_chunks, coalesce(n, 0) AS processed_chunks, CASE WHEN coalesce(n, 0) >= expected_chunks THEN 'complete' ELSE 'processing' END AS status FROM e LEFT JOIN c USING (batch_id)")
def batch_progress(spark, sf_dir):
    expected = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS batch_id", "CAST(o_custkey % 6 + 1 AS BIGINT) AS expected_chunks")
    return progress(view(spark, sf_dir, "chunks"), expected)


@query(f"{CHANGES} SELECT event_id, batch_id, new_status, old_status FROM batch_changes WHERE change = 'MODIFY' AND lower(new_status) = 'complete' AND lower(old_status) <> 'complete' AND run_id IS NULL")
def completed_transitions(spark, sf_dir):
    return completed(view(spark, sf_dir, "batch_changes")).select("event_id", "batch_id", "new_status", "old_status")


@query("SELECT user_id AS batch_id, bool_or(event_type = 'error') AS refresh FROM events GROUP BY 1")
def catalog_refresh_needed(spark, sf_dir):
    return any_true(table(spark, sf_dir, "events").withColumnRenamed("user_id", "batch_id"), "batch_id", F.col("event_type") == "error")


@query(f"{PRICES} SELECT DISTINCT ds FROM prices")
def processed_dates(spark, sf_dir):
    return days_of(view(spark, sf_dir, "prices"))


_VERSIONS = ["p_brand AS table_name", "p_partkey AS version", "concat(p_type, CAST(p_size % 2 AS STRING)) AS hash"]
VERSIONS = f"WITH v AS (SELECT {', '.join(_VERSIONS)} FROM part), l AS (SELECT *, lag(hash) OVER (PARTITION BY table_name ORDER BY version) AS previous_hash FROM v)"


@query(f"{VERSIONS} SELECT * FROM l")
def schema_lag(spark, sf_dir):
    return previous_hash(table(spark, sf_dir, "part").selectExpr(*_VERSIONS))


@query(f"{VERSIONS} SELECT table_name, version, CASE WHEN version % 7 = 0 THEN FALSE WHEN version % 7 = 1 THEN TRUE WHEN version % 7 = 2 THEN FALSE WHEN previous_hash IS NULL THEN TRUE ELSE hash <> previous_hash END AS refresh FROM l")
def schema_change(spark, sf_dir):
    df = previous_hash(table(spark, sf_dir, "part").selectExpr(*_VERSIONS))
    n = F.col("version") % 7
    policy = F.when(n == 0, "never").when(n == 1, " force ").when(n == 3, " ")
    return df.select("table_name", "version", refresh_needed(policy, F.col("hash"), F.col("previous_hash"), n != 2).alias("refresh"))


@query("""WITH o AS (SELECT p_partkey AS name, p_type AS t FROM part WHERE p_partkey % 5 <> 0), n AS (SELECT p_partkey AS name, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_type END AS t FROM part WHERE p_partkey % 7 <> 0)
 SELECT CAST(coalesce(o.name, n.name) AS STRING) AS name, o.t AS old_type, n.t AS new_type, CASE WHEN o.t IS NULL THEN 'added' WHEN n.t IS NULL THEN 'removed' ELSE 'retyped' END AS change FROM o FULL JOIN n ON o.name = n.name WHERE o.t IS DISTINCT FROM n.t""")
def schema_diff(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumn("name", F.col("p_partkey").cast("string"))
    old = part.where("p_partkey % 5 <> 0").select("name", F.col("p_type").alias("type"))
    return diff(old, part.where("p_partkey % 7 <> 0").select("name", F.expr("CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_type END AS type")))


@query(f"{CHUNKS} SELECT * FROM chunks c WHERE NOT EXISTS (SELECT 1 FROM chunks x WHERE x.batch_id % 4 = 0 AND x.symbol = c.symbol AND x.ds = c.ds)")
def write_once_new(spark, sf_dir):
    chunks = view(spark, sf_dir, "chunks")
    return chunks.join(chunks.where("batch_id % 4 = 0").select("symbol", "ds"), ["symbol", "ds"], "left_anti").select(chunks.columns)


@query(f"{PRICES}, d AS ({_DONE}) SELECT ds, count(*) AS n FROM prices WHERE ds IN (SELECT ds FROM d) GROUP BY ds")
def compaction_guard(spark, sf_dir):
    return counts_by(only_done(view(spark, sf_dir, "prices"), _done(spark, sf_dir)), "ds")


#: What trackers and chunk summaries of a customer's orders say of their days: five places, blank keys, trackers with nothing usable.
_FOUND = ["o_custkey AS batch_id", "o_orderkey AS seq", "CAST(CAST(o_orderdate AS DATE) AS STRING) AS ds",
          "CASE WHEN o_custkey % 4 = 0 THEN 'chunk_summary' ELSE CASE o_orderpriority WHEN '1-URGENT' THEN 'manifest_keys' WHEN '2-HIGH' THEN 'finalizing' WHEN '3-MEDIUM' THEN 'combined' WHEN '5-LOW' THEN 'chunk_summary' ELSE 'payload' END END AS place",
          "CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE concat('m/year=', substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 4), '/month=', substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 6, 2), '/day=', substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 9, 2), '/', CAST(o_orderkey AS STRING), '.json') END AS manifest_key"]


@query(f"""WITH f AS (SELECT {', '.join(_FOUND)} FROM orders), g AS (SELECT *, nullif(trim(manifest_key), '') AS given,
  CASE place WHEN 'manifest_keys' THEN 1 WHEN 'finalizing' THEN 2 WHEN 'combined' THEN 3 WHEN 'payload' THEN 4 ELSE 5 END AS r FROM f),
 k AS (SELECT *, coalesce(given, 'market/prices/interval=1d/data_source=yahoo_finance/year=' || substr(ds,1,4) || '/month=' || substr(ds,6,2) || '/day=' || substr(ds,9,2) || '/_batch.manifest.json') AS key
  FROM g WHERE r > 1 OR given IS NOT NULL),
 u AS (SELECT * FROM k WHERE r < 5 OR batch_id NOT IN (SELECT batch_id FROM k WHERE r < 5)),
 n AS (SELECT *, row_number() OVER (PARTITION BY batch_id, ds ORDER BY r, seq) AS n FROM u)
 SELECT batch_id, ds, key AS manifest_key, CASE WHEN r = 5 THEN 'chunk_summary' WHEN given IS NULL THEN 'computed' ELSE 'dynamodb' END AS source FROM n WHERE n = 1""")
def manifest_precedence(spark, sf_dir):
    found = table(spark, sf_dir, "orders").selectExpr(*_FOUND)
    return manifest_entries(found, F.lit("market"), F.lit("prices"), F.lit("1d"), F.lit("yahoo_finance"))


@query(f"{CHUNKS}, a AS (SELECT ds, symbol, count(*) AS landed FROM chunks WHERE batch_id % 9 <> 0 GROUP BY ALL), b AS (SELECT ds, symbol, count(*) AS curated FROM chunks WHERE chunk_id <> 3 GROUP BY ALL) SELECT ds, symbol, landed, curated, coalesce(landed, 0) = coalesce(curated, 0) AS same FROM a FULL JOIN b USING (ds, symbol)")
def reconcile(spark, sf_dir):
    chunks = view(spark, sf_dir, "chunks")
    return reconciled(chunks.where("batch_id % 9 <> 0"), chunks.where("chunk_id <> 3"), ("ds", "symbol"), ("landed", "curated"))


ALARMS = """WITH w AS (SELECT event_type AS series, CAST(floor(epoch(ts) / 21600) * 21600 AS BIGINT) AS window_start, count(*) AS value FROM events GROUP BY ALL),
 g AS (SELECT series, unnest(generate_series(min(window_start), max(window_start), 21600)) AS window_start FROM w GROUP BY series),
 f AS (SELECT g.series, g.window_start, coalesce(w.value, 0) AS value FROM g LEFT JOIN w USING (series, window_start))"""


@query(f"{ALARMS} SELECT series, window_start, value, sum(CASE WHEN value > 3 THEN 1 ELSE 0 END) OVER (PARTITION BY series ORDER BY window_start ROWS 2 PRECEDING) = 3 AS alarm FROM f")
def alarm_m_of_n(spark, sf_dir):
    start = (F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 21600) * 21600).cast("long")
    windows = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("series"), start.alias("window_start")).agg(F.count("*").alias("value"))
    return m_of_n(windows, 3, 3, minutes=360)
