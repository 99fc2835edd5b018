"""Price, file-event and batch views over the star-schema tables.

Each view is a list of SQL expressions that mean the same in Spark and in DuckDB, so the SQL of a query
starts from the same rows. Faults (null symbols, negative prices, bad keys) are planted by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.session import table

_BASE = "(l_extendedprice / l_quantity)"
_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"

VIEWS: dict[str, tuple[str, list[str]]] = {
    "prices": ("lineitem", [
        "CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE concat('P', CAST(l_partkey AS STRING)) END AS symbol",
        "CAST(CAST(l_shipdate AS DATE) AS STRING) AS ds",
        f"{_BASE} * 0.99E0 AS open", f"{_BASE} * 1.02E0 AS high", f"{_BASE} * 0.98E0 AS low",
        f"CASE WHEN l_orderkey % 89 = 0 THEN -{_BASE} WHEN l_orderkey % 83 = 0 THEN 0.0E0 ELSE {_BASE} END AS close",
        f"CASE WHEN l_linenumber = 7 THEN NULL ELSE {_BASE} * (1.0E0 - l_discount) END AS adjusted_close",
        "CAST(l_quantity AS BIGINT) AS volume",
    ]),
    "file_events": ("orders", [
        "o_orderkey AS event_id",
        "CASE WHEN o_orderkey % 29 = 0 THEN 'other' ELSE 'aws.s3' END AS source",
        "CASE WHEN o_orderkey % 31 = 0 THEN 'Object Deleted' ELSE 'Object Created' END AS detail_type",
        "CASE WHEN o_orderkey % 37 = 0 THEN 'Bad_Bucket' ELSE 'curated-bucket' END AS bucket",
        "concat(CASE o_orderkey % 5 WHEN 0 THEN 'market' WHEN 1 THEN 'daily-prices-data' WHEN 2 THEN 'product' WHEN 3 THEN 'weather' ELSE 'market' END,"
        " CASE WHEN o_orderkey % 23 = 0 THEN '_X' ELSE '' END, '/prices/interval=1d',"
        " CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE '/data_source=yahoo_finance' END,"
        f" '/year=', substr({_DAY}, 1, 4), '/month=', CASE WHEN o_orderkey % 13 = 0 THEN '13' ELSE substr({_DAY}, 6, 2) END, '/day=', substr({_DAY}, 9, 2),"
        " '/layer=', CASE WHEN o_orderkey % 7 = 0 THEN 'quarantine' WHEN o_orderkey % 7 = 1 THEN 'compacted' ELSE 'adjusted' END,"
        " '/part-', CAST(o_orderkey AS STRING), CASE WHEN o_orderkey % 17 = 0 THEN '.json' ELSE '.parquet' END) AS key",
        "CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST(floor(o_totalprice) AS BIGINT) END AS size",
        f"{_DAY} AS ds",
    ]),
    "batch_changes": ("events", [
        "event_id", "ts", "user_id AS batch_id",
        "CASE WHEN event_type = 'purchase' THEN 'MODIFY' WHEN event_type = 'click' THEN 'MODIFY' ELSE 'INSERT' END AS change",
        "CASE WHEN event_id % 3 = 0 THEN 'Complete' WHEN event_id % 3 = 1 THEN 'complete' ELSE 'processing' END AS new_status",
        "CASE WHEN event_id % 7 = 0 THEN 'COMPLETE' ELSE 'finalizing' END AS old_status",
        "CASE WHEN event_id % 11 = 0 THEN 'run-1' ELSE NULL END AS run_id",
        "CASE WHEN event_id % 5 = 0 THEN '' ELSE 'market' END AS meta_domain",
        "CASE WHEN event_id % 6 = 0 THEN NULL ELSE 'prices_daily' END AS meta_table_name",
    ]),
    "chunks": ("lineitem", [
        "l_orderkey AS batch_id", "l_linenumber AS chunk_id", "CAST(CAST(l_shipdate AS DATE) AS STRING) AS ds",
        "concat('P', CAST(l_partkey AS STRING)) AS symbol", "CAST(l_quantity AS BIGINT) AS records",
    ]),
    "errors": ("events", [
        "event_id", "ts", "event_type AS source",
        "CASE WHEN event_id % 9 = 0 THEN NULL ELSE concat('failed ', CAST(user_id AS STRING)) END AS error_message",
        "CASE event_id % 4 WHEN 0 THEN 'CRITICAL' WHEN 1 THEN 'WARNING' ELSE NULL END AS severity",
        "CASE event_id % 3 WHEN 0 THEN 'Timeout' WHEN 1 THEN 'Parse' ELSE NULL END AS error_type",
        "CASE WHEN event_id % 2 = 0 THEN 'market' ELSE NULL END AS domain",
        "value",
    ]),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    base, columns = VIEWS[name]
    return table(spark, sf_dir, base).selectExpr(*columns)


def view_sql(*names: str) -> str:
    """``WITH`` clause that defines the named views."""
    return "WITH " + ", ".join(f"{n} AS (SELECT {', '.join(VIEWS[n][1])} FROM {VIEWS[n][0]})" for n in names)
