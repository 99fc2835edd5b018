"""Round trips: written in the shared folder, read back, and compared with the rows that went in."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.operators.load import ledger
from tidewell.registered.prices import OHL, PRICES, VOLUME
from tidewell.registered.quality import GATE, METRICS
from tidewell.registered.registry import query
from tidewell.functions.prices import adjust
from tidewell.operators.quality import day_verdicts, gate_rows, with_layer
from tidewell.operators.batches import only_done
from tidewell.session import fresh_path, settle, table
from tidewell.sources.listing import listed_partitions
from tidewell.sources.readers import RAW_PRICE, manifest_objects as objects_of, read_day, read_layers, read_raw, wide_to_long as unpivoted
from tidewell.sources.writers import compact, report_by_layer, write_layer, write_manifests
from tidewell.views import view

_COLUMNS = "symbol, ds, open, high, low, close, adjusted_close, volume"
_ALL = f"{PRICES} SELECT {_COLUMNS} FROM prices"


def _scan(kind: str):
    def run(spark, sf_dir):
        path = fresh_path(spark)
        df = view(spark, sf_dir, "prices")
        writer = df.write.option("header", True) if kind == "csv" else df.write
        writer.format(kind).save(path)
        return read_raw(spark, path, kind.upper(), RAW_PRICE)

    return run


for _kind in ("json", "csv", "parquet"):
    query(_ALL, name=f"scan_{_kind}")(_scan(_kind))


@query(_ALL)
def compact_roundtrip(spark, sf_dir):
    path = fresh_path(spark)
    compact(view(spark, sf_dir, "prices"), path)
    return spark.read.schema(RAW_PRICE).parquet(path)


def _monthly(df):
    """One partition per month keeps the number of folders in keeping with the rows."""
    return df.withColumns({"day_of": F.col("ds"), "ds": F.concat(F.substring("ds", 1, 8), F.lit("01"))})


@query(f"{METRICS}, f AS (SELECT p.*, CASE WHEN adjusted_close IS NOT NULL AND close <> 0 THEN adjusted_close / close END AS adjustment_factor FROM prices p JOIN v USING (ds) WHERE rate <= {GATE.max_critical_rate}) SELECT symbol, ds, {OHL}, coalesce(adjusted_close, close) AS close, {VOLUME}, substr(ds, 6, 2) AS month, 'adjusted' AS layer FROM f")
def curated_roundtrip(spark, sf_dir):
    path = fresh_path(spark)
    write_layer(_monthly(adjust(gate_rows(view(spark, sf_dir, "prices"), GATE)[0])), path, "adjusted")
    return read_layers(spark, path).select("symbol", F.col("day_of").alias("ds"), "open", "high", "low", "close", "volume", "month", "layer")


@query(f"{PRICES} SELECT symbol, ds, close FROM prices WHERE ds >= '1995-06-01' AND ds < '1995-07-01'")
def partition_pruned_scan(spark, sf_dir):
    path = fresh_path(spark)
    write_layer(_monthly(view(spark, sf_dir, "prices")), path, "adjusted")
    return read_day(spark, path, "1995-06-01", layer="adjusted").select("symbol", F.col("day_of").alias("ds"), "close")


@query(f"{PRICES} SELECT ds, 'adjusted' AS layer, count(*) AS n FROM prices GROUP BY ds")
def listed_days(spark, sf_dir):
    """The days of a written layer by its listing, each with its rows: those of days that aren't listed would be missing."""
    path = fresh_path(spark)
    prices = view(spark, sf_dir, "prices")
    write_layer(prices.select("symbol", "ds", F.col("ds").alias("day_of"), "close"), path, "adjusted")
    there = listed_partitions(spark, path).where("files > 0 AND bytes > 0").select("ds", "layer")
    return only_done(prices, there).groupBy("ds").count().withColumnRenamed("count", "n").join(there, "ds").select("ds", "layer", "n")


MANIFESTS = f"{PRICES}, o AS (SELECT ds, symbol, count(*) AS records FROM prices WHERE symbol IS NOT NULL GROUP BY ALL) SELECT ds, symbol, records FROM o"


@query(MANIFESTS)
def manifest_objects(spark, sf_dir):
    path = fresh_path(spark)
    write_manifests(view(spark, sf_dir, "prices").where("symbol IS NOT NULL").groupBy("ds", "symbol").agg(F.count("*").alias("records")), path)
    return objects_of(spark, path).select("ds", "symbol", "records")


@query("SELECT l_orderkey, l_linenumber, unnest(['AAA', 'BBB']) AS symbol, unnest([l_extendedprice, l_tax]) AS close, unnest([l_quantity, NULL]) AS volume FROM lineitem")
def wide_to_long(spark, sf_dir):
    wide = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("AAA_close"), F.col("l_quantity").alias("AAA_volume"), F.col("l_tax").alias("BBB_close"), F.lit(None).cast("double").alias("CCC_close"))
    return unpivoted(wide, ["l_orderkey", "l_linenumber"], ["close", "volume"])


@query(f"{PRICES} SELECT count(*) AS records, count(DISTINCT ds) AS days FROM prices")
def load_ledger(spark, sf_dir):
    """Records of all files of a loaded table, from its ledger."""
    path = fresh_path(spark)
    compact(view(spark, sf_dir, "prices"), path)
    days = view(spark, sf_dir, "prices").agg(F.count_distinct("ds").alias("days"))
    return ledger(spark.read.parquet(path)).where("file_size > 0").agg(F.sum("record_count").alias("records")).crossJoin(days)


@query(f"{METRICS} SELECT action AS layer, count(*) AS days, sum(record_count)::BIGINT AS records, min(ds) AS first_ds, max(ds) AS last_ds FROM (SELECT *, CASE WHEN rate > {GATE.max_critical_rate} THEN 'quarantine' ELSE 'adjusted' END AS action FROM v) GROUP BY 1")
def pipeline_summary(spark, sf_dir):
    layer = F.when(F.col("action") == "quarantine", "quarantine").otherwise("adjusted")
    return day_verdicts(view(spark, sf_dir, "prices"), GATE).groupBy(layer.alias("layer")).agg(
        F.count("*").alias("days"), F.sum("record_count").alias("records"), F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"))


@query(f"""{METRICS}, r AS (SELECT p.ds, rate > {GATE.max_critical_rate} AS bad FROM prices p JOIN v USING (ds))
 SELECT l.layer, count(r.ds) AS records, count(DISTINCT r.ds) AS days, min(r.ds) AS first_ds, max(r.ds) AS last_ds
 FROM (VALUES ('adjusted', FALSE), ('quarantine', TRUE)) l(layer, bad) LEFT JOIN r ON r.bad = l.bad GROUP BY 1""")
def run_report(spark, sf_dir):
    prices = view(spark, sf_dir, "prices")
    return report_by_layer(with_layer(prices, settle(day_verdicts(prices, GATE))), ("adjusted", "quarantine"))
