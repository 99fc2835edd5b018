import pytest
from pyspark.sql import functions as F

from tidewell.functions.keys import curated_key_error
from tidewell.functions.prices import adjust
from tidewell.operators.batches import rank_all
from tidewell.operators.quality import Gate, gate_rows, metrics, rules_for, type_issues, verdict
from tidewell.operators.schema_versions import fingerprint
from tidewell.plans.backfill import backfill_days
from tidewell.sources.readers import has_rows, parse_symbols, read_compacted_first, read_raw
from tidewell.sources.writers import gate_and_write, land_raw, register_table, write_layer

COUNTS = "ds string, record_count long, null_symbol_count long, negative_price_count long, duplicate_key_groups long, invalid_numeric_type_issues long"


@pytest.mark.parametrize("row,gate,critical,warnings,action,first", [
    ((0, 0, 0, 0, 0), Gate(10, 5.0), 0, 0, "quarantine", "NO_RAW_DATA"),
    ((100, 6, 0, 2, 1), Gate(50, 5.0), 6, 3, "quarantine", "null symbol"),
    ((100, 2, 1, 1, 1), Gate(50, 5.0), 3, 2, "proceed", "null symbol"),
    ((9, 0, 0, 0, 0), Gate(10, 5.0), 0, 1, "proceed", "low record count"),
    ((100, 2, 3, 0, 0), Gate(1, 5.0), 5, 0, "proceed", "null symbol"),
    ((100, 3, 3, 0, 0), Gate(1, 5.0), 6, 0, "quarantine", "null symbol"),
    ((10, 0, 0, 0, 0), Gate(1, 5.0), 0, 0, "proceed", "DQ OK"),
    ((100, 0, 0, 3, 2), Gate(50, 5.0), 0, 5, "proceed", "duplicate key"),
])
def test_verdict(spark, row, gate, critical, warnings, action, first):
    r = verdict(spark.createDataFrame([("d", *row)], COUNTS), gate).first()
    assert (r.critical_violations, r.warning_violations, r.action) == (critical, warnings, action) and r.messages[0].startswith(first)


def test_adjust(spark):
    df = spark.createDataFrame([("a", 10.0, 5.0, 100, 1.0, 2.0, 3.0), ("b", 0.0, 5.0, 7, 1.0, 1.0, 1.0), ("c", 4.0, None, 7, 1.0, 1.0, 1.0)], "symbol string, close double, adjusted_close double, volume long, open double, high double, low double")
    rows = {r.symbol: r for r in adjust(df).collect()}
    assert (rows["a"].close, rows["a"].volume, rows["a"].open, rows["a"].raw_close, rows["a"].adjustment_factor) == (5.0, 200.0, 0.5, 10.0, 0.5)
    assert (rows["b"].close, rows["b"].open, rows["b"].adjustment_factor) == (5.0, 1.0, None) and rows["c"].close == 4.0
    assert adjust(df.drop("adjusted_close")).columns == df.drop("adjusted_close").columns
    assert adjust(df.drop("low")).where("open = 1.0").count() == 3


def test_quality_edges(spark):
    df = spark.createDataFrame([("d", None, -1.0), ("d", "x", float("nan")), (None, "y", 1.0), (None, "y", 1.0)], "ds string, symbol string, price double")
    good, bad = gate_rows(df)
    assert good.count() == 2 and bad.count() == 2 and type_issues(df) == 1
    assert metrics(df.limit(0)).count() == 0 and rules_for("none", "none") == {"allow_duplicates": True}


def test_fingerprint_depends_on_order_only(spark):
    a, b = spark.range(1).selectExpr("id a", "'x' b", "'d' ds"), spark.range(1).selectExpr("'x' b", "id a")
    assert fingerprint(a.schema)["hash"] == fingerprint(a.drop("ds").schema, "snappy")["hash"] != fingerprint(b.schema)["hash"]


def test_key_errors(spark):
    keys = ["", "a/b", "M/p/interval=1d/year=2024/month=01/day=01/layer=x/f.parquet", "m/p/interval=1d/data_source=s/year=2024/month=01/day=32/layer=x/f.parquet", "m/p/interval=1d/year=2024/month=01/day=01/layer=x/f.parquet"]
    rows = spark.createDataFrame([(k,) for k in [*keys, None]], "k string").select(curated_key_error(F.col("k")).alias("e")).collect()
    assert [r.e for r in rows] == ["key must be a non-empty string", "Invalid curated key format", "Invalid domain in key", "Invalid day segment in key", None, "key must be a non-empty string"]


def test_backfill_clamp(spark):
    df = spark.createDataFrame([(1, "2025-09-03", "2025-09-01"), (2, "2025-01-01", "2025-12-31")], "id int, a string, b string")
    days = backfill_days(df, "a", "b").groupBy("id").count().orderBy("id").collect()
    assert [r["count"] for r in days] == [3, 31]


def test_rank_all(spark):
    df = spark.range(0, 20_000, 3).repartition(7)
    assert [r.r for r in rank_all(df, "id", "r", 100).orderBy("id").collect()] == list(range(df.count()))


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([("A", "2024-01-02", 1.0)], "symbol string, ds string, close double")
    df.write.json(f"{tmp_path}/raw")
    with pytest.raises(ValueError):
        read_raw(spark, f"{tmp_path}/raw", "xml")
    assert read_compacted_first(spark, f"{tmp_path}/none", f"{tmp_path}/raw", "JSON").first().close == 1.0
    assert has_rows(df) and not has_rows(df.limit(0))
    text = spark.createDataFrame([('["A", " ", "b "]',), ("A\n\n b\n",)], "t string")
    assert [r.s for r in text.select(parse_symbols(F.col("t")).alias("s")).collect()] == [["A", "b"], ["A", "b"]]


def test_sinks(spark, tmp_path):
    rows = [("A", "2024-01-02", 1.0, 1.0, 5), ("B", "2024-01-02", 1.0, 2.0, 5), (None, "2024-01-03", 1.0, 1.0, 5)]
    df = spark.createDataFrame(rows, "symbol string, ds string, close double, adjusted_close double, volume long")
    root = f"{tmp_path}/curated"
    with pytest.raises(ValueError, match="DQ_FAILED: null symbol present"):
        gate_and_write(df, root)
    write_layer(df.where("symbol = 'A'"), root, "compacted")
    assert {(r.layer, r["count"]) for r in spark.read.parquet(root).groupBy("layer").count().collect()} == {("adjusted", 2), ("quarantine", 1), ("compacted", 1)}
    register_table(spark, "curated_prices", root)
    assert spark.table("curated_prices_good").count() == 3
    land_raw(df.where("symbol IS NOT NULL"), f"{tmp_path}/landed", gzip=True)
    land_raw(df.where("symbol IS NOT NULL"), f"{tmp_path}/landed", existing=df.where("symbol IS NOT NULL"))
    assert spark.read.json(f"{tmp_path}/landed").count() == 2
