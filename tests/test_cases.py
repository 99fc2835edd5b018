"""Literal cases of white space, symbols, rounding, tables without keys, ranges, arguments and texts."""

import random

import pytest
from pyspark.sql import functions as F

from tidewell.functions.scalars import normalize_symbol, status_subject, status_text, stripped
from tidewell.operators.metrics import m_of_n
from tidewell.operators.quality import Gate, day_verdicts, duplicate_groups, two_decimals
from tidewell.plans.backfill import JobSettings, backfill_days, backfill_items, normalized_request
from tidewell.sources.readers import first_symbols, parse_symbols, split_symbols
from tidewell.sources.writers import gate_and_write


def values(spark, rows, column, kind="string"):
    return [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(rows)], f"i int, x {kind}").orderBy("i").select(column(F.col("x"))).collect()]


def test_white_space(spark):
    texts = [" a ", "\ta\r\n", "\x0ba\x0c", " a ", "\x1ca\x85", "a b", "", "\t", None]
    assert values(spark, texts, stripped) == [None if t is None else t.strip() for t in texts]
    assert values(spark, ["brk.b\r", "\tbf.a "], normalize_symbol) == ["BRK-B", "BF-A"]
    good, bad = split_symbols(spark.createDataFrame([("A\n",), ("\t",), (" ",), (None,), ("B",)], "s string"), "s")
    assert sorted(r.s for r in good.collect()) == ["A", "B"] and bad.count() == 3


def test_symbols_of_texts(spark):
    cases = {
        "AAPL\r\nMSFT\r\n": ["AAPL", "MSFT"], "A\rB\n\n C \x85D": ["A", "B", "C", "D"], '["A", " B ", ""]': ["A", "B"], '[1, 2.5, null, "x", {"a": 1}, ["y"], 12345678901234567890]': ["1", "x", "12345678901234567890"],
        ' \n ["A"] \n': ["A"], "[]": [], '["A", "B"': ['["A", "B"'], "[A\nB]": ["[A", "B]"], '{"a": 1}': ['{"a": 1}'], '"A"': ['"A"'], "": [], " \n\t": [],
    }
    assert dict(zip(cases, values(spark, list(cases), parse_symbols))) == cases
    assert values(spark, ["[]", " \n", "X"], lambda c: first_symbols(c, F.lit(None).cast("string"))) == [["AAPL"], ["AAPL"], ["X"]]


def test_rates_are_rounded_by_their_binary_value(spark):
    rng = random.Random(1)
    rates = [107 / 4000 * 100, 2.675, 2.665, 0.125, 0.375, 1.005, 100.0, 0.0, 1e-9, 99.995, 33.335] + [rng.randrange(1, 4000) / rng.randrange(4000, 9000) * 100.0 for _ in range(3000)] + [k / 8 for k in range(200)] + [k / 1000 for k in range(1, 3000, 5)]
    assert values(spark, rates, two_decimals, "double") == [f"{r:.2f}" for r in rates]
    df = spark.createDataFrame([("d", None if k < 107 else "s", -k) for k in range(4000)], "ds string, symbol string, id int")
    assert "Critical Error Rate: 2.67% (threshold: 2.0%)" in day_verdicts(df, Gate(max_critical_rate=2.0)).first().messages


def test_tables_without_keys(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-01", 1.0), ("2024-01-01", 1.0)], "ds string, close double")
    assert duplicate_groups(df).first().duplicate_key_groups == 0
    verdict = gate_and_write(df, f"{tmp_path}/t").first()
    assert (verdict.record_count, verdict.duplicate_key_groups, verdict.action) == (2, 0, "proceed") and spark.read.parquet(f"{tmp_path}/t").count() == 2


def test_an_alarm_is_above_its_threshold(spark):
    windows = spark.createDataFrame([("q", 0, 100.0), ("q", 300, 100.0), ("q", 600, 101.0), ("q", 900, 101.0), ("q", 1500, 101.0)], "series string, window_start long, value double")
    assert [r.alarm for r in m_of_n(windows, 2, 100).orderBy("window_start").collect()] == [False, False, False, True, False, False]


@pytest.mark.parametrize("start, end, days", [("2024-01-01", "2024-01-03", 3), ("2024-01-03", "2024-01-01", 3), ("2024-01-01", "2024-06-01", 31), (" 2024-02-29 ", "2024-02-29", 1), ("", "2024-01-03", 0), (None, "2024-01-03", 0), ("2024-01-01", " ", 0), ("2024-01-01", None, 0)])
def test_days_of_a_range(spark, start, end, days):
    rows = backfill_days(spark.createDataFrame([(start, end)], "a string, b string"), "a", "b").collect()
    assert len(rows) == days and (not rows or rows[0].ds == min(x for x in (start.strip(), end.strip())))


def test_a_request_has_a_range_with_both_ends(spark):
    rows = [(None, "t", None, "2024-01-01", "2024-01-02"), (" CSV ", "", "old", "", "2024-01-02"), ("", None, "old", "2024-01-01", " "), ("json", "\tt\n", None, None, None)]
    df = spark.createDataFrame([(*r, ["\t.json", " "]) for r in rows], "file_type string, table_name string, legacy_table string, range_start string, range_end string, suffixes array<string>")
    assert [(r.file_type, r.has_range, r.suffixes) for r in normalized_request(df).collect()] == [("json", True, [".json"]), ("csv", False, [".json"]), ("json", False, [".json"]), ("json", False, [".json"])]


def test_items_of_a_backfill(spark):
    """2025-09-01 to 03 with 02 there: run, skip, run, each job with all its arguments."""
    asked = backfill_days(spark.createDataFrame([("2025-09-01", "2025-09-03")], "a string, b string"), "a", "b").select("ds")
    settings = JobSettings("prod", "raw", "curated", "artifacts", "compacted", "20", "1.5", "x")
    rows = {r.ds: r for r in backfill_items(asked, spark.createDataFrame([("2025-09-02",)], "ds string"), F.lit("market"), F.lit("prices"), F.lit("1d"), F.lit("yahoo"), F.lit("csv"), F.lit(" force "), settings).collect()}
    assert [(rows[d].proceed, rows[d].code) for d in sorted(rows)] == [(True, None), (False, "IDEMPOTENT_SKIP"), (True, None)]
    skipped = rows["2025-09-02"]
    assert (skipped.reason, skipped.message, skipped.catalog_update, skipped.codec, skipped.curated_path, skipped.domain) == ("Already processed", "Curated partition already exists", "force", None, None, None)
    job = rows["2025-09-03"].asDict()
    assert job == {"ds": "2025-09-03", "proceed": True, "code": None, "reason": None, "message": None, "catalog_update": "force", "environment": "prod", "domain": "market", "table_name": "prices", "raw_bucket": "raw",
                   "raw_prefix": "market/prices/interval=1d/data_source=yahoo/", "compacted_bucket": "curated", "curated_bucket": "curated", "curated_layer": "adjusted", "compacted_layer": "compacted",
                   "schema_fingerprint_s3_uri": "s3://artifacts/market/prices/_schema/latest.json", "codec": "zstd", "target_file_mb": "256", "expected_min_records": "20", "max_critical_error_rate": "1.5", "file_type": "csv", "interval": "1d",
                   "data_source": "yahoo", "output_partitions": None, "compacted_path": "market/prices/interval=1d/data_source=yahoo/year=2025/month=09/day=03/layer=compacted",
                   "curated_path": "market/prices/interval=1d/data_source=yahoo/year=2025/month=09/day=03/layer=adjusted", "quarantine_path": "market/prices/interval=1d/data_source=yahoo/year=2025/month=09/day=03/layer=quarantine"}
    assert [JobSettings(output_partitions=x).partitions() for x in ("", "0", "8", "x")] == [None, "1", "8", None]


def test_status_texts(spark):
    lit, none = F.lit, F.lit(None).cast("string")
    text = lambda **e: spark.range(1).select(status_text(e)).first()[0]
    assert text(status=lit("FAILED"), error_message=lit("m"), timestamp=lit("t"), execution_arn=lit("arn:1"), duration=lit(12)) == (
        "Pipeline: Unknown Pipeline\nDomain: Unknown\nTable: Unknown\nStatus: FAILED\nEnvironment: Unknown\nTimestamp: t\nExecution ARN: arn:1\nDuration: 12\n\nError Details:\n  Error Type: Unknown\n  Error Message: m")
    assert text(pipeline=lit("p"), domain=lit("d"), table=lit("t"), status=lit("SUCCEEDED"), environment=lit("e"), timestamp=lit("t"), location=lit("l"), duration=lit("")) == (
        "Pipeline: p\nDomain: d\nTable: t\nStatus: SUCCEEDED\nEnvironment: e\nTimestamp: t\n\nSuccess Details:\n  Records Processed: N/A\n  Output Location: l")
    assert text(status=lit("RUNNING"), error_type=lit("x"), timestamp=lit("t")).endswith("Status: RUNNING\nEnvironment: Unknown\nTimestamp: t")
    assert spark.range(1).select(status_subject(none, none, lit("t"), none)).first()[0] == "❓ Pipeline UNKNOWN - Unknown/t (Unknown)"


def test_the_entry_needs_no_session():
    """Queries are listed by a process that has none."""
    import subprocess
    import sys
    from pathlib import Path

    code = "import __spark_entry__ as e; assert len(e.queries()) >= len(e.oracle_sql()) > 80"
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], check=True, timeout=120)
