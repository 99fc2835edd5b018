import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidewell.functions.keys import curated_key_error, is_curated_key, layer_path, manifest_key, parse_curated_key, raw_key
from tidewell.operators.batches import chunk, manifest_documents, manifest_entries, merged_objects
from tidewell.operators.load import is_uuid, load_gate, load_messages, outcome, passes
from tidewell.operators.metrics import error_counts, normalized_errors
from tidewell.operators.quality import Gate, day_verdicts, no_data, row_contract, rule_report, rules_for, verdict, with_layer
from tidewell.sources.readers import first_symbols, listed_objects, raw_location, read_day, read_layers
from tidewell.sources.writers import append_ledger, append_version, compact, gate_and_write, register_table, report_by_layer, write_layer, write_manifest_documents, write_messages
from tidewell.streaming.streams import land_intake, landed_intake

PRICE = "symbol string, ds string, open double, high double, low double, close double, adjusted_close double, volume long"


def prices(spark, *rows):
    return spark.createDataFrame([(s, d, 1.0, 1.0, 1.0, c, c, 10) for s, d, c in rows], PRICE)


def test_month_and_day_keep_their_zeros(spark, tmp_path):
    """In a session that infers partition types, too."""
    assert spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == "true"
    root = str(tmp_path / "t")
    write_layer(prices(spark, ("a", "1995-06-01", 1.0), ("b", "1995-11-12", 2.0), ("c", "1995-06-11", 3.0)), root, "adjusted")
    for ds, symbol in (("1995-06-01", "a"), ("1995-11-12", "b"), ("1995-06-11", "c")):
        assert [r.symbol for r in read_day(spark, root, ds, layer="adjusted").collect()] == [symbol]
    assert read_day(spark, root, "1995-06-02").count() == 0
    assert {(r.month, r.day) for r in read_layers(spark, root).collect()} == {("06", "01"), ("11", "12"), ("06", "11")}
    assert "PartitionFilters: [isnotnull(year" in read_day(spark, root, "1995-06-01")._jdf.queryExecution().toString()
    for ds in ("1995-6-1", "1995/06/01", "x"):
        with pytest.raises(ValueError):
            read_day(spark, root, ds)
    assert raw_location("p/", "1995-06-01") == "p/year=1995/month=06/day=01" == raw_location("p/year=1995/month=06/day=01", "1996-01-01")


def test_empty_input_is_an_error_and_writes_nothing(spark, tmp_path):
    root = tmp_path / "t"
    with pytest.raises(ValueError, match="NO_RAW_DATA: No records found for partition"):
        gate_and_write(prices(spark, ("a", "2024-01-01", 1.0)).limit(0), str(root))
    assert gate_and_write(prices(spark, ("a", "2024-01-01", 1.0)).limit(0), str(root), fail=False).first().action == "quarantine"
    assert not root.exists()
    assert compact(prices(spark, ("a", "2024-01-01", 1.0)).limit(0), str(root)) is False and not root.exists()
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert compact(prices(spark, ("a", "2024-01-01", 1.0)), str(root), target_mb=8) is True and root.exists()
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before
    assert no_data(spark).first().messages == ["NO_RAW_DATA: No records found for partition"]


def test_failing_days_are_written_before_the_error(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(ValueError, match=r"DQ_FAILED: null symbol present \(1 records\).*2024-01-01; 2 days failed"):
        gate_and_write(prices(spark, (None, "2024-01-01", 1.0), ("a", "2024-01-02", 1.0), ("b", "2024-01-03", -1.0)), root)
    assert {(r.day, r.layer) for r in read_layers(spark, root).collect()} == {("01", "quarantine"), ("02", "adjusted"), ("03", "quarantine")}


def test_day_verdicts_count_once_per_day(spark):
    df = prices(spark, ("a", "d", -1.0), ("a", "d", 1.0), (None, "d", 1.0), (None, "d", 1.0), ("b", "e", 1.0)).drop("adjusted_close")
    got = {r.ds: (r.record_count, r.null_symbol_count, r.negative_price_count, r.duplicate_key_groups) for r in day_verdicts(df).collect()}
    assert got == {"d": (4, 2, 1, 2), "e": (1, 0, 0, 0)}
    counts = spark.createDataFrame([("d", 100, 0, 0, 3, 0)], "ds string, record_count long, null_symbol_count long, negative_price_count long, duplicate_key_groups long, invalid_numeric_type_issues long")
    assert verdict(counts, Gate(), key_label="symbol").first().messages == ["duplicate symbol detected (3 groups)"]


def test_preset_of_market_prices(spark):
    rules = rules_for("MARKET", "Prices")
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1.0), ("a", dt.date(2024, 1, 1), None), (None, None, 2.0)], "symbol string, date date, close double")
    got = {(r.rule, r.target): r.violations for r in rule_report(df, rules).collect()}
    assert got == {**{("required", c): 0 for c in ("symbol", "date", "close")}, **{("dtype", c): 0 for c in ("symbol", "date", "close")},
                   ("non_null", "symbol"): 1, ("non_null", "date"): 1, ("non_null", "close"): 1, ("duplicates", "symbol,date"): 1}
    assert {(r.rule, r.target): r.violations for r in rule_report(df.drop("date").limit(0), rules).collect()}[("required", "date")] == 1
    times = spark.createDataFrame([("A", t, 1.0) for t in ("2024-01-01T00:00:00Z", "2024-01-01T00:00:00.5+00:00", "2024-01-01", "12", "2024-01-01T00:00:00+02:00", None, "2024-13-01T00:00:00Z")], "symbol string, timestamp string, v double")
    rows = row_contract(times.withColumns({c: F.lit(1.0) for c in ("open", "high", "low", "close", "adjusted_close", "volume")})).collect()
    assert ["timestamp" in r.contract_errors for r in rows] == [False, False, True, True, True, True, True]


def entries(spark, *rows):
    df = spark.createDataFrame(rows, "batch_id string, place string, seq int, ds string, manifest_key string")
    out = manifest_entries(df, F.lit("market"), F.lit("prices"), F.lit("1d"), F.lit("yahoo_finance"))
    return sorted((r.batch_id, r.ds, r.manifest_key, r.source) for r in out.collect())


def test_manifest_entries(spark):
    key = "market/prices/interval=1d/data_source=yahoo_finance/year=2025/month=09/day={}/_batch.manifest.json"
    # A tracker's keys count before its summaries, and chunk summaries only for a batch of which it says nothing.
    assert entries(spark, ("b", "manifest_keys", 1, None, key.format("10")), ("b", "payload", 2, "2025-09-10", "other"), ("b", "chunk_summary", 3, "2025-09-11", None)) == [("b", "2025-09-10", key.format("10"), "dynamodb")]
    assert entries(spark, ("b", "chunk_summary", 1, "2025-09-11", None)) == [("b", "2025-09-11", key.format("11"), "chunk_summary")]
    assert entries(spark, ("b", "combined", 1, "2025-09-12", " "), ("b", "payload", 2, "2025-09-12", "late"), ("b", "finalizing", 3, "2025-09-13", "k")) == [
        ("b", "2025-09-12", key.format("12"), "computed"), ("b", "2025-09-13", "k", "dynamodb")]
    # Unusable entries of a tracker don't keep the summaries away, and another batch's don't either.
    assert entries(spark, ("b", "manifest_keys", 1, None, "no day"), ("b", "payload", 2, "bad", ""), ("b", "payload", 3, " ", "k"), ("b", "chunk_summary", 4, "2025-09-11", "own"), ("c", "payload", 1, "2025-09-11", "k")) == [
        ("b", "2025-09-11", "own", "chunk_summary"), ("c", "2025-09-11", "k", "dynamodb")]


def test_uuids(spark):
    good = ["550e8400-e29b-41d4-a716-446655440000", "550e8400-e29b-11d4-a716-446655440000", "550E8400E29B41D4A716446655440000", "{550e8400-e29b-41d4-a716-446655440000}", "urn:uuid:550e8400-e29b-41d4-a716-446655440000"]
    bad = ["", "x", None, "550e8400-e29b-41d4-a716-44665544000", "550e8400-e29b-41d4-a716-44665544000g"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "i int, t string").withColumn("ok", is_uuid(F.col("t"))).orderBy("i").collect()
    assert [r.ok for r in rows] == [True] * len(good) + [False] * len(bad)


def test_one_match_says_the_same_as_the_reasons(spark):
    base = "m/p/interval=1d/data_source=s/year=2024/month=01/day=01/layer=x/f.parquet"
    keys = [base, base.replace("/data_source=s", ""), base + "\n", base.replace("layer=x", "layer=x\n"), base.replace("/f.parquet", ".parquet"), base.replace("f.parquet", "a/b.parquet"), base.replace("f.parquet", ".parquet"),
            base.replace("day=01", "day=32"), base.replace("data_source=s", "data_source="), base.replace("m/", "/"), base.replace("/f.", "//f."), base.replace("interval=1d/", ""), base.replace("f.parquet", "ä\nb.parquet"), "", None]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, key string").select("*", curated_key_error(F.col("key")).alias("e"), is_curated_key(F.col("key")).alias("ok"), parse_curated_key(F.col("key"))["data_source"].alias("s"))
    rows = df.orderBy("i").collect()
    assert all((r.e is None) == r.ok for r in rows) and [r.i for r in rows if r.ok] == [0, 1, 5, 6, 10, 12]
    assert [r.s for r in rows if r.ok] == ["s", None, "s", "s", "s", "s"]
    events = df.select("key").crossJoin(spark.createDataFrame([(5000, "aws.s3", "Object Created", "bucket"), (None, "aws.s3", "Object Created", "bucket"), (5000, None, "Object Created", "bucket"), (5000, "aws.s3", "x", "bucket"), (5000, "aws.s3", "Object Created", "B"), (5000, "aws.s3", "Object Created", None)], "size long, source string, detail_type string, bucket string"))
    for layers, domains in (((), ("m",)), (("x",), ("m",)), (("y",), ("m",)), ((), ("n",))):
        both = load_gate(events, layers, domains).select((F.col("skip_reason").isNull() == F.coalesce(passes(layers, domains), F.lit(False))).alias("same"))
        assert both.where("not same").count() == 0


def test_messages_go_out_by_domain(spark, tmp_path):
    key = "market/prices/interval=1d/year=2024/month=01/day=01/layer=adjusted/f.parquet"
    events = spark.createDataFrame([(5000, "aws.s3", "Object Created", "bucket", key), (1, "aws.s3", "Object Created", "bucket", key)], "size long, source string, detail_type string, bucket string, key string")
    write_messages(load_messages(events, correlation=F.lit("id")), str(tmp_path / "m"))
    r = spark.read.json(str(tmp_path / "m")).collect()
    assert len(r) == 1 and r[0].domain == "market" and r[0].message_key == key
    body = json.loads(r[0].body)
    assert body["ds"] == "2024-01-01" and body["file_size"] == 5000 and body["correlation_id"] == "id" and "data_source" not in body
    assert r[0].headers.asDict() == {"ContentType": "application/json", "Domain": "market", "TableName": "prices", "Priority": "1"}


def test_keys_are_built(spark):
    place = [F.lit(x) for x in ("market", "prices", "1d", "", "2025-09-07")]
    row = spark.range(1).select(raw_key(*place, F.lit("AAPL"), gzip=True), manifest_key(*place, "", " "), manifest_key(*place[:4], F.lit("20250907")), layer_path(*place, F.lit("adjusted"))).first()
    day = "market/prices/interval=1d/year=2025/month=09/day=07"
    assert tuple(row) == (f"{day}/AAPL.json.gz", f"{day}/_batch.manifest.json", None, f"{day}/layer=adjusted")


def test_manifests_summaries_and_listings(spark, tmp_path):
    objects = spark.createDataFrame([("2024-01-02", "b", "k1", 1), ("2024-01-02", "a", "k2", 2), ("bad", "a", "k3", 2)], "ds string, symbol string, key string, records long")
    write_manifest_documents(manifest_documents(objects, "batch", "market", "prices", "1d", "yahoo"), str(tmp_path / "m"))
    text = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "m")).collect()]
    assert len(text) == 1 and [o["symbol"] for o in text[0]["objects"]] == ["a", "b"] and {"environment", "domain", "table_name", "data_source", "interval", "ds", "generated_at", "batch_id"} <= set(text[0])
    files = listed_objects(spark, str(tmp_path / "m")).collect()
    assert len(files) == 1 and files[0].key.endswith(".json") and files[0]["size"] > 0
    s = spark.createDataFrame([("d", 2, "late", ["x", "y"]), ("d", 1, "first", ["x"]), ("", 3, "p", ["z"]), ("e", 4, "p", [])], "ds string, seq int, raw_prefix string, objects array<string>")
    assert sorted((r.ds, r.raw_prefix, tuple(r.place), r.object) for r in merged_objects(s).collect()) == [("d", "first", (1, 0), "x"), ("d", "first", (2, 0), "x"), ("d", "first", (2, 1), "y")]
    some = spark.createDataFrame([(None, "[]", "b\na"), (" ", None, None)], "a string, b string, c string").select(first_symbols(F.col("a"), F.col("b"), F.col("c")).alias("s"))
    assert [r.s for r in some.collect()] == [["b", "a"], ["AAPL"]]


def test_sparse_ranks(spark):
    df = spark.createDataFrame([(-(1 << 40), "a"), (5, "b"), (6, "c"), (1 << 50, "d")], "n long, s string")
    assert [r.members for r in chunk(df, "n", "s", 3).orderBy("chunk_no").collect()] == [["a", "b", "c"], ["d"]]
    assert chunk(df.limit(0), "n", "s", 3).count() == 0


def test_ledger_versions_and_catalog(spark, tmp_path):
    root, log = str(tmp_path / "market" / "prices" / "interval=1d"), str(tmp_path / "ledger")
    write_layer(prices(spark, ("a", "2024-01-02", 1.0), ("b", "2024-01-02", 2.0)), root, "adjusted")
    write_layer(prices(spark, ("q", "2024-01-03", 1.0)), root, "quarantine")
    for _ in range(2):
        append_ledger(root, log, spark, "id")
    rows = spark.read.parquet(log).collect()
    assert sum(r.record_count for r in rows) == 6 and {(r.domain, r.table_name, r.correlation_id) for r in rows} == {("market", "prices", "id")}
    assert {str(r.partition_date) for r in rows} == {"2024-01-02", "2024-01-03"}
    a, b = spark.range(1).selectExpr("id", "'x' s").schema, spark.range(1).selectExpr("id").schema
    assert [append_version(x, "t", str(tmp_path / "v"), spark) for x in (a, a, b, a)] == [1, 1, 2, 3]
    register_table(spark, "shop_prices", root)
    try:
        assert spark.table("shop_prices").count() == 3 and {r.symbol for r in spark.table("shop_prices_good").collect()} == {"a", "b"}
        write_layer(prices(spark, ("c", "2024-01-04", 1.0)).withColumn("note", F.lit("n")), root, "adjusted")
        register_table(spark, "shop_prices", root)
        assert {(r.symbol, r.note) for r in spark.table("shop_prices_good").collect()} == {("a", None), ("b", None), ("c", "n")}
    finally:
        spark.sql("DROP VIEW IF EXISTS shop_prices_good")
        spark.sql("DROP TABLE IF EXISTS shop_prices")


def test_error_defaults_and_outcomes(spark):
    df = spark.createDataFrame([("s", "m", None, None, None, None, "dev"), ("s", "", "x", "y", "d", {"a": "b"}, "dev")], "source string, error_message string, severity string, error_type string, domain string, context map<string,string>, environment string")
    row = normalized_errors(df).first()
    assert (row.severity, row.error_type, row.context) == ("ERROR", "UnknownError", {})
    assert {(r.metric, r.environment, r.n) for r in error_counts(df).collect()} == {("ErrorCount", "dev", 1), ("ERRORCount", "dev", 1)}
    codes = ["", None, "PARSE_ERROR", "validation_error", "TIMEOUT_ERROR", "?"]
    assert [r.o for r in spark.createDataFrame([(c,) for c in codes], "c string").select(outcome(F.col("c")).alias("o")).collect()] == ["SUCCESS", "SUCCESS", "PARSE_ERROR", "EXCEPTION", "EXCEPTION", "EXCEPTION"]


def feed(spark, path, schema, *batches):
    """A stream that takes one of ``batches`` at a time, in order."""
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        stamp = 1_700_000_000 + n
        for f in __import__("pathlib").Path(path).glob("*.parquet"):
            if f.stat().st_mtime > 1_750_000_000:
                __import__("os").utime(f, (stamp, stamp))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour, tzinfo=dt.timezone.utc)


def test_intake_in_one_pass(spark, tmp_path):
    rows = feed(spark, f"{tmp_path}/in", "id long, body string", [(1, '{"kind": "a", "user": 1}'), (2, "{broken"), (3, '{"user": 2}')], [(4, None), (5, '{"kind": "b"}')])
    query = land_intake(rows, "kind string, user long", f"{tmp_path}/rows", f"{tmp_path}/cp")
    good, bad = landed_intake(spark, f"{tmp_path}/rows", "kind string, user long")
    assert sorted(map(tuple, good.collect())) == [(1, "a", 1), (5, "b", None)] and sorted(r.id for r in bad.collect()) == [2, 3, 4]
    seen = [p["observedMetrics"]["intake"] for p in query.recentProgress if "intake" in p["observedMetrics"]]
    assert [(m["accepted"], m["rejected"]) for m in seen] == [(1, 2), (1, 1)]
    assert query._jsq.explainInternal(True).count("FileScan") <= 1


def test_report_of_layers_in_one_pass(spark):
    df = spark.createDataFrame([("2024-01-01", "a"), ("2024-01-01", None), ("2024-01-02", "b"), (None, "c")], "ds string, symbol string")
    report = report_by_layer(with_layer(df, day_verdicts(df)), ("adjusted", "quarantine", "compacted"))
    assert sorted(map(tuple, report.collect())) == [("adjusted", 2, 1, "2024-01-02", "2024-01-02"), ("compacted", 0, 0, None, None), ("quarantine", 2, 1, "2024-01-01", "2024-01-01")]
