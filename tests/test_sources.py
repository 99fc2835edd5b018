"""Raw files, listings, catalog tables, documents, and appends that happen once."""

import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.test_library import feed
from tidewell.operators.batches import only_done
from tidewell.plans.backfill import idempotent
from tidewell.sources.catalog import combined, partition_changes, sync_table, wider
from tidewell.sources.listing import anything, days_there, keys_there, listed, listed_partitions
from tidewell.sources.raw_files import COLUMNS, RawFiles, write_raw_files
from tidewell.sources.readers import manifest_objects, read_documents
from tidewell.sources.writers import append_once, ledger_stream, register_table

RAW = "symbol string, timestamp string, open double, high double, low double, close double, adjusted_close double, volume double"
ROWS = [("A", "2025-09-07T23:59:00+00:00", 1.0, 2.0, 0.5, 1.5, None, 1234567.0), ("A", "2025-09-07T01:00:00+00:00", 1.25, 2.0, 0.5, 1.5, 1.5, 10.0), ("A", "2025-09-08T01:30:00+02:00", 9.0, None, None, None, None, None),
        ("B.X", "2025-09-08T00:00:00Z", 0.1, 0.1, 0.1, 0.1, 0.1, 0.0), (None, "2025-09-08T00:00:00Z", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0), ("C", None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)]
DAY = "market/prices/interval=1d/data_source=yahoo/year=2025/month=09/day="


def tree(path):
    return sorted(str(f.relative_to(path)) for f in Path(path).rglob("*") if f.is_file())


def land(spark, root, rows, **how):
    new = write_raw_files(spark.createDataFrame([(*r, 0) for r in rows], RAW + ", key int").drop("key"), str(root), "market", "prices", "1d", "yahoo", **how)
    return sorted((r.ds, r.symbol, r.key, r.records) for r in new.collect())


def test_raw_files_are_written_once_under_their_keys(spark, tmp_path):
    new = land(spark, tmp_path, ROWS)
    want = [("2025-09-07", "A", f"{DAY}07/A.json", 3), ("2025-09-08", "B.X", f"{DAY}08/B.X.json", 1)]
    assert new == want and tree(tmp_path) == [w[2] for w in want]
    lines = [json.loads(x) for x in (tmp_path / want[0][2]).read_text().splitlines()]
    assert [x["open"] for x in lines] == [1.25, 1.0, 9.0] and list(lines[0]) == list(COLUMNS) and lines[2]["high"] is None
    before = (tmp_path / want[0][2]).read_bytes()
    again = [("A", "2025-09-07T05:00:00Z", *[7.0] * 6), ("A", "2025-09-09T05:00:00Z", *[7.0] * 6)]
    assert land(spark, tmp_path, again) == [("2025-09-09", "A", f"{DAY}09/A.json", 1)]
    assert (tmp_path / want[0][2]).read_bytes() == before and len(tree(tmp_path)) == 3
    assert land(spark, tmp_path, again) == [] and land(spark, tmp_path, []) == []


def test_raw_files_as_csv_and_compressed(spark, tmp_path):
    assert [k for _, _, k, _ in land(spark, f"file://{tmp_path}", ROWS, file_type="CSV", gzip=True)] == [f"{DAY}07/A.csv.gz", f"{DAY}08/B.X.csv.gz"]
    text = gzip.decompress((tmp_path / f"{DAY}07/A.csv.gz").read_bytes()).decode()
    assert text.splitlines() == [",".join(COLUMNS), "A,2025-09-07T01:00:00+00:00,1.25,2,0.5,1.5,1.5,10", "A,2025-09-07T23:59:00+00:00,1,2,0.5,1.5,,1.23457e+06", "A,2025-09-08T01:30:00+02:00,9,,,,,"]
    assert land(spark, tmp_path, ROWS, file_type="csv", gzip=True) == []
    assert {(r.symbol, r.ds) for r in keys_there(spark, str(tmp_path)).collect()} == {("A", "2025-09-07"), ("B.X", "2025-09-08")}


def test_a_failed_run_leaves_no_raw_file(spark, tmp_path):
    spark.dataSource.register(RawFiles)
    rows = spark.range(100).select(F.concat(F.lit("k/"), F.col("id").cast("string")).alias("key"), *[F.lit("s").alias(c) for c in COLUMNS[:2]], *[F.lit(1.0).alias(c) for c in COLUMNS[2:7]],
                                   F.when(F.col("id") == 77, F.raise_error(F.lit("broken row"))).otherwise(1.0).cast("double").alias("volume"))
    with pytest.raises(Exception, match="broken row"):
        rows.repartition(4).write.format("tidewell_raw").option("path", str(tmp_path)).option("kind", "json").mode("append").save()
    assert tree(tmp_path) == []


def test_listings_read_no_data(spark, tmp_path):
    root = f"{tmp_path}/t"
    assert listed(spark, root).count() == days_there(spark, root).count() == 0 and not anything(spark, root)
    df = spark.createDataFrame([("2025", "09", f"{d:02d}", layer, d) for d in (1, 2, 3) for layer in ("adjusted", "compacted") if (d, layer) != (2, "adjusted")], "year string, month string, day string, layer string, v int")
    df.write.partitionBy("year", "month", "day", "layer").parquet(root)
    for f in Path(root).rglob("*.parquet"):
        f.write_bytes(b"no Parquet")  # so any look into a file would fail
    assert {(r.ds, r.layer, r.files, r.bytes) for r in listed_partitions(spark, root).collect()} == {(f"2025-09-0{d}", x, 1, 10) for d in (1, 2, 3) for x in ("adjusted", "compacted") if (d, x) != (2, "adjusted")}
    asked = spark.createDataFrame([(f"2025-09-0{d}",) for d in (1, 2, 3, 4)], "ds string")
    plan = idempotent(asked, days_there(spark, root), ["ds"])
    assert {(r.ds, r.code) for r in plan.collect()} == {("2025-09-01", "IDEMPOTENT_SKIP"), ("2025-09-02", None), ("2025-09-03", "IDEMPOTENT_SKIP"), ("2025-09-04", None)}
    assert sorted(r.ds for r in only_done(asked, days_there(spark, root, "compacted")).collect()) == ["2025-09-01", "2025-09-02", "2025-09-03"]
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" in shown and "content" not in shown and "parquet" not in shown.replace("*.parquet", "").replace(root, "")


def put(spark, root, day, layer, schema, *rows):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{root}/year=2025/month=09/day={day}/layer={layer}")


def test_catalog_follows_its_folders(spark, tmp_path):
    root, name = f"{tmp_path}/t", "synced_prices"
    try:
        assert sync_table(spark, name, root).count() == 0 and not spark.catalog.tableExists(name)
        put(spark, root, "01", "adjusted", "symbol string, volume int", ("a", 1))
        put(spark, root, "01", "quarantine", "symbol string, volume int", ("q", 9))
        assert [(r.day, r.layer, r.change) for r in sync_table(spark, name, root).collect()] == [("01", "adjusted", "added")]
        assert sync_table(spark, name, root).count() == 0
        put(spark, root, "02", "adjusted", "symbol string, volume long, note string", ("b", 1 << 40, "n"))
        put(spark, root, "03", "adjusted", "symbol string, volume int", ("c", 3))
        assert sorted(r.day for r in sync_table(spark, name, root).collect()) == ["02", "03"]
        assert dict(spark.table(name).dtypes)["volume"] == "bigint"
        assert {(r.symbol, r.volume, r.note, r.day) for r in spark.table(name).collect()} == {("a", 1, None, "01"), ("b", 1 << 40, "n", "02"), ("c", 3, None, "03")}
        for f in Path(f"{root}/year=2025/month=09/day=01/layer=adjusted").iterdir():
            f.unlink()
        changed = [(r.day, r.change) for r in partition_changes(spark, name, root).collect()]
        assert changed == [("01", "deleted")] and spark.sql(f"SHOW PARTITIONS {name}").count() == 3
        sync_table(spark, name, root, drop_deleted=True)
        assert spark.sql(f"SHOW PARTITIONS {name}").count() == 2
        put(spark, root, "04", "adjusted", "symbol int, volume int", (1, 3))
        with pytest.raises(ValueError, match="symbol: string and int have no common type"):
            sync_table(spark, name, root)
        assert spark.sql(f"SHOW PARTITIONS {name}").count() == 2
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_types_that_combine():
    of = T._parse_datatype_string
    for a, b, want in (("int", "bigint", "bigint"), ("double", "float", "double"), ("int", "double", "double"), ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("array<int>", "array<bigint>", "array<bigint>"), ("date", "date", "date")):
        assert wider(of(a), of(b)).simpleString() == want
    assert combined(of("a int, b struct<x:int>"), of("A bigint, b struct<x:bigint,y:string>, c date")).simpleString() == "struct<a:bigint,b:struct<x:bigint,y:string>,c:date>"
    for a, b in (("string", "int"), ("bigint", "double"), ("decimal(38,0)", "decimal(38,10)")):
        with pytest.raises(ValueError):
            wider(of(a), of(b))


def test_documents_in_any_layout(spark, tmp_path):
    one = {"ds": "2025-09-07", "batch_id": "b", "objects": [{"symbol": "A", "key": "k/A.json", "records": 2}, {"symbol": "B", "key": "k/B.json", "records": 1}]}
    two = {"ds": "2025-09-08", "raw_prefix": "p/", "objects": [{"symbol": "C", "key": "k/C.json", "records": 5}]}
    texts = {"indented.json": json.dumps(one, indent=2), "lines.json": json.dumps(one) + "\r\n\n" + json.dumps(two) + "\n", "list.json": json.dumps([two, one, 3]), "flat.json": json.dumps([two]), "broken.json": '{"ds": "2025', "empty.json": " \n", "nothing.json": "", "none.json": "[]", "number.json": "12",
             "a/b/deep.json": json.dumps([{"objects": []}, {"ds": ""}], indent=1)}
    for name, text in texts.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    rows = [(r.file.rsplit("/", 1)[1], r.place, r.document.ds if r.document else None, r.error) for r in read_documents(spark, str(tmp_path)).collect()]
    assert sorted(rows, key=str) == sorted([("indented.json", 0, "2025-09-07", None), ("lines.json", 0, "2025-09-07", None), ("lines.json", 1, "2025-09-08", None), ("list.json", 0, "2025-09-08", None), ("list.json", 1, "2025-09-07", None),
                                            ("list.json", 2, None, "not an object"), ("flat.json", 0, "2025-09-08", None), ("broken.json", 0, None, "not a JSON document"), ("empty.json", 0, None, "not a JSON document"), ("number.json", 0, None, "not a JSON document"),
                                            ("deep.json", 0, None, None), ("deep.json", 1, "", None)], key=str)
    objects = manifest_objects(spark, str(tmp_path))
    assert objects.columns == ["ds", "symbol", "key", "records"] and objects.count() == 3 * 2 + 3 * 1


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    path, schema = f"{tmp_path}/ledger", "file_path string, record_count long"
    df = spark.createDataFrame([("f1", 1), ("f2", 2)], schema)
    append_once(df, path, "q", 0)
    append_once(df.limit(1), path, "other", 0)
    append_once(df, path, "q", 1)
    append_once(df, path, "q", 1)
    assert spark.read.parquet(path).groupBy("query").count().orderBy("query").collect() == [("other", 1), ("q", 4)]


def test_a_killed_ledger_batch_is_written_once(spark, tmp_path):
    """The first run writes its rows and dies before the batch is committed; the second run's replay doesn't add to them."""
    path, schema = f"{tmp_path}/ledger", "file_path string, record_count long"
    files = feed(spark, f"{tmp_path}/in", schema, [("f1", 1), ("f2", 2)], [("f3", 3)])

    def die(batch, n):
        append_once(batch.withColumn("processed_at", F.current_timestamp()), path, "loads", n)
        raise RuntimeError("killed")

    with pytest.raises(Exception, match="killed"):
        files.writeStream.foreachBatch(die).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(path).count() == 2
    for _ in range(2):
        ledger_stream(files, path, "loads", f"{tmp_path}/cp")
    assert sorted(r.file_path for r in spark.read.parquet(path).collect()) == ["f1", "f2", "f3"]


def test_layers_that_do_not_combine_are_tables_of_their_own(spark, tmp_path):
    root, name = f"{tmp_path}/t", "split_prices"
    try:
        put(spark, root, "01", "adjusted", "symbol string, volume double", ("a", 1.5))
        put(spark, root, "01", "compacted", "symbol string, volume long, n int", ("b", 1 << 53, 4))
        put(spark, root, "01", "quarantine", "symbol string, volume double", ("q", 9.0))
        register_table(spark, name, root)
        register_table(spark, name, root)
        assert {(r.symbol, r.volume, r.n, r.layer) for r in spark.table(f"{name}_good").collect()} == {("a", 1.5, None, "adjusted"), ("b", float(1 << 53), 4, "compacted")}
    finally:
        for x in (f"VIEW IF EXISTS {name}_good", f"TABLE IF EXISTS {name}_adjusted", f"TABLE IF EXISTS {name}_compacted"):
            spark.sql(f"DROP {x}")
