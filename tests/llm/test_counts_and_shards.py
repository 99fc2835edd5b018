import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewell.llm.sharding import op7_sharding, permute, shard, shuffled_position
from tidewell.llm.tokens import byte_encoding, length_histogram, op6_token_counts, token_counts, tokenizer_path


def brute(lengths):
    n, rows = len(lengths), {}
    for x in set(lengths):
        above = [y for y in lengths if y >= x]
        rows[x] = (lengths.count(x), len(above), sum(above), n, sum(lengths), sum(y <= x for y in lengths) / n, sum(min(x, y) for y in lengths))
    return rows


def listed(df):
    return {r.n_tokens: (r.n_docs, r.docs_from, r.tokens_from, r.total_docs, r.total_tokens, r.quantile, r.truncated_tokens) for r in df.collect()}


def test_histogram(spark, sf_dir):
    enc = byte_encoding(tokenizer_path("byte_bpe_50k.tiktoken"))
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert listed(op6_token_counts(spark, sf_dir)) == brute([len(enc.encode_ordinary(t or "")) for t in texts])


def test_histogram_edge_rows(spark):
    df = spark.createDataFrame([(5,), (5,), (0,), (None,), (700,), (256,), (255,)], "n_tokens int")
    assert listed(length_histogram(df)) == brute([5, 5, 0, 700, 256, 255])
    assert length_histogram(df.limit(0)).count() == 0
    docs = spark.createDataFrame([(None,), ("",), ("<|endoftext|>",), ("a" * 50_000,)], "text string")
    assert [r.n_tokens == 0 for r in token_counts(docs).collect()] == [True, True, False, False]


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 91, 1000, 4097])
def test_permutation(spark, rows):
    x = F.col("id")
    df = spark.range(rows).withColumn("p", permute(x, rows)).select("id", shuffled_position(F.col("p"), rows).alias("p"))
    got = [r.p for r in df.orderBy("id").collect()]
    assert sorted(got) == list(range(rows)) and (rows < 50 or got != sorted(got))


def test_shards(spark, sf_dir):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op7_sharding(spark, sf_dir).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {i: (len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in text.items()}
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = {(r.doc_id, r.shard, r.slot) for r in shard(spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(5)).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in rows}


def test_shard_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (1, "", 2), (None, "é", 3), (2, "x" * 100_000, 4), (2, "a", 5), (2, "a", 5)], "doc_id long, text string, slot int")
    out = shard(docs, shards=4).collect()
    assert Counter(r["size"] for r in out) == {8: 2, 10: 1, 100_008: 1, 9: 2} and sorted(r.position for r in out) == list(range(6))
    assert shard(docs.limit(0)).count() == 0
