"""Reproducible shuffle into shards: a Feistel permutation of global row numbers, in native expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.tables import table

SHARDS = 24
KEY = 20240229
ROUNDS = 6
#: Row numbers run through so many hash buckets of the id in turn; one row each is broadcast.
BUCKETS = 1 << 14
#: The permutation has at most so many points beyond the rows, and so a walk at most so many steps.
WALKS = 64


def _round(x: Column, key: int, n: int, size: int) -> Column:
    return F.pmod(F.xxhash64(x, F.lit(key), F.lit(n)), F.lit(size))


def _sides(rows: int) -> tuple[int, int]:
    """(a, b) from the square root up with at most WALKS points of ``a * b`` beyond ``rows``.

    These are the negative of ``rows`` modulo a, so among about a / WALKS sides one will do, and a = rows always.
    """
    a = max(1, math.isqrt(max(0, rows - 1)) + 1)
    while -rows % a > WALKS:
        a += 1
    return a, max(1, -(-rows // a))


def permute(x: Column, rows: int, key: int = KEY, rounds: int = ROUNDS) -> Column:
    """One pass of the Feistel network over ``a * b >= rows`` points, with a and b about the square root.

    A point is (left, right) in mixed radix; each round adds a keyed hash of one half to the other, modulo
    its size, which can be undone, so that the whole is a permutation of the ``a * b`` points.
    """
    a, b = _sides(rows)
    right = F.pmod(x, F.lit(b))
    left = F.call_function("div", x - right, F.lit(b))
    for n in range(rounds):
        if n % 2:
            right = F.pmod(right + _round(left, key, n, b), F.lit(b))
        else:
            left = F.pmod(left + _round(right, key, n, a), F.lit(a))
    return left * F.lit(b) + right


def shuffled_position(x: Column, rows: int, key: int = KEY, rounds: int = ROUNDS) -> Column:
    """Position of row ``x`` of ``rows`` in the shuffle: walk the cycle until it is back below ``rows``.

    A walk meets no point twice before it is back, and all that it meets lie outside, where there are WALKS
    at most; so as many steps always end it.
    """
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), x, lambda p, _: F.when(p < rows, p).otherwise(permute(p, rows, key, rounds)))
    return F.when(x < rows, x).otherwise(walk)


def global_rows(df: DataFrame, out: str) -> tuple[DataFrame, int]:
    """``df`` with a gapless row number from 0 in the order (hash bucket, all columns), and the count.

    The number depends on the rows alone, not on files, partitions or retries. Equal rows are counted before
    the shuffle and written out again behind the numbering, so that however many there are, they are one
    row of it. Counts of BUCKETS buckets give each its first number; the sort is within a bucket.
    """
    keys = df.columns
    groups = df.groupBy(*keys).agg(F.count("*").alias("_n")).withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int"))
    counts = {r[0]: r[1] for r in groups.groupBy("_bucket").agg(F.sum("_n")).collect()}
    first, at = [], 0
    for b in range(BUCKETS):
        first.append(at)
        at += counts.get(b, 0)
    starts = df.sparkSession.createDataFrame(list(enumerate(first)), "_bucket int, _first long")
    so_far = Window.partitionBy("_bucket").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    numbered = groups.withColumn("_end", F.sum("_n").over(so_far)).join(F.broadcast(starts), "_bucket")
    end = F.col("_first") + F.col("_end")
    return numbered.select(*keys, F.explode(F.sequence(end - F.col("_n"), end - 1)).alias(out)), at


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", key: int = KEY) -> DataFrame:
    """``doc_id, size, text_crc32, position, shard, slot`` for each row.

    The shuffled position p gives shard p mod ``shards`` and slot p div ``shards``: counts differ by one at
    most, slots are gapless, and both can be computed from a row number without reading the rest. Null
    text counts as empty; null and repeated ids are rows like any other; an empty table gives none; other
    columns play no part.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    numbered, n = global_rows(rows, "_row")
    placed = numbered.withColumn("_p", permute(F.col("_row"), n, key)).withColumn("position", shuffled_position(F.col("_p"), n, key))
    return placed.select("doc_id", "size", "text_crc32", "position", F.pmod("position", F.lit(shards)).cast("int").alias("shard"),
                         F.expr(f"position div {shards}").alias("slot"))


def op7_sharding(spark, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "position")
