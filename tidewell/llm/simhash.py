"""SimHash near-duplicates by multi-index hashing over fingerprint segments."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.components import components
from tidewell.llm.tables import forget, row_hash, settle, table, unused

BITS = 64
SHINGLE_WORDS = 4
MAX_DISTANCE = 4
#: Ways to cut a fingerprint: blocks, and how many of them make a segment together; see ``choose_plan``.
CUTS = ((3, 1), (2, 1), (3, 2))
#: Buckets hold about one fingerprint by choice of the cut. One with more than this is a crowd of near copies; see ``_ball_links``.
BUCKET_ROWS = 256
SEED = 42


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """SimHash of the word shingles of a text, as a signed 64-bit integer; no words give zero."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()  # on bytes: A-Z only, and only the six ASCII spaces
    if not w:
        return 0
    joined = b" ".join(w)
    n = len(w) - words + 1
    if n <= 1:
        return int(np.uint64(xxhash.xxh64_intdigest(joined, SEED)).astype(np.int64))
    size = np.fromiter(map(len, w), np.int64, len(w))
    end = np.cumsum(size + 1) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip((end - size)[:n].tolist(), end[words - 1 :].tolist())], dtype="<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, also: str | None = None) -> DataFrame:
    """``(doc_id, fp)`` for each row, and ``also`` with a long column's values; null and empty texts have fingerprint zero."""
    extra = [F.col(also).alias("also")] if also else []
    names = ["doc_id", "fp"] + ["also"] * bool(also)

    def run(batches):
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array((fingerprint(t.as_py(), words) for t in b.column(1)), pa.int64()), *b.columns[2:]], names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *extra).mapInArrow(run, ", ".join(f"{n} long" for n in names))


Plan = list[tuple[list[tuple[int, int]], int]]


def segment_plan(distance: int, blocks: int, together: int = 1) -> Plan:
    """The (shift, width) parts and the radius of each segment: ``together`` of ``blocks`` blocks of a fingerprint.

    Single blocks have radii that add up to ``distance - blocks + 1``: were a pair farther apart than that
    in every one, it would differ in more than ``distance`` bits in all. Of several blocks at once, those
    with the fewest differing bits have most of them when the bits are spread evenly.
    """
    spare = distance - blocks + 1
    if spare < 0:
        raise ValueError("at most distance + 1 blocks")
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    parts = [(lo, hi - lo) for lo, hi in zip(edges, edges[1:])]
    if together == 1:
        return [([p], spare // blocks + (i < spare % blocks)) for i, p in enumerate(parts)]
    each, rest = divmod(distance, blocks)
    return [(list(c), together * each + max(0, together - (blocks - rest))) for c in combinations(parts, together)]


def choose_plan(rows: int, distance: int = MAX_DISTANCE) -> Plan:
    """The first cut whose segments have a value for each of ``rows`` fingerprints and its table ball: up to
    2**21 with three blocks, 2**26 with two, 2**36 with two of three together; any cut finds each pair."""
    plans = [segment_plan(distance, b, t) for b, t in CUTS if b <= distance + 1] or [segment_plan(distance, distance + 1)]
    width = lambda parts: sum(w for _, w in parts)
    roomy = (p for p in plans if all(rows * len(_masks(width(parts), r // 2)) <= 1 << width(parts) for parts, r in p))
    return next(roomy, plans[-1])


def _masks(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)]


def _segment(fp: Column, parts: list[tuple[int, int]]) -> Column:
    out, at = F.lit(0).cast("long"), 0
    for shift, width in parts:
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1)), at))
        at += width
    return out


def _keys(plan: Plan, probe: bool) -> Column:
    """Keys of the Hamming balls around the segments of a fingerprint.

    A radius is shared out: a pair within it meets in the table's ball of half of it, rounded down, and the
    probe's of the other half; most radii are 1 or 0, and the table then holds the segments alone.
    """

    def ball(i: int, parts: list[tuple[int, int]], radius: int) -> Column:
        value = _segment(F.col("fp"), parts).bitwiseOR(F.lit(i << 56))
        return F.array(*[value.bitwiseXOR(F.lit(m).cast("long")) for m in _masks(sum(w for _, w in parts), radius - radius // 2 if probe else radius // 2)])

    return F.explode(F.concat(*[ball(i, *p) for i, p in enumerate(plan)])).alias("key")


def _near(distance: int, x: str, y: str) -> Column:
    return F.bit_count(F.col(x).bitwiseXOR(F.col(y))) <= distance


def _ball_links(prints: DataFrame, distance: int) -> DataFrame:
    """Links among the fingerprints of crowded buckets, without comparing all pairs: the whole fingerprint is the segment.

    Two fingerprints within ``distance`` bits share a point within half of it from both. So each one is
    written under all points of its half-distance ball, never more than 2,081 for 4 bits, and those under
    one point link to the smallest of them, their complete distance verified. Rows grow with the
    fingerprints, not their pairs. An odd distance, whose balls are larger by one, compares all under a point.
    """
    half = (distance + 1) // 2
    masks = F.array(*[F.lit(m if m < 1 << 63 else m - (1 << 64)).cast("long") for m in _masks(BITS, half)])
    points = prints.repartition("fp").select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("point"))
    if 2 * half == distance:
        other = points.groupBy("point").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    else:
        other = points.select(F.col("fp").alias("b"), "point")
    return points.join(other, "point").where((F.col("fp") > F.col("b")) & _near(distance, "fp", "b")).select(F.col("fp").alias("a"), "b").distinct()


def fingerprint_links(prints: DataFrame, distance: int = MAX_DISTANCE, plan: Plan | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links ``(a, b)`` whose components are those of all pairs of distinct ``prints(fp)`` within ``distance`` bits.

    Multi-index hashing: each fingerprint stands in a table under its segments; each one also enumerates
    the small Hamming balls around its segments, fetches the rows under those values and verifies the
    complete distance inside the join. The cut into segments follows the number of rows, so that buckets
    stay small at any size. Buckets of over ``bucket_rows`` rows, which hold near copies then, leave the
    table, and all fingerprints that would probe them are linked by ``_ball_links`` instead, which is exact.
    """
    plan = plan or choose_plan(prints.count(), distance)
    rows = prints.select("fp", _keys(plan, False))
    full = settle(rows.groupBy("key").count().where(F.col("count") > bucket_rows).select("key"))
    n_full = full.count()
    probes = prints.select("fp", _keys(plan, True))
    if n_full:
        rows = rows.join(full, "key", "left_anti")
    links = probes.alias("p").join(rows.alias("t"), (F.col("p.key") == F.col("t.key")) & (F.col("p.fp") < F.col("t.fp")) & _near(distance, "p.fp", "t.fp"))
    links = links.select(F.col("p.fp").alias("a"), F.col("t.fp").alias("b"))
    if n_full:
        # A probe's ball is no smaller than the table's, so both ends of a pair of a full bucket probe it.
        crowded = probes.join(full, "key", "left_semi").select("fp").distinct()
        links = links.unionByName(_ball_links(settle(crowded), distance))
    return links


def _groups(prints: DataFrame, distance: int, plan: Plan | None, bucket_rows: int) -> DataFrame:
    """``(fp, first)`` of ``prints(fp, first)``: the least ``first`` of all fingerprints that are linked."""
    groups = components(fingerprint_links(prints.select("fp"), distance, plan, bucket_rows)).withColumnRenamed("node", "fp")
    named = prints.join(groups, "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("c"))
    return named.select("fp", "c").join(named.groupBy("c").agg(F.min("first").alias("first")), "c").select("fp", "first")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                    distance: int = MAX_DISTANCE, plan: Plan | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fp, component_id``.

    Equal fingerprints are collapsed first, whatever their number, by a pre-aggregated minimum; only
    distinct ones are compared. Groups are of texts: rows of a repeated id each get the smallest id of
    their own text's group. Null and empty texts have fingerprint zero. A null id takes part in no group
    and gets a null component. An empty table gives an empty table; other columns play no part.
    """
    own = settle(fingerprints(docs, id_col, text_col, words))
    prints = settle(own.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("first")))
    named = _groups(prints, distance, plan, bucket_rows).select(F.col("fp").alias("fp_"), "first")
    return own.join(named, (F.col("fp") == F.col("fp_")) & F.col("doc_id").isNotNull(), "left").select("doc_id", "fp", F.col("first").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """``docs`` with one row of each group of linked texts, that of the smallest id; null ids all stay.

    Where an id repeats with different texts, each text belongs to its own group. Among rows of a group's
    smallest id the one with the least row hash stays; of equal rows one stays.
    """
    rows, (i, row) = with_row_key(docs, id_col)
    fp = fingerprints(rows, i, text_col, words, also=row)
    prints = settle(fp.groupBy("fp").agg(F.min(F.struct(F.col("doc_id"), F.col("also").alias("row"))).alias("first")))
    kept = settle(_groups(prints, distance, None, BUCKET_ROWS).select("first.doc_id", "first.row"))
    forget(prints)
    return rows_of(docs, rows, [i, row], kept, id_col)


def with_row_key(docs: DataFrame, id_col: str) -> tuple[DataFrame, list[str]]:
    """The rows with an id, with two columns by which to find each again: the id as a long, and a hash of the whole row."""
    names = unused(docs, "id", "row")
    return docs.where(F.col(id_col).isNotNull()).withColumns({names[0]: F.col(id_col).cast("long"), names[1]: row_hash(docs)}), names


def rows_of(docs: DataFrame, rows: DataFrame, names: list[str], kept: DataFrame, id_col: str) -> DataFrame:
    """One row for each of ``kept(doc_id, row)``, and all rows of ``docs`` without an id."""
    keys = kept.select(F.col("doc_id").alias(f"{names[0]}k"), F.col("row").alias(f"{names[1]}k"))
    found = rows.join(keys, (F.col(names[0]) == F.col(f"{names[0]}k")) & (F.col(names[1]) == F.col(f"{names[1]}k")), "left_semi")
    return found.dropDuplicates(names).drop(*names).unionByName(docs.where(F.col(id_col).isNull()))


def op2_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
