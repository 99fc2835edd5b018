"""Near-duplicates by word-shingle similarity: multi-index hashing over SimHash segments, verified by the exact Jaccard similarity.

At a similarity of 0.8 two SimHashes differ in about 15 of 100 bits, so a fingerprint here has as many
segments as the wanted recall takes, each as wide as the number of texts takes. Texts of crowded segments meet
by their rarest shingles instead, which misses none of their pairs.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.components import components
from tidewell.llm.simhash import SEED, rows_of, with_row_key
from tidewell.llm.tables import forget, settle

WORDS = 5
#: Least similarity, as a fraction of whole numbers: the comparison has no rounding.
SIMILARITY = (4, 5)
#: Part of differing bits at the least similarity: arc cosine of 2 * 0.8 / (1 + 0.8), divided by pi.
DIFFER = 0.1515
#: A pair at the least similarity meets in no segment with at most this probability.
MISS = 0.005
#: Bits of a segment that are flipped in turn, those of the narrowest majority; they find about 0.8 of what all would.
FLIPS = 5
FLIPS_HOLD = 0.8
#: A fingerprint has so many 64-bit words at least, and as many as its segments take; pairs are compared by the first few inside
#: the join of all texts, and by all of them after it and in crowded buckets.
WORDS_OF_BITS = 13
CHECKS = tuple(f"check{k}" for k in range(3))
#: Candidates differ in at most ``DIFFER`` of the compared bits and so many standard deviations more; those of texts with
#: fewer shingles than ``SMALL``, whose bits differ more often, in at most ``MOST_SMALL``.
DEVIATIONS = 3.1
SMALL = 8
MOST_SMALL = 0.3
#: A bucket is crowded from CROWD rows. It is looked for among one in SAMPLE texts, and the rows of those with SAMPLED there are counted:
#: at the density of segments many small ones have as many by chance. All pairs of others are compared; texts of crowded ones meet by shingles.
SAMPLE = 8
SAMPLED = 3
CROWD = SAMPLE * SAMPLED
#: Cells in which the shingles of crowds are counted, to tell rare ones.
CELLS = 1 << 20
#: Under a crowd's shingle a row has so many of its text's rarer ones: two texts that share one of these have met there.
BEFORE = 8
#: All pairs under a crowd's shingles that aren't connected yet are compared once they are at most so many per row, or once a
#: round with leaders has left over half of them: those that are left then are unlike each other for the most part.
PAIRS_A_ROW = 8
LEADER_ROUNDS = 6
#: Texts that are worked on at once.
TEXTS = 512
#: Up to so many keys, or places of texts to be fetched, of 8 or 16 bytes each, are broadcast.
BROADCAST_ROWS = 200_000


def sketch_plan(rows: int) -> tuple[int, int]:
    """(width, segments): four values of a segment for each text, and segments for the wanted recall.

    A pair meets in a segment if it differs there in at most two bits, one flipped on either side.
    """
    width = max(20, math.ceil(math.log2(max(2, rows))) + 2)
    meet = FLIPS_HOLD * sum(math.comb(width, k) * DIFFER**k * (1 - DIFFER) ** (width - k) for k in range(3))
    return width, math.ceil(math.log(MISS) / math.log(1 - meet))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text; a shorter text is one shingle, no words give none."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = max(len(w) - words + 1, 1) if w else 0
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(b" ".join(w[i : i + words]), SEED) for i in range(n)), np.uint64, n))


def _lanes(hashes: np.ndarray, n: int) -> np.ndarray:
    """``n`` independent 64-bit words for each hash."""
    x = hashes[:, None] + np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def sketch(hashes: np.ndarray, width: int, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The SimHash of a set as (value, flips) of each segment and as 64-bit words: a bit is the majority's; ``flips`` marks the bits of the narrowest majorities."""
    if not len(hashes):
        return (np.zeros(0, np.int64),) * 3
    lanes = max(WORDS_OF_BITS, -(-width * segments // 64))
    ones = np.zeros(lanes * 64, np.int64)
    for at in range(0, len(hashes), 2048):
        ones += np.unpackbits(_lanes(hashes[at : at + 2048], lanes).view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    lead = (2 * ones[: width * segments] - len(hashes)).reshape(segments, width)
    low = np.argpartition(np.abs(lead), FLIPS - 1, axis=1)[:, :FLIPS]
    return (lead > 0) @ (1 << np.arange(width)), (1 << low).sum(1), np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _parts(batches):
    """Batches of a few texts, so that a task holds what it makes of few at once."""
    for b in batches:
        yield from (b.slice(at, TEXTS) for at in range(0, len(b), TEXTS))


def _prints(docs: DataFrame, words: int, width: int, segments: int) -> DataFrame:
    """``(doc_id, row, node, n, value, flips, bits)`` of ``docs(doc_id, row, text)``; ``node`` stands for the set of shingles."""
    names = ["doc_id", "row", "node", "n", "value", "flips", "bits"]

    def run(batches):
        for b in _parts(batches):
            nodes, sizes, prints = [], [], []
            for t in b.column(2):
                h = shingles(t.as_py(), words)
                nodes.append(_signed(xxhash.xxh3_64_intdigest(h.tobytes(), SEED)))
                sizes.append(len(h))
                prints.append(sketch(h, width, segments))
            arrays = [pa.array([p[k] for p in prints], pa.list_(pa.int64())) for k in range(3)]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), *arrays], names)

    return docs.mapInArrow(run, "doc_id long, row long, node long, n long, value array<long>, flips array<long>, bits array<long>")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """``(node, hashes)`` of ``docs(node, text)``."""

    def run(batches):
        for b in _parts(batches):
            sets = [shingles(t.as_py(), words).view(np.int64) for t in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "hashes"])

    return docs.mapInArrow(run, "node long, hashes array<long>")


def _cells(sets: DataFrame) -> np.ndarray:
    """How often shingles of ``sets(hashes)`` fall into each of ``CELLS`` cells by their hash."""

    def run(batches):
        counts = np.zeros(CELLS, np.int64)
        for b in batches:
            for hashes in b.column(0):
                counts[hashes.values.to_numpy() & (CELLS - 1)] += 1
        cells = np.flatnonzero(counts)
        yield from (pa.record_batch([pa.array(cells[at : at + 65536]), pa.array(counts[cells[at : at + 65536]])], ["cell", "k"]) for at in range(0, len(cells), 65536))

    found = sets.select("hashes").mapInArrow(run, "cell long, k long").groupBy("cell").agg(F.sum("k").alias("k")).where("k > 1").toArrow()
    out = np.ones(CELLS, np.uint32)
    out[found.column("cell").to_numpy()] = found.column("k").to_numpy()
    return out


def _rarest(sets: DataFrame, cells: np.ndarray) -> DataFrame:
    """``(node, n, bits, keys)`` of ``sets(node, n, bits, hashes)``: of each set so many shingles of the smallest ``cells`` that similar sets share one.

    Two sets of the least similarity have at least that part of either in common. One of these shingles is among
    the first of each set in one order of all, the rest being too few; which order doesn't matter to that.
    """
    up, down = SIMILARITY

    def run(batches):
        for b in batches:
            keys = []
            for hashes in b.column(3):
                h = hashes.values.to_numpy()
                keys.append(h[np.lexsort((h, cells[h & (CELLS - 1)]))[: len(h) + 1 + -len(h) * up // down]])
            yield pa.record_batch([b.column(0), b.column(1), b.column(2), pa.array(keys, pa.list_(pa.int64()))], ["node", "n", "bits", "keys"])

    return sets.select("node", "n", "bits", "hashes").mapInArrow(run, "node long, n long, bits array<long>, keys array<long>")


def _leading(rows: int, segments: int) -> Column:
    """Keys of segments that few texts share by chance, one in 64 at most whatever their number is."""
    width = math.ceil(math.log2(max(2, rows))) + 6
    each = 64 // width
    part = lambda b, k, j: F.shiftrightunsigned(b, j * width).bitwiseAND(F.lit((1 << width) - 1)).bitwiseOR(F.call_function("shiftleft", (k * each + j).cast("long"), F.lit(48)))
    return F.slice(F.flatten(F.transform("bits", lambda b, k: F.array(*[part(b, k, j) for j in range(each)]))), 1, segments)


def _segments() -> Column:
    """Keys of the segments themselves."""
    return F.transform("value", lambda value, k: value.bitwiseOR(F.call_function("shiftleft", k.cast("long"), F.lit(48))))


def _balls(width: int) -> Column:
    """Keys of the Hamming balls around the segments: each one, and it with one of its ``flips`` turned."""

    def ball(own: Column, k: Column) -> Column:
        bits = F.filter(F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda b: F.call_function("shiftleft", F.lit(1).cast("long"), b)), lambda m: F.get("flips", k).bitwiseAND(m) != 0)
        return F.array_append(F.transform(bits, lambda m: own.bitwiseXOR(m)), own)

    return F.flatten(F.transform(_segments(), ball))


def _near(x: str, y: str, whole: bool) -> Column:
    """Whether rows named ``x`` and ``y`` differ in few enough bits, of the first words or of the whole fingerprint."""
    of = lambda n, c: F.col(f"{n}.{c}")
    differ = lambda p, q: F.bit_count(p.bitwiseXOR(q)).cast("int")
    if whole:
        distance, bits = F.aggregate(F.zip_with(of(x, "bits"), of(y, "bits"), differ), F.lit(0), lambda s, d: s + d), 64 * F.size(of(x, "bits"))
    else:
        distance, bits = reduce(lambda s, d: s + d, [differ(of(x, c), of(y, c)) for c in CHECKS]), F.lit(64 * len(CHECKS))
    most = DIFFER + DEVIATIONS * (DIFFER * (1 - DIFFER)) ** 0.5 / F.sqrt(bits)
    return distance <= F.when(F.least(of(x, "n"), of(y, "n")) < SMALL, MOST_SMALL).otherwise(most) * bits


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b)`` within the complete distance whose sets are similar, by the exact intersection."""
    up, down = SIMILARITY
    both = F.size(F.array_intersect("x.hashes", "y.hashes"))
    alike = both * (up + down) >= (F.size("x.hashes") + F.size("y.hashes")) * up
    met = pairs.join(sets.alias("x"), F.col("a") == F.col("x.node")).join(sets.alias("y"), F.col("b") == F.col("y.node"))
    return met.where(_near("x", "y", True) & alike).select("a", "b")


def _pair(where: Column, left: DataFrame, right: DataFrame, whole: bool = False) -> DataFrame:
    """``(a, b)`` of rows ``l`` and ``r`` of different components under one key, of like size and near by their bits, once each."""
    up, down = SIMILARITY
    like = F.least("l.n", "r.n") * down >= F.greatest("l.n", "r.n") * up
    met = left.alias("l").join(right.alias("r"), (F.col("l.key") == F.col("r.key")) & (F.col("l.c") != F.col("r.c")) & where & like & _near("l", "r", whole))
    return met.select(F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b")).distinct()


def _checks() -> list[Column]:
    return [F.get("bits", F.lit(k)).alias(c) for k, c in enumerate(CHECKS)]


def _rows(some: DataFrame, keys: Column, *also: str) -> DataFrame:
    """``key, node, n, check0, check1, ...`` under each of the ``keys`` of ``some(node, n, bits)``."""
    return some.select(F.explode(keys).alias("key"), "node", F.col("n").cast("int").alias("n"), *_checks(), *also)


def _ranked(rarest: DataFrame) -> DataFrame:
    """``key, node, n, check0, check1, ..., before`` under each of the ``keys`` of ``rarest(node, n, bits, keys)``; ``before`` are up to ``BEFORE`` of those that come before it."""
    before = F.slice("keys", F.greatest(F.col("pos") - BEFORE + 1, F.lit(1)), F.least(F.col("pos"), F.lit(BEFORE)))
    placed = rarest.select("node", "n", "bits", "keys", F.posexplode("keys").alias("pos", "key"))
    return placed.select("key", "node", F.col("n").cast("int").alias("n"), *_checks(), before.alias("before"))


def _shared(rows: DataFrame) -> DataFrame:
    """Those of ``rows(key, ...)`` whose key another one has."""
    return rows.join(rows.groupBy("key").count().where("count > 1").select("key"), "key", "left_semi")


def few(rows: DataFrame, n: int) -> DataFrame:
    """``rows``, of which there are ``n``, to be broadcast in a join while they are few."""
    return F.broadcast(rows) if n <= BROADCAST_ROWS else rows


def _crowded(rows: DataFrame) -> DataFrame:
    """``(key, crowded)`` of the keys that at least ``CROWD`` of ``rows(key, node)`` have, of those that the sample shows."""
    sample = rows.where(F.pmod("node", F.lit(SAMPLE)) == 0).groupBy("key").count()
    likely = settle(sample.where(F.col("count") >= SAMPLED).select("key", F.lit(True).alias("likely")))
    # All other rows count as one null key, so that a task sends one row for them.
    counted = settle(rows.join(few(likely, likely.count()), "key", "left").groupBy(F.when(F.col("likely"), F.col("key")).alias("key")).count())
    out = settle(counted.where(F.col("key").isNotNull() & (F.col("count") >= CROWD)).select("key", F.lit(True).alias("crowded")))
    forget(likely, counted)
    return out


class Groups:
    """Texts with their components so far: ``labels(node, c)``; pairs of texts are verified and join components."""

    def __init__(self, nodes: DataFrame, text: DataFrame, words: int):
        """``nodes(node, n, value, flips, bits, first)`` are distinct sets of shingles, ``text(doc_id, row, text)`` the texts that they come from."""
        self.nodes, self.text, self.words = nodes, text, words
        self.labels = settle(nodes.select("node", F.col("node").alias("c")))

    def rows(self, keys: Column, labelled: bool = False) -> DataFrame:
        """``key, node, n, check0, check1, ...`` and, if asked, ``c`` under each of a text's ``keys``."""
        some = self.nodes.join(self.labels, "node") if labelled else self.nodes
        return _rows(some, keys, *["c"] * labelled)

    def sets(self, ends: DataFrame) -> DataFrame:
        """``(node, hashes, n, bits)`` of the texts of ``ends(node)``."""
        wanted = settle(self.nodes.join(ends, "node", "left_semi").select("node", "n", "bits", "first"))
        place = wanted.select("node", F.col("first.doc_id").alias("doc_id"), F.col("first.row").alias("row"))
        place = few(place, wanted.count())
        sets = _sets(self.text.join(place, ["doc_id", "row"]).select("node", "text"), self.words).dropDuplicates(["node"])
        out = settle(sets.join(wanted.select("node", "n", "bits"), "node"))
        forget(wanted)
        return out

    def join(self, pairs: DataFrame) -> None:
        """Connect the components of those of ``pairs(a, b)`` that are similar."""
        pairs = settle(pairs)
        if not pairs.isEmpty():
            sets = self.sets(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
            links = settle(_similar(pairs, sets))
            named = lambda n: self.labels.select(F.col("node").alias(n), F.col("c").alias(f"c{n}"))
            found = components(links.join(named("a"), "a").join(named("b"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
            before, found = self.labels, found.select(F.col("node").alias("c"), "component")
            self.labels = settle(before.join(found, "c", "left").select("node", F.coalesce("component", "c").alias("c")))
            forget(before, sets, links)
        forget(pairs)

    def follow_leaders(self, buckets: DataFrame, rounds: int, rest: bool) -> None:
        """Connect similar texts within ``buckets`` (as ``rows`` or, for the rest, ``_ranked`` gives them), in time linear in a bucket's rows for each round.

        Each round compares all rows outside the largest component of a bucket with one row of it, the
        leader. The ``rest`` of the pairs, those that still lie in different components, is compared at the
        end if asked: one end of each is outside the largest component.
        """
        columns, before = buckets.columns, math.inf
        for t in range(rounds + 1):
            rows = buckets.join(self.labels, "node")
            parts = rows.groupBy("key", "c").agg(F.count("*").alias("k"))
            whole = parts.groupBy("key").agg(F.sum("k").alias("all"), F.sum(F.col("k") * F.col("k")).alias("own"), F.max_by("c", F.struct("k", "c")).alias("largest"))
            whole = settle(whole.where("all * all > own"))
            n_rows, left = whole.agg(F.sum("all"), F.sum((F.col("all").cast("double") * F.col("all") - F.col("own")) / 2)).first()
            if not left:
                break
            last = t == rounds or 2 * left > before or rest and left <= PAIRS_A_ROW * n_rows
            before = left
            if last and not rest:
                break
            rows = settle(rows.join(whole.select("key", "all", "largest"), "key"))
            outside = rows.where("c <> largest")
            if last:
                whole_prints = self.nodes.select("node", "bits")
                self.join(_pair(~F.arrays_overlap("l.before", "r.before"), outside.join(whole_prints, "node"), rows.join(whole_prints, "node"), whole=True))
                break
            leader = F.min_by(F.struct("node", "n", *CHECKS, "c"), F.struct(F.xxhash64("node", F.lit(t)), "node"))
            self.join(_pair(F.lit(True), rows.where("c = largest").groupBy("key").agg(leader.alias("x")).select("key", "x.*"), outside))
            # Two rows have been compared for good.
            buckets = rows.where("all > 2").select(*columns)


def keep_one_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """``docs`` with one row of each group of similar texts, that of the smallest id; null ids all stay.

    Groups are of texts, not of ids: where an id repeats with different texts, each text belongs to its own
    group. Among rows of a group's smallest id the one with the least row hash stays; of equal rows one
    stays. Texts without words are similar to each other alone. An empty table gives an empty table.

    Texts that share a wide segment follow a leader first, which connects large groups at little cost. Then
    each text writes its segments' small Hamming balls, and texts of different components that meet are
    compared by the first words of their fingerprints inside the join, by the complete distance, and by
    their sets of shingles.
    Texts of crowded buckets meet under the rarest of their shingles instead, of which similar ones always
    share one; they follow leaders there until the rest of their pairs is worth comparing. A pair at the least
    similarity is missed with a probability of about ``MISS``, and more often only if a text has fewer than
    about ten shingles. Sets are known by a 64-bit hash.
    """
    n_rows = docs.count()
    width, segments = sketch_plan(n_rows)
    rows, names = with_row_key(docs, id_col)
    text = rows.select(F.col(names[0]).alias("doc_id"), F.col(names[1]).alias("row"), F.col(text_col).alias("text"))
    own = settle(_prints(text, words, width, segments))
    least = F.min(F.struct("doc_id", "row")).alias("first")
    nodes = settle(own.groupBy("node").agg(least, F.first("n").alias("n"), *[F.first(c).alias(c) for c in ("value", "flips", "bits")]))
    forget(own)
    groups = Groups(nodes, text, words)

    plain = settle(_shared(groups.rows(_leading(n_rows, segments))))
    groups.follow_leaders(plain, LEADER_ROUNDS, rest=False)
    forget(plain)

    crowded = _crowded(groups.rows(_balls(width)).select("key", "node"))
    n_crowded = crowded.count()
    table = groups.rows(_balls(width), labelled=True).join(few(crowded.select("key"), n_crowded), "key", "left_anti")
    groups.join(_pair(F.col("l.node") < F.col("r.node"), table, table))
    if n_crowded:
        marked = groups.rows(_balls(width)).select("key", "node").join(few(crowded, n_crowded), "key", "left")
        crowds = groups.sets(marked.groupBy("node").agg(F.max("crowded").alias("crowded")).where("crowded").select("node"))
        buckets = settle(_shared(_ranked(_rarest(crowds, _cells(crowds)))))
        groups.follow_leaders(buckets, LEADER_ROUNDS, rest=True)
        forget(crowds, buckets)

    grouped = nodes.select("node", "first").join(groups.labels, "node")
    kept = settle(grouped.groupBy("c").agg(F.min("first").alias("x")).select("x.doc_id", "x.row"))
    forget(nodes, crowded, groups.labels)
    return rows_of(docs, rows, names, kept, id_col)
