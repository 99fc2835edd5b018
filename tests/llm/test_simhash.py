import random
from itertools import combinations_with_replacement

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidewell.llm.components import components
from tidewell.llm.simhash import _keys, choose_plan, fingerprint, fingerprint_links, keep_one, near_duplicates, op2_simhash, segment_plan


def brute_print(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    out = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    return out - (1 << 64) if out >> 63 else out


def groups(edges):
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {x: top(x) for x in list(parent)}


def brute_components(rows):
    """rows: (doc_id, fp)"""
    ids, fp = np.array([r[0] for r in rows]), np.array([r[1] for r in rows]).astype(np.int64)
    edges = []
    for i in range(len(rows)):
        near = np.nonzero(np.bitwise_count((fp ^ fp[i]).view(np.uint64)) <= 4)[0]
        edges += [(int(ids[i]), int(ids[j])) for j in near]
    return groups(edges)


def test_fingerprint():
    for t in [None, "", " \n\t", "A", "one Two three", "É a b c d", "a b c d e f a b c d", "x\x1cy z w v u", "w " * 70_000]:
        assert fingerprint(t) == brute_print(t), t
    assert fingerprint("one Two three") == fingerprint(" one\ttwo THREE ")


@pytest.mark.parametrize("distance,blocks,together", [(4, 3, 1), (4, 2, 1), (4, 4, 1), (3, 4, 1), (4, 5, 1), (4, 3, 2), (4, 4, 2), (6, 4, 3)])
def test_radii_find_every_pair(distance, blocks, together):
    plan = segment_plan(distance, blocks, together)
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    assert {p for parts, _ in plan for p in parts} == {(a, b - a) for a, b in zip(edges, edges[1:])}
    # However the differing bits fall on the blocks, some segment holds no more than its radius.
    for bits in combinations_with_replacement(range(blocks), distance):
        own = {edges[i]: bits.count(i) for i in range(blocks)}
        assert any(sum(own[shift] for shift, _ in parts) <= radius for parts, radius in plan)


def test_the_cut_follows_the_number_of_rows():
    widths = [min(sum(w for _, w in parts) for parts, _ in choose_plan(n)) for n in (0, 1000, 1 << 21, (1 << 21) + 1, 1 << 26, 1 << 28, 1 << 36)]
    assert widths == [21, 21, 21, 32, 32, 42, 42]
    assert choose_plan(10, 0) == [([(0, 64)], 0)]


@pytest.mark.parametrize("bucket_rows", [256, 1])
@pytest.mark.parametrize("cut", [(3, 1), (2, 1), (3, 2)])
def test_links_against_all_pairs(spark, bucket_rows, cut):
    rnd = random.Random(3)
    prints = set()
    while len(prints) < 300:
        base = rnd.getrandbits(64)
        for _ in range(rnd.choice([1, 1, 5, 30])):
            f = base
            for _ in range(rnd.randint(0, 5)):
                f ^= 1 << rnd.randrange(64)
            prints.add(f - (1 << 64) if f >> 63 else f)
    rows = [(f, f) for f in sorted(prints)]
    links = fingerprint_links(spark.createDataFrame([(f,) for f, _ in rows], "fp long"), plan=segment_plan(4, *cut), bucket_rows=bucket_rows)
    assert links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 4).count() == 0
    found = {r.node: r.component for r in components(links).collect()}
    want = brute_components(rows)
    assert found == {a: b for a, b in want.items() if list(want.values()).count(b) > 1}


@pytest.mark.parametrize("distance", [3, 5])
def test_other_distances(spark, distance):
    rnd = random.Random(distance)
    prints = {f ^ sum(1 << b for b in rnd.sample(range(63), rnd.randint(0, distance + 1))) for f in [rnd.getrandbits(63) for _ in range(20)] for _ in range(6)}
    links = fingerprint_links(spark.createDataFrame([(f,) for f in prints], "fp long"), distance, bucket_rows=1)
    want = groups([(a, b) for a in prints for b in prints if (a ^ b).bit_count() <= distance])
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {a: b for a, b in want.items() if list(want.values()).count(b) > 1}


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(300)] + [(500 + i, 501 + i) for i in range(60)] + [(7, i) for i in range(900, 1000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges + [(None, 1), (5000, 5000)], "a long, b long")).collect()}
    want = groups(edges)
    assert got == {k: v for k, v in want.items() if k in got}
    assert {k for k in want if k not in got} == {k for k, v in want.items() if list(want.values()).count(v) == 1}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edge_rows(spark):
    long = "word%d " * 3
    rows = [(1, "a b c d e", 1), (1, "a b c d e", 2), (2, None, 3), (3, "", 4), (None, "a b c d e", 5), (4, "A  b\nc d e", 6), (5, long * 50_000, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = sorted(((r.doc_id, r.component_id) for r in near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 1), (1, 1), (2, 2), (3, 2), (None, None), (4, 1), (5, 5)], key=str)
    kept = keep_one(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 5]
    assert near_duplicates(docs.where(F.lit(False))).count() == 0 and keep_one(docs.where(F.lit(False))).count() == 0


def test_query(spark, sf_dir):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op2_simhash(spark, sf_dir).collect()
    prints = [(i, brute_print(t)) for i, t in text.items()]
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{p % (1 << 64):016x}" for i, p in prints}
    want = brute_components(prints)
    assert {r.doc_id: r.component_id for r in rows} == want


@pytest.mark.parametrize("cut", [(3, 1), (2, 1), (3, 2)])
def test_table_and_ball_keys(spark, cut):
    """Two fingerprints within the radius of a segment share a key of the probe's ball and the table's."""
    plan = segment_plan(4, *cut)
    rnd = random.Random(4)
    rows = []
    for n in range(40):
        fp = rnd.getrandbits(64)
        other = fp
        for b in rnd.sample(range(64), 4):
            other ^= 1 << b
        rows.append((n, *(x - (1 << 64) if x >> 63 else x for x in (fp, other))))
    df = spark.createDataFrame(rows, "n long, x long, y long")
    probe = df.select("n", F.col("x").alias("fp")).select("n", _keys(plan, True))
    table = df.select("n", F.col("y").alias("fp")).select("n", _keys(plan, False))
    assert probe.join(table, ["n", "key"]).select("n").distinct().count() == 40
    assert probe.count() == 40 * sum(1 + sum(w for _, w in parts) * (radius > 0) for parts, radius in plan)


def test_repeated_ids(spark):
    """An id with two texts belongs to two groups; no group loses all its rows, and none is joined to another by an id."""
    rows = [(5, "alpha beta gamma delta", 1), (5, "totally other words here", 2), (7, "totally other words here", 3), (7, "one more text apart", 4), (5, "alpha beta gamma delta", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id int")
    assert sorted((r.doc_id, r.component_id) for r in near_duplicates(docs).collect()) == [(5, 5), (5, 5), (5, 5), (7, 5), (7, 7)]
    kept = keep_one(docs)
    assert sorted(r._id for r in kept.collect()) == [1, 2, 4] and kept.columns == docs.columns
    assert sorted(r._id for r in keep_one(docs.repartition(3)).collect()) == [1, 2, 4]
