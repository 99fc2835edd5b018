import random

import pytest
import xxhash

import corpus_pipeline
from tests.llm.test_simhash import groups
from tidewell.llm import similar
from tidewell.llm.similar import keep_one_similar

SF = "/root/testdata/sf0.01"


def brute_set(text, k=5):
    w = (text or "").lower().split()
    return {" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_kept(rows):
    """rows: (id, text) with unique ids"""
    sets = [(i, brute_set(t)) for i, t in rows]
    edges = [(i, i) for i, _ in sets]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b):
                edges.append((i, j))
    top = groups(edges)
    return {i for i, _ in rows if top[i] == i}


def test_stage_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.simhash(spark, docs, SF).collect()}
    assert kept == brute_kept([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("pairs_a_row", [8, 0])
def test_changed_words(spark, monkeypatch, pairs_a_row):
    """Copies on both sides of 0.8, a chain of them, and a large group around one text."""
    monkeypatch.setattr(similar, "PAIRS_A_ROW", pairs_a_row)
    rnd = random.Random(5)
    rows = []

    def put(words):
        rows.append((1000 - len(rows), " ".join(words)))
        return words

    def changed(words, n):
        out = list(words)
        for at in rnd.sample(range(len(out)), n):
            out[at] = f"new{rnd.random()}"
        return out

    for n in (2, 3, 4, 6, 12):
        base = put([f"w{rnd.randrange(5000)}" for _ in range(120)])
        put(changed(base, n))
    base = put([f"w{rnd.randrange(5000)}" for _ in range(200)])
    for _ in range(60):
        put(changed(base, 3))
    for _ in range(12):
        base = put(changed(base, 2))
    assert {r.doc_id for r in keep_one_similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == brute_kept(rows)


def test_repeated_ids(spark):
    """An id with two texts belongs to two groups; each keeps one row."""
    rows = [(1, "a b c d e f", 1), (1, "u v w x y z", 2), (2, "u v w x y z", 3), (2, "k l m n o p", 4), (2, "k l m n o p", 4), (None, "a b c d e f", 5), (3, None, 6), (4, "", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    assert sorted(r.n for r in keep_one_similar(docs).collect()) == [1, 2, 4, 5, 6]
    assert keep_one_similar(docs.limit(0)).count() == 0 and keep_one_similar(docs).columns == docs.columns


def test_crowd_of_unlike_copies(spark, monkeypatch):
    """Copies that are too unlike for a link crowd the segments; the rows that are compared there stay few, and no pair is lost."""
    rnd, rows, compared = random.Random(7), [], []
    base = [f"w{rnd.randrange(5000)}" for _ in range(120)]
    for i in range(240):
        words = list(base)
        for at in rnd.sample(range(120), 3 if i % 40 == 0 else rnd.randrange(4, 9)):
            words[at] = f"new{rnd.random()}"
        rows.append((i, " ".join(words)))
    follow = similar.Groups.follow_leaders

    def spy(groups, buckets, rounds, rest):
        compared.append((rest, buckets.count()))
        follow(groups, buckets, rounds, rest)

    monkeypatch.setattr(similar.Groups, "follow_leaders", spy)
    assert {r.doc_id for r in keep_one_similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == brute_kept(rows)
    assert [rest for rest, _ in compared] == [False, True] and compared[1][1] < 24 * len(rows)


def test_crowds_by_chance(spark, monkeypatch):
    """A small group whose texts all happen to be in the sample is no crowd, however many such groups there are."""
    rnd, rows, rests = random.Random(11), [], []

    def sampled(text):
        return xxhash.xxh3_64_intdigest(similar.shingles(text).tobytes(), similar.SEED) % similar.SAMPLE == 0

    for _ in range(5):
        base, group = [f"w{rnd.randrange(5000)}" for _ in range(120)], []
        while len(group) < 12:
            words = list(base)
            for at in rnd.sample(range(5, 115, 10), 2):
                words[at] = f"new{rnd.random()}"
            if sampled(" ".join(words)):
                group.append(" ".join(words))
        rows += [(len(rows) + i, t) for i, t in enumerate(group)]
    follow = similar.Groups.follow_leaders

    def spy(groups, buckets, rounds, rest):
        rests.append(rest)
        follow(groups, buckets, rounds, rest)

    monkeypatch.setattr(similar.Groups, "follow_leaders", spy)
    assert {r.doc_id for r in keep_one_similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == brute_kept(rows)
    assert rests == [False]
