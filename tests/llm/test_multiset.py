import hashlib

import pytest
from pyspark.sql import functions as F

from tidewell.llm.multiset import LANES, added, decoded, edited_fingerprints, encoded, fingerprints, likeness, op13_fingerprints, removed


def brute(rows):
    """(doc_id, n_chars, edited_sha256) of rows with distinct ids, in any order."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        out.append((i, len(t), hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()))
    return out


def pairs(text):
    found = {}
    for line in text.split("\n"):
        words = line.split(" ")
        words = [w for w in words if w]
        for p in zip(["\n", *words], [*words, "\n"]) if words else ():
            found[p] = found.get(p, 0) + 1
    return found


def cosine(a, b):
    a, b = pairs(a), pairs(b)
    size = lambda x: sum(v * v for v in x.values())
    return sum(v * b.get(k, 0) for k, v in a.items()) / ((size(a) * size(b)) ** 0.5 or 1)


@pytest.mark.parametrize("blocks", [None, 1, 7, 300])
def test_query_against_brute_force(spark, sf_dir, blocks):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    got = (edited_fingerprints(docs, blocks=blocks) if blocks else op13_fingerprints(spark, sf_dir)).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(brute(text.items()))
    own = {r.doc_id: r.fingerprint for r in got}
    assert all((text[i] == text[j]) <= (own[i] == own[j]) for i in own for j in own)
    after, off = dict(zip(sorted(text, reverse=True), sorted(text, reverse=True)[1:] + [max(text)])), []
    for r in got:
        t, half = text[r.doc_id], len(text[r.doc_id]) // 2
        off += [abs(r.near_edited - max(0, cosine(t, t[: len(t) - half] + text[after[r.doc_id]][:half]))), abs(r.near_next - max(0, cosine(t, text[after[r.doc_id]])))]
    assert sum(off) / len(off) < LANES**-0.5 and max(off) < 5 * LANES**-0.5
    assert sum(r.near_edited > r.near_next for r in got) > 0.95 * len(got)


def test_homomorphism(spark):
    rows = [("ab", "one two\nthree four"), ("ba", "three four\n\n one two \t"), ("a", "one two"), ("b", "three four"), ("aab", "one two\nthree four\none two"), ("none", None), ("blank", " \n\n"), ("w", "one  two"), ("x", "one two three four")]
    found = fingerprints(spark.createDataFrame(rows, "doc_id string, text string"))
    v = {r.id: r for r in found.collect()}
    assert v["ab"].fingerprint == v["ba"].fingerprint != v["x"].fingerprint and v["none"].fingerprint == v["blank"].fingerprint and v["w"].fingerprint != v["a"].fingerprint
    one = spark.createDataFrame([(v["a"].vector, v["b"].vector, v["ab"].vector, v["aab"].vector, v["none"].vector, v["ab"].fingerprint)], "a array<long>, b array<long>, ab array<long>, aab array<long>, zero array<long>, text string")
    c = F.col
    checks = [added(c("a"), c("b")) == c("ab"), added(c("ab"), c("a")) == c("aab"), removed(removed(c("aab"), c("a")), c("a")) == c("b"), removed(c("ab"), c("ab")) == c("zero"), decoded(c("text")) == c("ab"),
              encoded(c("ab")) == c("text"), likeness(c("ab"), c("ab")) == 1, likeness(c("zero"), c("zero")) == 1, likeness(c("zero"), c("a")) == 0]
    assert all(one.select(*checks).first())


def test_edge_rows(spark):
    schema = "doc_id long, text string, place int, kind int, block string"
    extra = (1, 2, "x")
    rows = [(5, "é𝄞abc"), (None, "null id"), (3, None), (2, ""), (7, "word " * 60_000), (-4, "x"), (9, "𝄞")]
    docs = spark.createDataFrame([(*r, *extra) for r in rows], schema)
    for blocks in (1, 3, 50):
        got = edited_fingerprints(docs, blocks=blocks).collect()
        assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == sorted(brute(rows), key=str)
    repeated = spark.createDataFrame([(1, "a b")] * 40 + [(1, "c"), (2, "a b")], "doc_id long, text string")
    got = edited_fingerprints(repeated, blocks=4).collect()
    assert len(got) == 42 and len({r.fingerprint for r in got}) == 2 and sum(r.near_next == 1 for r in got) >= 39
    assert edited_fingerprints(docs.limit(0)).count() == 0
    assert edited_fingerprints(docs.where("doc_id = 5")).first().near_next == 1
