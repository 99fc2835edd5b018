"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns, for each operator that has no such test beside its others."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_embeddings import brute
from tidewell.llm.embeddings import MultiIndex, _codes, near_vectors, op10_multi_index
from tidewell.llm.lines import drop_boilerplate
from tidewell.llm.media import parse_matroska, sample_features, store_texts, write_matroska
from tidewell.llm.packing import pack, token_pieces
from tidewell.llm.segmentation import MARK, MODEL, Lattices, _draw_other, _unseen, decode, encode, op9_segmentation, processor, sample_segmentations, sample_units
from tidewell.llm.sharding import WALKS, _sides, shard
from tidewell.llm.simhash import keep_one
from tidewell.llm.similar import keep_one_similar
from tidewell.llm.tables import forget, settle, unused
from tidewell.llm.tokens import at_limits, byte_encoding, length_histogram, op6_token_counts, quantile_lengths, token_counts, tokenizer_path
from tidewell.llm.toxicity import score_toxicity

ROWS = [(1, None), (2, ""), (None, "a b c"), (3, "word " * 60_000), (4, "a b c"), (4, "a b c"), (5, "é😀 \x00\ttab")]


@pytest.fixture
def odd(spark):
    """Odd rows, with columns of the names that operators might give to their own."""
    clash = ["n_tokens", "content", "sequence_id", "_part", "_rank", "_host", "_lines", "_own", "_salt", "_toxicity", "_row", "_id"]
    return spark.createDataFrame([(*r, "s", *["kept"] * len(clash)) for r in ROWS], "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in clash))


def test_unused_names(spark):
    df = spark.range(1).selectExpr("id", "1 AS _A", "2 AS __a")
    assert unused(df, "a", "b", "b") == ["___a", "_b", "__b"]


def test_settled_tables_go(spark):
    df = settle(spark.range(3))
    assert df.count() == 3
    forget(df, None, spark.range(1))
    with pytest.raises(Exception):
        spark.read.parquet(df.settled_at).count()


@pytest.mark.parametrize("broadcast_lines", [1000, 0])
def test_line_dedup_keeps_other_columns(odd, broadcast_lines):
    out = drop_boilerplate(odd, max_ratio=0.2, min_pages=2, broadcast_lines=broadcast_lines, counts=True)
    rows = out.collect()
    assert len(rows) == len(ROWS) and all(r._host == r._lines == r._own == r._salt == "kept" for r in rows)
    assert sorted((r.text or "") for r in rows if r.doc_id in (None, 4)) == ["", "", ""] and [r.n_dropped for r in rows if r.doc_id == 1] == [0]


def test_token_counts(odd):
    enc = byte_encoding(tokenizer_path("byte_bpe_50k.tiktoken"))
    out = token_counts(odd)
    want = sorted(len(enc.encode_ordinary(t or "")) for _, t in ROWS)
    assert sorted(r.n_tokens for r in out.collect()) == want and set(out.columns) == set(odd.columns)
    assert token_counts(odd.limit(0)).count() == 0


def test_any_limit(spark):
    lengths = [5, 5, 0, 700, 256, 255, 9000]
    hist = length_histogram(spark.createDataFrame([(n,) for n in lengths], "n_tokens int"))
    limits = [0, 1, 5, 6, 255, 256, 257, 8000, 9000, 10_000]
    got = {r.context_limit: (r.n_docs, r.n_tokens, r.docs_over, r.truncated_tokens) for r in at_limits(hist, limits).collect()}
    assert got == {n: (7, sum(lengths), sum(x > n for x in lengths), sum(min(x, n) for x in lengths)) for n in limits}
    parts = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {r.part: r.n_tokens for r in quantile_lengths(hist, parts).collect()}
    assert got == {q: min(x for x in lengths if sum(y <= x for y in lengths) >= q * 7) for q in parts}
    none = length_histogram(spark.createDataFrame([], "n_tokens int"))
    assert [tuple(r) for r in at_limits(none, [4]).collect()] == [(4, 0, 0, 0, 0)] and [r.n_tokens for r in quantile_lengths(none, [0.5]).collect()] == [None]


def test_texts_are_tokenized_once(spark, sf_dir):
    plan = op6_token_counts(spark, sf_dir)._jdf.queryExecution().toString()
    assert "ArrowEvalPython" not in plan


def test_packing(odd):
    pieces = token_pieces(odd)
    assert token_pieces(odd.limit(0)).count() == 0 and pieces.where("doc_id = 1").first().length == 1
    extra = pieces.withColumns({"_part": F.lit("kept"), "_rank": F.lit("kept"), "sequence_id": F.lit("old")})
    out = pack(extra).collect()
    assert all(r._part == r._rank == "kept" for r in out) and len(out) == pieces.count()
    place = {}
    for r in out:
        place.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in place.values():
        v.sort()
        assert [a for a, _ in v] == np.cumsum([0] + [n for _, n in v])[:-1].tolist() and sum(n for _, n in v) <= 2048
    assert pack(pieces.limit(0)).count() == 0


def test_rows_without_an_id_are_spread(spark):
    """However many null ids share a length, their ranks come from many parts."""
    df = spark.createDataFrame([(None, i, 0, 7, i) for i in range(500)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    out = pack(df).collect()
    assert len({(r.sequence_id, r.offset) for r in out}) == 500 and len({r.sequence_id for r in out}) == math.ceil(500 / (2048 // 7))


def test_media(spark, odd):
    out = sample_features(store_texts(odd)).collect()
    assert len(out) == len(ROWS)
    for r in out:
        text = next((t or "").encode() for i, t in ROWS if i == r.doc_id)
        payload = text + b" " * (-len(text) % 192 if text else 192)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        assert (r.media_sha256, r.media_bytes) == (hashlib.sha256(write_matroska(payload)).hexdigest(), len(write_matroska(payload)))
    assert len({tuple(r)[1:] for r in out if r.doc_id == 4}) == 1
    assert store_texts(odd.limit(0)).count() == 0 and sample_features(store_texts(odd.limit(0))).count() == 0
    bad = spark.createDataFrame([(1, 0, None), (2, 0, bytearray(b"no media")), (3, 0, bytearray())], "doc_id long, n_bytes long, content binary")
    assert all(r.payload_bytes is None and r.media_sha256 is None for r in sample_features(bad).collect())
    assert parse_matroska(write_matroska(b" " * 192))[1][0][3] == 192


def test_encode_and_decode(odd):
    sp = processor(tokenizer_path(MODEL))
    ids = encode(odd)
    assert sorted(((r.doc_id, r.ids) for r in ids.collect()), key=str) == sorted(((i, None if t is None else sp.encode(t)) for i, t in ROWS), key=str)
    assert sorted(((r.doc_id, r.text) for r in decode(ids).collect()), key=str) == sorted(((i, None if t is None else sp.decode(sp.encode(t))) for i, t in ROWS), key=str)
    assert encode(odd.limit(0)).count() == 0 and decode(ids.limit(0)).count() == 0


def lattice(*nodes):
    """A lattice of nodes, each a list of (target, probability)."""
    first = np.cumsum([0] + [len(n) for n in nodes])
    edges = [e for n in nodes for e in n]
    p = np.array([x for _, x in edges])
    cum = np.concatenate([n + np.minimum(np.cumsum([x for _, x in edges[first[n] : first[n + 1]]]), 1.0) for n in range(len(nodes))])
    return first, np.array([t for t, _ in edges]), np.arange(len(edges)), p, cum


def test_the_least_mass_is_kept():
    """Segmentations of 1e-30 and less are found, each with its own probability, and none is lost."""
    tiny = 1e-30
    one = lattice([(1, 1.0), (2, tiny)], [(2, 1.0), (3, tiny)], [(3, 1.0)], [])
    paths = {(0, 2, 4): 1.0, (0, 3): tiny, (1, 4): tiny}
    for seed in range(20):
        ((found, after),) = sample_units(one, [np.array([0])], np.array([seed]), 5)
        got = {tuple(p.edges.tolist()): float(p.lp.sum()) for p in found}
        assert set(got) == set(paths) and after == -math.inf
        assert all(math.isclose(got[k], math.log(v), abs_tol=1e-9) for k, v in paths.items())
    _, mass = _unseen(one, 0, [np.array([0, 2, 4])])
    assert math.isclose(mass[0][0], 2 * tiny, rel_tol=1e-12)
    _, mass = _unseen(one, 0, [np.array([0, 2, 4]), np.array([1, 4])])
    assert math.isclose(mass[0][0], tiny, rel_tol=1e-12)
    assert _unseen(one, 0, [np.array(k) for k in paths])[1][0][0] == 0
    lp, _, path, rest = _draw_other(one, 0, np.array([3], np.uint64), [np.array([0, 2, 4]), np.array([0, 3])])
    assert path.tolist() == [1, 4] and math.isclose(lp, math.log(tiny)) and rest == 0


def test_segmentation_query(spark, sf_dir):
    """Every document of the table, with its two segmentations: distinct, of the text, with the probability that its pieces have."""
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = {}
    for r in op9_segmentation(spark, sf_dir).collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert set(rows) == set(text)
    for i, own in rows.items():
        assert all(r.round_trip for r in own) and len({r.ids_crc32 for r in own}) == len(own) == (2 if text[i] else 1)
        assert [r.value for r in own] == sorted((r.value for r in own), reverse=True) and all(r.log_prob <= 0 and r.log_inclusion <= 0 for r in own)


def total_mass(s, lattices):
    """Log of the sum over all segmentations, character by character; no piece runs across the start of a word or a line end."""
    best = [0.0] + [-math.inf] * len(s)
    for j in range(1, len(s) + 1):
        ways = []
        for i in range(max(0, j - lattices.longest), j):
            piece = s[i:j]
            if any(piece[x] == MARK and piece[x - 1] != MARK for x in range(1, len(piece))) or (len(piece) > 1 and "\n" in piece):
                continue
            if piece in lattices.pieces:
                ways.append(best[i] + math.log(lattices.pieces[piece][1]) - len(piece) * math.log(lattices.SCALE))
            elif j == i + 1:
                ways.append(best[i] + math.log(lattices.floor) * len(piece.encode()))
        top = max(ways)
        best[j] = top + math.log(sum(math.exp(w - top) for w in ways))
    return best[-1]


def test_probabilities_of_whole_documents(spark, sf_dir):
    """Each sampled segmentation has the probability that its pieces' weights give, over the sum of all segmentations."""
    lattices = Lattices(tokenizer_path(MODEL))
    weight = {i: math.log(w) - len(p) * math.log(lattices.SCALE) for p, (i, w) in lattices.pieces.items()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").where("length(text) between 1 and 1500")
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = sample_segmentations(docs, with_ids=True).collect()
    assert len(rows) == 2 * len(text) > 20
    for r in rows:
        own = sum(weight.get(i, math.log(lattices.floor)) for i in r.ids)
        assert math.isclose(r.log_prob, own - total_mass(MARK + text[r.doc_id].replace(" ", MARK), lattices), rel_tol=1e-6, abs_tol=1e-6)


def test_multi_index_query(spark, sf_dir):
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in op10_multi_index(spark, sf_dir).collect()}
    want = brute([(r.vec_id, list(r.embedding) if r.embedding is not None else None) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()])
    assert found == want


def test_recall_at_the_linking_cosine(spark):
    """Pairs just over the least cosine that links, the hardest to find, among many vectors that link with nothing."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(8000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    noise = rng.normal(size=(400, 32))
    noise -= (noise * x[:400]).sum(1)[:, None] * x[:400]
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    y = 0.9505 * x[:400] + math.sqrt(1 - 0.9505**2) * noise
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.concatenate([x, y]))], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in near_vectors(df).collect()}
    assert sum(got[8000 + i] > 0 for i in range(400)) >= 0.9 * 400 and sum(got.values()) <= 2 * 400 + 50


def test_codes_grow_with_the_vectors():
    how = MultiIndex()
    assert [_codes(n, how) for n in (0, 32, 51_282, 10**7, 10**9)] == [2, 2, 80, 1118, 11180]
    assert _codes(10**12, how) == how.most_sample // how.sample_per_code == 16_384


def test_sides_bound_every_walk():
    for rows in [1, 2, 3, 97, 4097, 10**6 + 3, 256_410, 10**9 + 7, 5 * 10**10 + 1]:
        a, b = _sides(rows)
        assert 0 <= a * b - rows <= WALKS and a < 2 * math.isqrt(rows) + 200


def test_many_equal_rows_are_sharded(spark):
    docs = spark.range(3000).selectExpr("CAST(NULL AS LONG) AS doc_id", "'same' AS text")
    rows = shard(docs, shards=7).collect()
    assert sorted(r.position for r in rows) == list(range(3000))
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_toxicity_replaces_and_keeps_columns(odd):
    out = score_toxicity(odd, (np.zeros(1 << 16, np.float32), 0.0), out="_toxicity")
    assert out.columns == odd.columns and {r._toxicity for r in out.collect()} == {0.5}


def test_stages_keep_columns_of_their_own(spark, odd, tmp_path):
    spark.createDataFrame([(i, 0, i % 2) for i in range(50, 90)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = settle(stage(spark, docs, str(tmp_path)))
        assert docs.columns == odd.columns and all(r._toxicity == r._row == r._id == "kept" for r in docs.collect())
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "3", "4", "5", "None"]


def test_hot_near_copies(spark):
    """A third of all rows are near copies of one text, each different: one stays, and no other text goes."""
    rnd = random.Random(6)
    base = [f"w{rnd.randrange(9000)}" for _ in range(300)]
    rows = []
    for i in range(400):
        words = list(base)
        for at in rnd.sample(range(300), 3):
            words[at] = f"x{rnd.random()}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"v{rnd.randrange(9000)}" for _ in range(200))) for i in range(800)]
    kept = {r.doc_id for r in corpus_pipeline.simhash(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()}
    assert kept == {0} | {1000 + i for i in range(800)}


def test_columns_with_maps(spark):
    """Rows are told apart by all their columns, those with maps too."""
    rows = [(1, "a b c d e f g", {"k": 1}, [{"x": "y"}]), (2, "a b c d e f g", {"k": 2}, None), (2, "a b c d e f g", {"k": 2}, None), (None, "a", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra map<string,int>, nested array<map<string,string>>")
    for keep in (keep_one_similar, keep_one):
        kept = keep(docs).collect()
        assert sorted((r.doc_id is None, r.doc_id, r.extra) for r in kept) == [(False, 1, {"k": 1}), (True, None, None)]
    packed = pack(token_pieces(docs).withColumn("extra", F.create_map(F.lit("k"), "length"))).collect()
    assert len(packed) == 4 and all(r.extra == {"k": r.length} for r in packed)
