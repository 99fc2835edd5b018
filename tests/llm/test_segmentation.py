import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidewell.llm import segmentation
from tidewell.llm.segmentation import MARK, MODEL, UNIT, Lattices, decode, encode, processor, sample_segmentations, segmentations
from tidewell.llm.tokens import tokenizer_path

PATH = tokenizer_path(MODEL)


def all_paths(text, lattices):
    """Every segmentation of a text with its probability, by plain recursion over characters."""
    s = MARK + text.replace(" ", MARK)

    def rest(i):
        if i == len(s):
            return [((), 0.0)]
        out = []
        for j in range(i + 1, len(s) + 1):
            piece = s[i:j]
            # A word begins at a mark that follows another character.
            if any(piece[x] == MARK and piece[x - 1] != MARK for x in range(1, len(piece))):
                break
            if piece in lattices.pieces:
                n, w = lattices.pieces[piece]
                out += [((n, *p), math.log(w) - len(piece) * math.log(lattices.SCALE) + v) for p, v in rest(j)]
            elif j == i + 1:
                raw = piece.encode()
                out += [((*(lattices.bytes[b] for b in raw), *p), math.log(lattices.floor) * len(raw) + v) for p, v in rest(j)]
        return out

    paths = rest(0)
    total = math.log(sum(math.exp(v) for _, v in paths))
    return {p: math.exp(v - total) for p, v in paths}


@pytest.mark.parametrize("text", ["of a", "é\n", "to\tb"])
def test_top_k_against_all_paths(text):
    lattices = Lattices(PATH)
    p = all_paths(text, lattices)
    runs = 3000
    got = segmentations([text] * runs, np.arange(runs), 2, lattices)
    pairs = Counter()
    weight = 0.0
    for rows in got:
        assert len({tuple(r[0]) for r in rows}) == len(rows) == min(2, len(p))
        for ids, logp, value, inclusion in rows:
            assert math.isclose(math.exp(logp), p[tuple(ids)], rel_tol=1e-9)
            weight += p[tuple(ids)] / math.exp(inclusion)
        assert [r[2] for r in rows] == sorted((r[2] for r in rows), reverse=True)
        pairs[tuple(tuple(r[0]) for r in rows)] += 1
    assert abs(weight / runs - 1) < 0.15
    for a, pa in p.items():
        for b, pb in p.items():
            if a != b and (want := pa * pb / (1 - pa)) > 1e-3:
                assert abs(pairs[a, b] / runs - want) < 5 * math.sqrt(want / runs) + 1e-3


def test_all_segmentations_without_replacement():
    lattices = Lattices(PATH)
    p = all_paths("of", lattices)
    rows = segmentations(["of"], np.array([3]), len(p) + 5, lattices)[0]
    assert {tuple(r[0]) for r in rows} == set(p) and all(r[3] == 0.0 for r in rows)


def test_units_join_to_the_text():
    for t in ["a  b\nc \n\n d", "x" * 5000, "▁u", " "]:
        assert "".join(UNIT.findall(MARK + t.replace(" ", MARK))) == MARK + t.replace(" ", MARK)


def test_operator(spark):
    texts = [None, "", "Hello  wörld\nnew line 😀", "tab\there", "word " * 4000, "Hello  wörld\nnew line 😀"]
    rows = [(i, t, 0) for i, t in enumerate(texts[:-1])] + [(2, texts[-1], 1), (None, "null id", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sample int")
    out = sample_segmentations(docs, k=3, with_ids=True).collect()
    assert all(r.round_trip for r in out) and all(r.log_inclusion <= 0 for r in out)
    assert [r.n_pieces for r in out if r.doc_id == 0] == [0]
    by = Counter((r.doc_id, r.sample, r.ids_crc32) for r in out if r.doc_id == 2)
    assert len(by) == 3 and set(by.values()) == {2}
    assert len({tuple(r.ids) for r in out if r.doc_id == 4}) == 3
    assert sample_segmentations(docs.limit(0)).count() == 0


def test_encode_and_decode(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    text = {r.doc_id: r.text for r in docs.collect()}
    ids = encode(docs)
    sp = processor(PATH)
    assert {r.doc_id: list(r.ids) for r in ids.collect()} == {i: sp.encode(t) for i, t in text.items()}
    assert {r.doc_id: r.text for r in decode(ids).collect()} == text


def test_lattices_built_together_and_alone():
    """A unit's lattice is the same whichever units are built with it; edge shares of a node sum to one, and long units stay in range."""
    units = ["▁the", "é" * 40, "\n", "▁▁", "a1😀z" * 700, "▁" + "e" * 3000]
    both = Lattices(PATH)
    starts = both.nodes(units)
    first, target, piece, p, _ = both.views()
    for unit, start in zip(units, starts):
        alone = Lattices(PATH)
        assert alone.nodes([unit])[0] == 0
        f, t, i, q, _ = alone.views()
        lo, hi = first[start], first[start + len(unit)]
        assert (piece[lo:hi] == i).all() and (target[lo:hi] == t + start).all() and np.allclose(p[lo:hi], q, rtol=1e-9)
        assert np.allclose(np.add.reduceat(q, f[:-1][: len(unit)]), 1.0)


def test_lattices_are_bounded_in_bytes(monkeypatch):
    """Unspaced texts: what is kept between parts stays under the bound and a part's own."""
    rng, lattices = random.Random(3), Lattices(tokenizer_path(MODEL))
    monkeypatch.setattr(segmentation, "MOST_BYTES", 8 << 20)
    held = []
    for n in range(12):
        texts = ["".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(2000)) for _ in range(8)] + ["".join(rng.choice("abcdefgh") for _ in range(2000)) for _ in range(8)]
        segmentation.segmentations(texts, np.arange(16), 2, lattices)
        held.append(lattices.bytes_held())
    assert max(held) < (8 << 20) + 3 * held[0]
    sizes = [1, 5, segmentation.TEXT_CHARS + 1, 1, 1]
    assert list(segmentation._parts(pa.array(["x" * s for s in sizes] + [None]))) == [(0, 2), (2, 1), (3, 3)]
    assert [n for _, n in segmentation._parts(pa.array(["a"] * 300))] == [128, 128, 44]
