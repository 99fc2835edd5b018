import hashlib
import zlib

import pytest

from tidewell.llm.media import (BLOCK, BLOCK_GROUP, CLUSTER, EBML_LACE, FIXED, HEAD, SEGMENT, SETUP, SIMPLE_BLOCK, TIMESTAMP, XIPH, _laced, element, number, op8_matroska,
                                packet_table, parse_matroska, size_vint, write_matroska)


@pytest.mark.parametrize("n", [0, 1, 126, 127, 128, 16382, 16383, 2**21 - 2, 2**28, 2**35])
def test_sizes(n):
    raw = size_vint(n)
    length = 9 - raw[0].bit_length()
    assert len(raw) == length and int.from_bytes(raw, "big") & (1 << 7 * length) - 1 == n


@pytest.mark.parametrize("size", [192, 384, 192 * 9, 192 * 255, 192 * 256, 192 * 257, 192 * 1000])
def test_round_trip(size):
    payload = bytes(i * 7 % 256 for i in range(size))
    raw = write_matroska(payload)
    tracks, packets, cues = parse_matroska(raw)
    assert tracks == {1: "A_PCM/INT/LIT"} and b"".join(raw[o : o + n] for _, _, o, n, _ in packets) == payload
    assert [t for _, t, *_ in packets] == [i * 4_000_000 for i in range(size // 192)]
    body = raw.index(SEGMENT.to_bytes(4, "big"))
    start = raw.index(SETUP)
    assert body < start and len(cues) == -(-size // (192 * 256))
    assert all(raw[start + pos : start + pos + 4] == CLUSTER.to_bytes(4, "big") for *_, pos in cues)


@pytest.mark.parametrize("kind", [XIPH, EBML_LACE])
def test_lacing_of_uneven_frames(kind):
    frames = [b"a" * n for n in (3, 255, 0, 700, 70, 5000, 1)]
    block = b"\x81\x00\x05" + bytes([0x80 | kind << 1]) + _laced(frames, kind)
    group = b"\x81\xff\xff\x00xyz"
    # A segment and a cluster of unknown size, a block group with a negative time, and a delta frame.
    cluster = CLUSTER.to_bytes(4, "big") + b"\xff" + number(TIMESTAMP, 100) + element(SIMPLE_BLOCK, block) + element(BLOCK_GROUP, element(BLOCK, group) + element(0xFB, b"\x01"))
    raw = HEAD + SEGMENT.to_bytes(4, "big") + b"\x01" + b"\xff" * 7 + SETUP + cluster + element(CLUSTER, number(TIMESTAMP, 300) + element(SIMPLE_BLOCK, b"\x81\x00\x00\x80zz"))
    _, packets, _ = parse_matroska(raw)
    assert [p[3] for p in packets] == [len(f) for f in frames] + [3, 2]
    assert [raw[p[2] : p[2] + p[3]] for p in packets[-2:]] == [b"xyz", b"zz"]
    assert [p[1] // 1_000_000 for p in packets] == [105 + 4 * i for i in range(7)] + [99, 300] and [p[4] for p in packets[-2:]] == [False, True]


def test_packet_table_edge_rows(spark):
    good = write_matroska(b"x" * 192 * 20)
    files = spark.createDataFrame([(1, good, "a"), (1, good, "a"), (2, None, "b"), (3, b"", "c"), (4, b"not matroska", "d"), (5, good[:-9], "e")], "id long, content binary, error string")
    rows = sorted(packet_table(files, "id").collect(), key=lambda r: r.id)
    assert [len(r.packets) if r.packets is not None else None for r in rows] == [20, 20, None, 0, 0, 0]
    assert [r.error is None for r in rows] == [True, True, True, False, False, False]
    assert fixed_lacing_divides() and packet_table(files.limit(0), "id").count() == 0


def fixed_lacing_divides():
    raw = HEAD + element(SEGMENT, SETUP + element(CLUSTER, element(SIMPLE_BLOCK, b"\x81\x00\x00" + bytes([0x80 | FIXED << 1]) + b"\x01abc")))
    with pytest.raises(ValueError):
        parse_matroska(raw)
    return True


def test_query(spark, sf_dir):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op8_matroska(spark, sf_dir).collect()
    assert len(rows) == len(text)
    for r in rows:
        raw = text[r.doc_id].encode()
        payload = raw + b" " * (-len(raw) % 192 if raw else 192)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        media = write_matroska(payload)
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest()) and f"packets={len(payload) // 192};" in r.feature
