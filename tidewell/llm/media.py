"""Media columns: Matroska files written from and parsed into packet tables."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.tables import table

#: Element ids of the Matroska specification.
EBML, SEGMENT, INFO, TRACKS, CLUSTER, CUES = 0x1A45DFA3, 0x18538067, 0x1549A966, 0x1654AE6B, 0x1F43B675, 0x1C53BB6B
TIMESTAMP_SCALE, TRACK_ENTRY, TRACK_NUMBER, TRACK_TYPE, CODEC_ID = 0x2AD7B1, 0xAE, 0xD7, 0x83, 0x86
TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, REFERENCE = 0xE7, 0xA3, 0xA0, 0xA1, 0xFB
DEFAULT_DURATION, CUE_POINT, CUE_TIME, CUE_POSITIONS, CUE_TRACK, CUE_CLUSTER = 0x23E383, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
XIPH, FIXED, EBML_LACE = 1, 2, 3
TOP_LEVEL = {INFO, TRACKS, CLUSTER, CUES, 0x114D9B74, 0x1043A770, 0x1254C367, 0x1941A469}

#: 8-bit mono samples in frames of 4 ms; so many frames to a laced block and blocks to a cluster.
FRAME = 192
RATE = 48_000
FRAME_MS = 4
LACE = 8
BLOCKS = 32


def size_vint(n: int) -> bytes:
    """A size as a variable-length number; all bits set means unknown, so it is never a size."""
    length = next(k for k in range(1, 9) if n < (1 << 7 * k) - 1)
    return (n | 1 << 7 * length).to_bytes(length, "big")


def element(eid: int, body: bytes) -> bytes:
    return eid.to_bytes((eid.bit_length() + 7) // 8, "big") + size_vint(len(body)) + body


def number(eid: int, n: int) -> bytes:
    return element(eid, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def _laced(frames: list[bytes], kind: int) -> bytes:
    sizes = [len(f) for f in frames]
    head = bytes([len(frames) - 1])
    if kind == XIPH:
        head += b"".join(b"\xff" * (n // 255) + bytes([n % 255]) for n in sizes[:-1])
    elif kind == EBML_LACE:
        head += size_vint(sizes[0])
        for a, b in zip(sizes, sizes[1:-1]):
            d = b - a
            length = next(k for k in range(1, 9) if abs(d) < (1 << 7 * k - 1))
            head += (d + (1 << 7 * length - 1) - 1 | 1 << 7 * length).to_bytes(length, "big")
    return head + b"".join(frames)


HEAD = element(EBML, number(0x4286, 1) + number(0x42F7, 1) + number(0x42F2, 4) + number(0x42F3, 8) + element(0x4282, b"matroska") + number(0x4287, 4) + number(0x4285, 2))
SETUP = element(INFO, number(TIMESTAMP_SCALE, 1_000_000) + element(0x4D80, b"tidewell") + element(0x5741, b"tidewell")) + element(
    TRACKS, element(TRACK_ENTRY, number(TRACK_NUMBER, 1) + number(0x73C5, 1) + number(TRACK_TYPE, 2) + number(0x9C, 1) + number(DEFAULT_DURATION, FRAME_MS * 1_000_000)
                    + element(CODEC_ID, b"A_PCM/INT/LIT") + element(0xE1, element(0xB5, struct.pack(">d", RATE)) + number(0x9F, 1) + number(0x6264, 8))))


def write_matroska(samples: bytes, frame: int = FRAME) -> bytes:
    """One audio track of 8-bit samples; the kinds of lacing take turns over the blocks."""
    frames = [samples[i : i + frame] for i in range(0, len(samples), frame)]
    body, cues, pos, kinds = [SETUP], [], len(SETUP), (FIXED, EBML_LACE, XIPH)
    for first in range(0, len(frames), LACE * BLOCKS):
        blocks = [number(TIMESTAMP, first * FRAME_MS)]
        for i in range(first, min(first + LACE * BLOCKS, len(frames)), LACE):
            group = frames[i : i + LACE]
            kind = kinds[i // LACE % 3] if len(group) > 1 else 0
            data = _laced(group, kind) if kind else group[0]
            blocks.append(element(SIMPLE_BLOCK, b"\x81" + struct.pack(">hB", (i - first) * FRAME_MS, 0x80 | kind << 1) + data))
        cues.append(element(CUE_POINT, number(CUE_TIME, first * FRAME_MS) + element(CUE_POSITIONS, number(CUE_TRACK, 1) + number(CUE_CLUSTER, pos))))
        body.append(element(CLUSTER, b"".join(blocks)))
        pos += len(body[-1])
    return HEAD + element(SEGMENT, b"".join(body) + element(CUES, b"".join(cues)))


def _vint(b: bytes, at: int, keep: bool) -> tuple[int, int]:
    """(value, place behind it) of a variable-length number; ids keep the length marker. Unknown sizes are -1."""
    first = b[at]
    length = 9 - first.bit_length()
    if not first or at + length > len(b):
        raise ValueError("broken EBML number")
    n = int.from_bytes(b[at : at + length], "big")
    if not keep:
        n &= (1 << 7 * length) - 1
        n = -1 if n == (1 << 7 * length) - 1 else n
    return n, at + length


def _elements(b: bytes, at: int, end: int) -> Iterator[tuple[int, int, int]]:
    """(id, start, end) of the elements of a body; one of unknown size ends where the next of its level begins."""
    while at < end:
        eid, at = _vint(b, at, True)
        size, at = _vint(b, at, False)
        stop = at + size
        if size < 0:
            stop = end if eid != CLUSTER else _cluster_end(b, at, end)
        if stop > end:
            raise ValueError("an element goes on beyond its parent")
        yield eid, at, stop
        at = stop


def _cluster_end(b: bytes, at: int, end: int) -> int:
    while at < end:
        eid, body = _vint(b, at, True)
        if eid in TOP_LEVEL:
            return at
        size, body = _vint(b, body, False)
        at = body + size
    return end


def _uint(b: bytes, span: tuple[int, int]) -> int:
    return int.from_bytes(b[span[0] : span[1]], "big")


def _frames(b: bytes, at: int, end: int, lacing: int) -> list[tuple[int, int]]:
    """(offset, size) of each frame of a block."""
    if not lacing:
        return [(at, end - at)]
    n, at = b[at] + 1, at + 1
    sizes = []
    if lacing == FIXED:
        if (end - at) % n:
            raise ValueError("uneven fixed lacing")
        sizes = [(end - at) // n] * (n - 1)
    elif lacing == XIPH:
        for _ in range(n - 1):
            size = 0
            while b[at] == 255:
                size, at = size + 255, at + 1
            sizes.append(size + b[at])
            at += 1
    else:
        for i in range(n - 1):
            size, after = _vint(b, at, False)
            sizes.append(sizes[-1] + size - ((1 << 7 * (after - at) - 1) - 1) if i else size)
            at = after
    last = end - at - sum(sizes)
    if last < 0 or min(sizes, default=0) < 0:
        raise ValueError("lacing beyond its block")
    out = []
    for size in [*sizes, last]:
        out.append((at, size))
        at += size
    return out


def parse_matroska(b: bytes) -> tuple[dict[int, str], list[tuple[int, int, int, int, bool]], list[tuple[int, int, int]]]:
    """Codec of each track, packets ``(track, timestamp_ns, offset, size, keyframe)`` and cues ``(time, track, cluster position)``.

    Offsets are those of the file, cue positions those of the segment's body. Raises ValueError on what is no Matroska file.
    """
    tracks, durations, packets, cues, scale = {}, {}, [], [], 1_000_000
    top = list(_elements(b, 0, len(b)))
    if not top or top[0][0] != EBML:
        raise ValueError("no EBML header")
    for _, lo, hi in (x for x in top if x[0] == SEGMENT):
        for eid, at, end in _elements(b, lo, hi):
            if eid == INFO:
                scale = next((_uint(b, s) for i, *s in _elements(b, at, end) if i == TIMESTAMP_SCALE), scale)
            elif eid == TRACKS:
                for _, s, e in (x for x in _elements(b, at, end) if x[0] == TRACK_ENTRY):
                    found = {i: (x, y) for i, x, y in _elements(b, s, e)}
                    n = _uint(b, found[TRACK_NUMBER])
                    x, y = found.get(CODEC_ID, (0, 0))
                    tracks[n], durations[n] = b[x:y].decode("ascii", "replace"), _uint(b, found.get(DEFAULT_DURATION, (0, 0)))
            elif eid == CLUSTER:
                base = 0
                for i, s, e in _elements(b, at, end):
                    block, key = (s, e) if i == SIMPLE_BLOCK else None, None
                    if i == TIMESTAMP:
                        base = _uint(b, (s, e))
                    elif i == BLOCK_GROUP:
                        group = {x: (y, z) for x, y, z in _elements(b, s, e)}
                        block, key = group.get(BLOCK), REFERENCE not in group
                    if block:
                        track, p = _vint(b, block[0], False)
                        delta, flags = struct.unpack_from(">hB", b, p)
                        step = durations.get(track, 0)
                        for k, (offset, size) in enumerate(_frames(b, p + 3, block[1], flags >> 1 & 3)):
                            packets.append((track, (base + delta) * scale + k * step, offset, size, bool(flags & 0x80) if key is None else key))
            elif eid == CUES:
                for _, s, e in (x for x in _elements(b, at, end) if x[0] == CUE_POINT):
                    point = list(_elements(b, s, e))
                    time = next((_uint(b, x) for i, *x in point if i == CUE_TIME), 0)
                    for _, x, y in (z for z in point if z[0] == CUE_POSITIONS):
                        own = {i: _uint(b, p) for i, *p in _elements(b, x, y)}
                        cues.append((time * scale, own.get(CUE_TRACK, 0), own.get(CUE_CLUSTER, 0)))
    return tracks, packets, cues


PACKETS = "tracks map<int,string>, packets array<struct<track:int,timestamp_ns:long,offset:long,size:long,keyframe:boolean>>, cues array<struct<time_ns:long,track:int,position:long>>, error string"


def packet_table(media: DataFrame, id_col: str, content_col: str = "content") -> DataFrame:
    """One row per file: its id, ``tracks``, ``packets``, ``cues`` and ``error``.

    Null content gives nulls; a broken file gives empty lists and the error. ``explode(packets)`` is the
    packet table; byte ranges point into the content.
    """
    kind = media.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("track", "timestamp_ns", "offset", "size", "keyframe"), ("time_ns", "track", "position")
        for b in batches:
            rows = []
            for content in b.column(1):
                if (raw := content.as_py()) is None:
                    rows.append((None, None, None, None))
                    continue
                try:
                    tracks, packets, cues = parse_matroska(raw)
                    rows.append((list(tracks.items()), [dict(zip(names[0], p)) for p in packets], [dict(zip(names[1], c)) for c in cues], None))
                except (ValueError, IndexError, KeyError, struct.error) as e:
                    rows.append(([], [], [], str(e) or "broken file"))
            p = pa.list_(pa.struct([("track", pa.int32()), ("timestamp_ns", pa.int64()), ("offset", pa.int64()), ("size", pa.int64()), ("keyframe", pa.bool_())]))
            c = pa.list_(pa.struct([("time_ns", pa.int64()), ("track", pa.int32()), ("position", pa.int64())]))
            cols = list(zip(*rows)) or [()] * 4
            yield pa.record_batch([b.column(0), *(pa.array(v, t) for v, t in zip(cols, (pa.map_(pa.int32(), pa.string()), p, c, pa.string())))], [id_col, "tracks", "packets", "cues", "error"])

    return media.select(id_col, content_col).mapInArrow(run, f"`{id_col}` {kind}, {PACKETS}")


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frame: int = FRAME) -> DataFrame:
    """``doc_id, n_bytes, content``: each text's UTF-8, spaces up to a positive multiple of ``frame``, as a file of 8-bit samples.

    Null text is empty and so one frame of spaces; null and repeated ids are rows like any other; an empty
    table gives an empty table; other columns play no part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.slice(at, 256)
                raw = [(t or "").encode("utf-8", "surrogatepass") for t in part.column(1).to_pylist()]
                media = [write_matroska(x + b" " * (-len(x) % frame if x else frame), frame) for x in raw]
                yield pa.record_batch([part.column(0), pa.array(map(len, raw), pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "content"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_bytes long, content binary")


def sample_features(media: DataFrame) -> DataFrame:
    """Digests of stored 8-bit media ``(doc_id, n_bytes, content)``: the payload is put together from the packets' byte ranges.

    Null content has null digests, and so has content that is no Matroska file; a file without packets has
    an empty payload. Repeated rows are each read; an empty table gives an empty table.
    """
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def features(raw: bytes | None) -> tuple:
        try:
            tracks, packets, cues = parse_matroska(raw or b"")
        except (ValueError, IndexError, KeyError, struct.error):
            return (None,) * 6
        payload = b"".join([raw[p[2] : p[2] + p[3]] for p in packets])
        x = np.frombuffer(payload, np.uint8).astype(np.int64)
        end_ms = (packets[-1][1] // 1_000_000 + FRAME_MS) if packets else 0
        words = f"codec={tracks.get(1, '')};packets={len(packets)};ms={end_ms};cues={len(cues)};sum={int(x.sum())};power={int((x * x).sum())};turns={int((np.diff(x) != 0).sum())}"
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(raw), hashlib.sha256(raw).hexdigest(), words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [features(c.as_py()) for c in b.column(2)]
            cols = list(zip(*rows)) or [()] * 6
            yield pa.record_batch([b.column(0), b.column(1), *(pa.array(v, t) for v, t in zip(cols, types[2:]))], names)

    return media.select("doc_id", "n_bytes", "content").mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op8_matroska(spark, sf_dir: str) -> DataFrame:
    return sample_features(store_texts(table(spark, sf_dir, "documents")))
