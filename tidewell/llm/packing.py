"""Best-fit packing of token sequences after a Martello-Toth dominance reduction.

Lengths are whole numbers up to the capacity, so an instance of any size is a histogram of as many
counts as the capacity. The plan is made on the histogram; rows find their place by their rank within
their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.tables import row_hash, settle, table, unused
from tidewell.llm.tokens import WordTokenizer, tokenizer_path

CAPACITY = 2048
END_ID = 0
#: A length's rows are ranked in so many parts; the histogram has at most CAPACITY * PARTS counts.
PARTS = 64
#: Texts that are tokenized at once.
TEXTS = 256
TOKENIZER = "word_bpe_49k.json"


class BinPlan:
    """Placements of a histogram of lengths into bins.

    A placement (length, lo, hi, first bin, per bin, offset) puts the items lo..hi-1 of a length into
    consecutive bins, ``per bin`` in each, one behind the other from ``offset``.
    """

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.used = np.zeros(capacity + 1, np.int64)
        self.placements: list[tuple[int, int, int, int, int, int]] = []
        self.bins = 0
        while self._reduce():
            pass
        self.reduced_bins = self.bins
        self._best_fit()

    def _place(self, length: int, n: int, first_bin: int, per: int, offset: int) -> None:
        lo = int(self.used[length])
        self.placements.append((length, lo, lo + n, first_bin, per, offset))
        self.used[length] += n
        self.left[length] -= n

    def _fix(self, lengths: list[int], n: int) -> None:
        """Fix ``n`` bins that hold one item of each of ``lengths``."""
        at = 0
        for length in lengths:
            self._place(length, n, self.bins, 1, at)
            at += length
        self.bins += n

    def _reduce(self) -> bool:
        """One pass from the longest items down; whether it fixed any bin."""
        before = self.bins
        for a in range(self.capacity, 0, -1):
            while self.left[a] and (best := self._dominating(a)):
                need = {x: best.count(x) for x in best}
                n = min(int(self.left[x]) // k for x, k in need.items())
                self._fix(best, n)
        return self.bins > before

    def _dominating(self, a: int) -> list[int] | None:
        """A set with an item of length ``a`` that dominates all other feasible sets with it, of three items at most."""
        room = self.capacity - a
        rest = self.left
        rest[a] -= 1
        try:
            small = []
            for x in np.flatnonzero(rest[: room + 1])[:3]:
                small += [int(x)] * int(min(rest[x], 3))
            if not small:
                return [a]
            fits = np.flatnonzero(rest[: room + 1])
            k = int(fits[-1])
            if k == room or len(small) < 2 or small[0] + small[1] > room:
                return [a, k]
            if len(small) > 2 and sum(small[:3]) <= room:
                return None
            # Pairs fit beside a, triples don't.
            second, best_sum, l = 0, 0, 0
            for x in map(int, fits[::-1]):
                rest[x] -= 1
                ys = np.flatnonzero(rest[: min(x, room - x) + 1])
                if len(ys):
                    second, best_sum = max(second, int(ys[-1])), max(best_sum, x + int(ys[-1]))
                if x == k and len(both := np.flatnonzero(rest[: room - x + 1])):
                    l = int(both[-1])  # noqa: E741
                rest[x] += 1
            if l and l >= second:
                return [a, k, l]
            return [a, k] if k >= best_sum else None
        finally:
            rest[a] += 1

    def _best_fit(self) -> None:
        """Best-fit decreasing on what is left: bins of one residual and history stand as one run."""
        runs: dict[int, list[tuple[int, int]]] = {}
        for a in range(self.capacity, 0, -1):
            while n := int(self.left[a]):
                room = next((r for r in range(a, self.capacity) if runs.get(r)), self.capacity)
                per = room // a
                if room == self.capacity:
                    first, count = self.bins, -(-n // per)
                    self.bins += count
                else:
                    first, count = runs[room].pop()
                full = min(count, n // per)
                if full:
                    self._place(a, full * per, first, per, self.capacity - room)
                    runs.setdefault(room - full * per * a // full, []).append((first, full))
                elif n:
                    self._place(a, n, first, n, self.capacity - room)
                    runs.setdefault(room - n * a, []).append((first, 1))
                    full = 1
                if count > full:
                    if room == self.capacity:
                        self._place(a, n - full * per, first + full, max(1, n - full * per), 0)
                        runs.setdefault(room - (n - full * per) * a, []).append((first + full, 1))
                    else:
                        runs[room].append((first + full, count - full))

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """Placements sorted by (length, lo), and the sort key of each."""
        p = np.array(sorted(self.placements), np.int64).reshape(-1, 6)
        return p, (p[:, 0] << 44) | p[:, 1]


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: each document's ids and the end id, cut at ``capacity``.

    Null text is empty and still has the end id, so each row has a piece. Null and repeated ids are rows like
    any other; an empty table gives none; other columns play no part.
    """
    path = path or tokenizer_path(TOKENIZER)
    end = np.uint32(end_id).astype("<u4").tobytes()
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = WordTokenizer.load(path)
        for b in batches:
            rows = []
            found = (ids for at in range(0, len(b), TEXTS) for ids in tok.id_bytes([t or "" for t in b.column(1).slice(at, TEXTS).to_pylist()]))
            for doc_id, ids in zip(b.column(0).to_pylist(), found):
                ids += end
                rows += [(doc_id, i, at // 4, len(ids[at : at + 4 * capacity]) // 4, zlib.crc32(ids[at : at + 4 * capacity])) for i, at in enumerate(range(0, len(ids), 4 * capacity))]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)] if rows else [pa.array([], t) for t in schema.types], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(pieces: DataFrame, capacity: int = CAPACITY, parts: int = PARTS) -> DataFrame:
    """``pieces`` (with ``doc_id, piece, length``) and their ``sequence_id`` and ``offset``.

    The histogram over (length, part), of bounded size, is all that reaches the driver; parts come from a
    hash of the whole row, so that a length which a third of all rows share is ranked by many tasks. Repeated
    rows and null ids are ranked like any other; an empty table gives an empty table; columns named
    ``sequence_id`` or ``offset`` are replaced, any others stay.
    """
    pieces = settle(pieces.drop("sequence_id", "offset"))
    part_, rank_ = unused(pieces, "part", "rank")
    row = row_hash(pieces)
    part = F.pmod(row, F.lit(parts)).cast("int")
    counts = sorted((r[0], r[1], r[2]) for r in pieces.groupBy("length", part.alias("part")).count().collect())
    first, totals = np.zeros((capacity + 1, parts), np.int64), {}
    for length, p, n in counts:
        first[length, p] = totals.get(length, 0)
        totals[length] = totals.get(length, 0) + n
    plan, keys = BinPlan(totals, capacity).arrays()
    lo, bins, per, at = plan[:, 1], plan[:, 3], plan[:, 4], plan[:, 5]
    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = {n: b.column(n) for n in b.schema.names}
            length, p, n = (cols[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", part_, rank_))
            rank = first[length, p] + n - 1
            i = np.searchsorted(keys, (length << 44) | rank, side="right") - 1
            nth = rank - lo[i]
            kept = {k: v for k, v in cols.items() if k not in (part_, rank_)}
            yield pa.record_batch([*kept.values(), pa.array(bins[i] + nth // per[i]), pa.array(at[i] + nth % per[i] * length)], [*kept, "sequence_id", "offset"])

    order = Window.partitionBy("length", part_).orderBy(row, "doc_id", "piece")
    return pieces.withColumn(part_, part).withColumn(rank_, F.row_number().over(order)).mapInArrow(run, schema)


def op5_packing(spark, sf_dir: str) -> DataFrame:
    return pack(token_pieces(table(spark, sf_dir, "documents")))
