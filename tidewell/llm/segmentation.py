"""SentencePiece encoding, decoding and sampled segmentations without replacement.

Pieces never run across the start of a word, so the lattice of a text is a row of small lattices, one per
unit (a word with the marks before it, or a line end), and a segmentation's probability is the product of
those of its units. Sampling k segmentations without replacement is Gumbel top-k over all paths: each path
has its log-probability plus Gumbel noise, and the k largest are wanted. The search is best-first from the
top (A* with the maximum of a subtree's noise as its exact bound): the largest value of a set of paths is
drawn from the set's total mass; the path that attains it is drawn unit by unit; and at each unit the paths
that turn off there form a new set, whose own maximum is drawn under the known bound and queued.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.tables import table
from tidewell.llm.tokens import tokenizer_path

MODEL = "piece_bpe_32k.model"
SAMPLES = 2
#: Sharpness of the pieces' weights; texts, and about how many characters of them, that are sampled at once; bytes of lattices that are
#: kept from one such part to the next; characters whose lattices are built at once.
ALPHA = 1.0
TEXTS = 128
TEXT_CHARS = 1 << 20
MOST_BYTES = 256 << 20
MOST_CHARS = 1 << 17
MARK = "▁"
UNIT = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


@lru_cache(maxsize=2)
def processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words: random bits from counters."""
    x = x.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _uniform(seed: np.ndarray, n) -> np.ndarray:
    """Numbers in (0, 1) for pairs of a seed and a counter."""
    bits = _mix(seed + np.asarray(n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return ((bits >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


def _below(phi: np.ndarray, bound, u: np.ndarray) -> np.ndarray:
    """Gumbel values at ``phi``, given that they are at most ``bound``; -inf where there is no mass."""
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        out = phi - np.log(np.exp(np.minimum(phi - bound, 700.0)) - np.log(u))
    return np.where(np.isneginf(phi), -np.inf, np.minimum(out, bound))


class _Roots(dict):
    """Start nodes by unit; one that is missing is made."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, unit: str) -> int:
        base = self[unit] = self.make(unit)
        return base


class Lattices:
    """Piece lattices of units, flat: node n has the edges first[n]..first[n+1]-1; a unit's last node has none.

    A piece weighs ``(rank + 2) ** -alpha``; a character that is no piece is spelt in byte pieces, each
    with the weight of the last rank. Edges hold their probability given their node, from backward sums.
    """

    #: All paths from a node spell the same characters, so a factor for each character changes no probability.
    SCALE = 64.0

    def __init__(self, path: str, alpha: float = ALPHA):
        sp = processor(path)
        n = sp.get_piece_size()
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.floor = (n + 2.0) ** -alpha
        weight = lambda i, p: (min(n, -sp.get_score(i)) + 2) ** -alpha * self.SCALE ** len(p)
        named = ((i, sp.id_to_piece(i)) for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)))
        self.pieces = {p: (i, weight(i, p)) for i, p in named}
        self.longest = max(map(len, self.pieces))
        # A trie over the pieces' prefixes: state 0 is a dead end and 1 the root; a step is found by its state and character.
        states = {"": 1} | {q: k for k, q in enumerate(sorted({p[:k] for p in self.pieces for k in range(1, len(p) + 1)}), 2)}
        chars = sorted(set().union(*self.pieces))
        self.code = np.zeros(0x110000, np.int64)
        self.code[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.width = len(chars) + 1
        steps = np.array([(states[q[:-1]] * self.width + self.code[ord(q[-1])], k) for q, k in states.items() if q])
        steps = steps[steps[:, 0].argsort()]
        self.step, self.state = np.ascontiguousarray(steps[:, 0]), np.ascontiguousarray(steps[:, 1])
        # The step from the root by character.
        self.begin = np.zeros(self.width, np.int64)
        at_root = self.step // self.width == 1
        self.begin[self.step[at_root] % self.width] = self.state[at_root]
        self.id, self.weight = np.full(len(states) + 1, -1, np.int64), np.zeros(len(states) + 1)
        for p, (i, w) in self.pieces.items():
            self.id[states[p]], self.weight[states[p]] = i, w
        self.byte_ids = np.array([self.bytes[x] for x in range(128)])
        self.clear()

    @staticmethod
    @lru_cache(maxsize=2)
    def load(path: str) -> Lattices:
        return Lattices(path)

    def clear(self) -> None:
        self.root = _Roots(self.add)
        self.first, self.target, self.piece, self.p, self.cum = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        self.size, self.edges, self.filled = 0, 0, 1
        self.new: list[str] = []

    def bytes_held(self) -> int:
        """Bytes of the lattices, and about those of the units' names."""
        return sum(x.nbytes for x in (self.first, self.target, self.piece, self.p, self.cum)) + 4 * self.size + 200 * len(self.root)

    def add(self, unit: str) -> int:
        """Node at the start of a unit's lattice, which the next ``views`` builds."""
        base = self.size
        self.size += len(unit) + 1
        self.new.append(unit)
        return base

    def nodes(self, units: list[str]) -> np.ndarray:
        return np.fromiter(map(self.root.__getitem__, units), np.int64, len(units))

    def _pieces(self, chars: np.ndarray, left: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(place, piece, weight) of all pieces of one character, of two, and so on; ``left`` characters are before the unit's end."""
        code, at, found = self.code[chars], np.arange(len(chars)), []
        state = self.begin[code]
        for size in range(1, self.longest + 1):
            if size > 1:
                want = state * self.width + code[at + (size - 1)]
                k = np.minimum(np.searchsorted(self.step, want), len(self.step) - 1)
                state = np.where(self.step[k] == want, self.state[k], 0)
            piece, weight = self.id[state], self.weight[state]
            if size == 1:
                spelt = self.floor ** (1.0 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)) * self.SCALE
                weight = np.where(piece < 0, spelt, weight)
                piece = np.where(piece < 0, np.where(chars < 128, self.byte_ids[chars & 127], -chars), piece)
                found.append((at, piece, weight))
            else:
                hit = piece >= 0
                found.append((at[hit], piece[hit], weight[hit]))
            going = (state > 0) & (left[at] > size)
            at, state = at[going], state[going]
            if not len(at):
                break
        return found

    def _build(self, units: list[str]) -> tuple[np.ndarray, ...]:
        """(edges by node, target, piece, p) of the lattices of ``units``, nodes counted from 0; characters are counted over all units."""
        length = np.array([len(u) for u in units], np.int64)
        chars = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        unit = np.repeat(np.arange(len(units)), length)
        node = np.arange(len(chars)) + unit
        left = np.cumsum(length)[unit] - np.arange(len(chars))
        found = self._pieces(chars, left)
        count = np.bincount(np.concatenate([x for x, _, _ in found]), minlength=len(chars))
        place = np.cumsum(count)
        target, piece, weight = np.zeros(place[-1], np.int64), np.zeros(place[-1], np.int64), np.zeros(place[-1])
        # The longest piece is likeliest as a rule, and so the first that a draw looks at.
        for size, (at, i, w) in enumerate(found, 1):
            place[at] -= 1
            slot = place[at]
            target[slot], piece[slot], weight[slot] = node[at] + size, i, w
        # Backward sums from the ends of all units at once: characters and edges by their distance from there.
        far = left.astype(np.uint16 if left.max() < 1 << 16 else np.int64)
        by, edge = np.argsort(far, kind="stable"), np.argsort(np.repeat(far, count), kind="stable")
        own, ends, share = count[by], target[edge], weight[edge]
        start = np.r_[0, np.cumsum(own)]
        bounds = np.cumsum(np.bincount(left)).tolist()
        edge_bounds = start[bounds].tolist()
        source, beta = node[by], np.ones(len(chars) + len(units))
        for d in range(1, len(bounds)):
            lo, hi, a, b = bounds[d - 1], bounds[d], edge_bounds[d - 1], edge_bounds[d]
            mass = share[a:b] * beta[ends[a:b]]
            total = np.add.reduceat(mass, start[lo:hi] - a)
            share[a:b] = mass / np.repeat(total, own[lo:hi])
            beta[source[lo:hi]] = total
            odd = np.flatnonzero((total < 1e-100) | (total > 1e100))
            if len(odd):
                beta[source[lo:hi][odd, None] + np.arange(min(d, self.longest) + 1)] /= total[odd, None]
        p = np.empty(len(share))
        p[edge] = share
        edges = np.zeros(len(beta), np.int64)
        edges[node] = count
        return edges, target, piece, p

    def views(self) -> tuple[np.ndarray, ...]:
        """(first, target, piece, p, cum) of all lattices; ``cum`` rises from n to n + 1 over the edges of node n."""
        new, self.new = self.new, []
        lo = 0
        while lo < len(new):
            hi, chars = lo + 1, len(new[lo])
            while hi < len(new) and chars + len(new[hi]) <= MOST_CHARS:
                chars += len(new[hi])
                hi += 1
            count, target, piece, p = self._build(new[lo:hi])
            lo = hi
            node = np.repeat(np.arange(len(count)), count)
            total = np.cumsum(p)
            before = np.r_[0.0, total][np.cumsum(count) - count]
            cum = node + np.minimum(total - before[node], 1.0)
            cum[(np.cumsum(count) - 1)[count > 0]] = np.flatnonzero(count > 0) + 1.0
            old, edges = self.filled - 1, self.edges
            self.first = _put(self.first, self.filled, edges + np.cumsum(count))
            self.target, self.piece = _put(self.target, edges, old + target), _put(self.piece, edges, piece)
            self.p, self.cum = _put(self.p, edges, p), _put(self.cum, edges, old + cum)
            self.filled, self.edges = self.filled + len(count), edges + len(p)
        return self.first[: self.filled], *(x[: self.edges] for x in (self.target, self.piece, self.p, self.cum))


def _put(into: np.ndarray, at: int, new: np.ndarray) -> np.ndarray:
    """``into`` with ``new`` from place ``at``; it doubles when full, so that each value is copied a few times in all."""
    if at + len(new) > len(into):
        into = np.concatenate([into[:at], np.zeros(max(at, len(new)) + len(new), into.dtype)])
    into[at : at + len(new)] = new
    return into


def _draw(lattice: tuple, start: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """A path through each lattice, all one step at a time: (log-probability, hash, pieces) and the steps taken."""
    first, target, _, p, cum = lattice
    lp, code, count = np.zeros(len(start)), np.zeros(len(start), np.uint64), np.zeros(len(start), np.int64)
    at, live, node, steps = 0, np.arange(len(start)), start, []
    while len(live):
        e, u = first[node], node + _uniform(seed[live], at)
        over = np.flatnonzero(cum[e] < u)
        while len(over):
            e[over] += 1
            over = over[cum[e[over]] < u[over]]
        lp[live] += np.log(p[e])
        code[live] = code[live] * np.uint64(0x100000001B3) + (e - first[node] + 1).astype(np.uint64)
        count[live] += 1
        steps.append((live, e))
        node = target[e]
        going = first[node + 1] > first[node]
        live, node, at = live[going], node[going], at + 1
    return lp, code, count, steps


def _unseen(lattice: tuple, node: int, seen: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """What the paths ``seen`` from one node leave: (lead, mass), each by path and depth.

    ``lead`` is the first of ``seen`` with the same edges up to that depth; ``mass`` the probability, given
    that beginning, of all paths that are none of ``seen``. Sums of positive terms from the ends on, never
    differences from 1, so that the least mass keeps its precision.
    """
    first, target, _, share, _ = lattice
    lead, mass = [], [np.zeros(len(x) + 1) for x in seen]
    if len(seen) == 1:
        x, left = seen[0].tolist(), 0.0
        for d in range(len(x) - 1, -1, -1):
            at = int(target[x[d - 1]]) if d else node
            lo = int(first[at])
            p = share[lo : int(first[at + 1])].tolist()
            own = p.pop(x[d] - lo)
            mass[0][d] = left = sum(p) + own * left
        return [np.zeros(len(x) + 1, np.int64)], mass
    for j, x in enumerate(seen):
        own = np.full(len(x) + 1, j)
        for i in range(j - 1, -1, -1):
            n = min(len(x), len(seen[i]))
            differ = np.flatnonzero(seen[i][:n] != x[:n])
            own[: (differ[0] if len(differ) else n) + 1] = i
        lead.append(own)
    for d in range(max(map(len, seen)) - 1, -1, -1):
        nexts: dict[int, dict[int, int]] = {}
        for j, x in enumerate(seen):
            if len(x) > d:
                nexts.setdefault(int(lead[j][d]), {})[int(x[d])] = int(lead[j][d + 1])
        for j, taken in nexts.items():
            at = target[seen[j][d - 1]] if d else node
            lo, hi = int(first[at]), int(first[at + 1])
            p = share[lo:hi].tolist()
            for e, i in taken.items():
                p[e - lo] *= mass[i][d + 1]
            mass[j][d] = sum(p)
    return lead, mass


def _draw_other(lattice: tuple, node: int, seed: np.ndarray, seen: list[np.ndarray]) -> tuple[float, int, np.ndarray, float]:
    """A path through one lattice that is none of ``seen``, and the mass that it and they leave: at each node, an edge of these counts with what they leave behind it."""
    first, target, _, share, _ = lattice
    lead, mass = _unseen(lattice, node, seen)
    start, path, lp, code, left = node, [], 0.0, 0, list(range(len(seen)))
    while (lo := first[node]) < (hi := first[node + 1]):
        d = len(path)
        p = share[lo:hi].copy()
        for j in left:
            e = seen[j][d]
            p[e - lo] = share[e] * mass[lead[j][d + 1]][d + 1]
        steps = p.cumsum()
        e = int(lo + np.searchsorted(steps, _uniform(seed, d)[0] * steps[-1]))
        left = [j for j in left if seen[j][d] == e]
        path.append(e)
        lp += math.log(share[e])
        code = (code * 0x100000001B3 + e - int(lo) + 1) % (1 << 64)
        node = target[e]
    path, all_ = np.array(path), float(mass[0][0])
    rest = all_ - math.exp(lp)
    if rest < 1e-6 * all_:  # the difference has lost its digits
        rest = float(_unseen(lattice, start, [*seen, path])[1][0][0])
    return lp, code, path, rest


def _edges(count: np.ndarray, steps: list) -> np.ndarray:
    """The edges of all paths, path by path."""
    offset = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), np.int64)
    for k, (live, e) in enumerate(steps):
        out[offset[live] + k] = e
    return out


class _Path:
    """One sampled segmentation: its value, and by unit the log-probability, hash, number of edges and turn-off maxima."""

    def __init__(self, value, lp, code, count, edges, maxima, seen):
        self.value, self.lp, self.code, self.count, self.edges, self.maxima, self.seen = value, lp, code, count, edges, maxima, seen

    def unit(self, i: int) -> tuple[float, np.ndarray]:
        """Log-probability and edges of one unit."""
        at = int(self.count[:i].sum())
        return float(self.lp[i]), self.edges[at : at + int(self.count[i])]


def sample_units(lattice: tuple, starts: list[np.ndarray], keys: np.ndarray, k: int) -> list[tuple[list[_Path], float]]:
    """For each text (the start nodes of its units, and its key): up to ``k`` distinct paths, best value first, and the next value.

    A text with fewer segmentations has them all, and -inf next.
    """
    seeds = _mix(keys.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
    found: list[list[_Path]] = [[] for _ in starts]
    after = [-math.inf] * len(starts)
    todo = [(d, None, 0, float(-np.log(-np.log(_uniform(seeds[d : d + 1], 0)))[0])) for d in range(len(starts))]
    for r in range(1, k + 1):
        tails = [np.arange(i, len(starts[d])) for d, _, i, _ in todo]
        at = np.concatenate([starts[d][t] for (d, *_), t in zip(todo, tails)]) if todo else np.zeros(0, np.int64)
        texts = np.array([d for d, *_ in todo], np.int64)
        unit_seed = _mix(np.repeat(seeds[texts] + np.uint64(r << 40), [len(t) for t in tails]) + np.concatenate(tails or [texts]).astype(np.uint64))
        lp, code, count, steps = _draw(lattice, at, unit_seed)
        edges = _edges(count, steps)
        place = np.cumsum([0, *map(len, tails)])
        edge_place = np.r_[0, np.cumsum(count)][place]
        units = np.array([len(starts[d]) for d in texts], np.int64)
        unit_place = np.r_[0, np.cumsum(units)]
        u = _uniform(np.repeat(seeds[texts], units), ((np.arange(unit_place[-1]) - np.repeat(unit_place[:-1], units)) << 8) + r)
        phis = []
        for n, (d, p, i, value) in enumerate(todo):
            lo, hi = place[n], place[n + 1]
            own_lp, own_code, own_count, own_edges = lp[lo:hi], code[lo:hi], count[lo:hi], edges[edge_place[n] : edge_place[n + 1]]
            seen = {}
            if p is not None:
                # Where a path turns off, it is drawn from what the others at this unit have left.
                one = _draw_other(lattice, int(at[lo]), unit_seed[lo : lo + 1], [e for _, e in p.seen[i].values()])
                done = int(p.count[:i].sum())
                seen[i] = p.seen[i] | {one[1]: (one[0], one[2])}
                own_edges = np.concatenate([p.edges[:done], one[2], own_edges[own_count[0] :]])
                own_lp, own_code = np.r_[p.lp[:i], one[0], own_lp[1:]], np.concatenate([p.code[:i], np.array([one[1]], np.uint64), own_code[1:]])
                own_count = np.r_[p.count[:i], len(one[2]), own_count[1:]]
            before = np.cumsum(own_lp) - own_lp
            rest = -np.expm1(np.minimum(own_lp, 0.0))
            sure = np.flatnonzero(rest < 1e-9)
            if len(sure):
                nodes = starts[d][sure]
                rest[sure] = 0  # right for a unit with a single path
                for j in sure[(lattice[0][nodes + 1] - lattice[0][nodes] > 1) | (own_count[sure] > 1)].tolist():
                    # So near to certain that one minus it has lost its digits.
                    end = int(own_count[: j + 1].sum())
                    rest[j] = _unseen(lattice, int(starts[d][j]), [own_edges[end - int(own_count[j]) : end]])[1][0][0]
            if p is not None:
                rest[:i] = 0
                rest[i] = one[3]
            phis.append((before, rest))
            found[d].append(_Path(value, own_lp, own_code, own_count, own_edges, None, seen))
        if todo:
            with np.errstate(divide="ignore"):
                phi = np.concatenate([x for x, _ in phis]) + np.log(np.concatenate([x for _, x in phis]))
            maxima = _below(phi, np.repeat([value for *_, value in todo], units), u)
            for n, d in enumerate(texts):
                found[d][-1].maxima = maxima[unit_place[n] : unit_place[n + 1]]
        todo = []
        for d, paths in enumerate(found):
            if len(paths) < r:
                continue
            best = max(paths, key=lambda x: x.maxima.max(initial=-math.inf))
            value = float(best.maxima.max(initial=-math.inf))
            after[d] = value
            if r < k and value > -math.inf:
                i = int(best.maxima.argmax())
                best.maxima[i] = -np.inf
                best.seen.setdefault(i, {int(best.code[i]): best.unit(i)})
                todo.append((d, best, i, value))
    return list(zip(found, after))


def segmentations(texts: list[str], keys: np.ndarray, k: int, lattices: Lattices) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text: (ids, log-probability, perturbed value, log inclusion probability) of ``k`` distinct segmentations.

    The inclusion probability is that of the path's value being over the next one's, given that one; the
    sum of f * p / inclusion over the samples is an unbiased estimate of the mean of f.
    """
    if lattices.bytes_held() > MOST_BYTES:
        lattices.clear()
    starts = [lattices.nodes(UNIT.findall(MARK + t.replace(" ", MARK)) if t else []) for t in texts]
    lattice = lattices.views()
    out = []
    for paths, after in sample_units(lattice, starts, keys, k):
        rows = []
        for p in paths:
            ids = lattice[2][p.edges]
            if ids.min(initial=0) < 0:
                ids = np.array([x for i in ids.tolist() for x in ([i] if i >= 0 else [lattices.bytes[b] for b in chr(-i).encode("utf-8", "surrogatepass")])])
            logp = float(p.lp.sum())
            rows.append((ids, logp, p.value, _log_inclusion(logp - after)))
        out.append(rows)
    return out


def _parts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(place, number) of texts that are sampled at once: at most TEXTS, and TEXT_CHARS bytes unless one alone has more."""
    at, held = 0, 0
    for k, size in enumerate(pa.compute.binary_length(texts).fill_null(0).to_pylist()):
        if k > at and (k - at == TEXTS or held + size > TEXT_CHARS):
            yield at, k - at
            at, held = k, 0
        held += size
    if at < len(texts):
        yield at, len(texts) - at


def _log_inclusion(x: float) -> float:
    """log(1 - exp(-exp(x))), which is x itself where exp(x) is small."""
    return x if x < -30 else 0.0 if x > 30 else math.log(-math.expm1(-math.exp(x)))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``doc_id, ids``: the tokenizer's own segmentation, one row per row; null text has null ids, empty text none.

    Null and repeated ids are rows like any other; an empty table gives an empty table; other columns play no part.
    """
    path = path or tokenizer_path(MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(path)
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array((None if t is None else sp.encode(t) for t in b.column(1).to_pylist()), pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """``doc_id, text`` from ids, one row per row; null ids have null text, an empty list the empty text.

    A word mark in a text comes back as a space. Null and repeated doc_ids are rows like any other; an empty
    table gives an empty table; other columns play no part.
    """
    path = path or tokenizer_path(MODEL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(path)
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array((None if i is None else sp.decode(i) for i in b.column(1).to_pylist()), pa.string())], ["doc_id", "text"])

    return encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")


def sample_segmentations(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SAMPLES, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Up to ``k`` rows per row of ``docs``, seeded by its id: ``doc_id, sample, n_pieces, log_prob, value, log_inclusion, ids_crc32, round_trip``.

    A text with fewer segmentations has them all, so null and empty texts have one empty segmentation; a
    null id has the seed of -1; repeated rows give the same rows; an empty table gives none; other columns
    play no part. ``round_trip`` says whether the decoded ids are the text. ``with_ids`` adds ``ids``. No shuffle.
    """
    path = path or tokenizer_path(MODEL)
    names = ["doc_id", "sample", "n_pieces", "log_prob", "value", "log_inclusion", "ids_crc32", "round_trip"] + ["ids"] * with_ids
    types = [pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.bool_()] + [pa.list_(pa.int32())] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp, lattices = processor(path), Lattices.load(path)
        for batch in batches:
            for at, n in _parts(batch.column(1)):
                b = batch.slice(at, n)
                ids, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
                keys = np.array([-1 if i is None else i for i in ids], np.int64)
                rows = []
                for doc_id, text, samples in zip(ids, texts, segmentations(texts, keys, k, lattices)):
                    for n, (own, logp, value, included) in enumerate(samples):
                        rows.append((doc_id, n, len(own), logp, value, included, zlib.crc32(own.astype("<u4").tobytes()), sp.decode(own.tolist()) == text) + ((own,) if with_ids else ()))
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    schema = "doc_id long, sample int, n_pieces long, log_prob double, value double, log_inclusion double, ids_crc32 long, round_trip boolean" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def op9_segmentation(spark, sf_dir: str) -> DataFrame:
    return sample_segmentations(table(spark, sf_dir, "documents"))
