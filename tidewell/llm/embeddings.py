"""Embedding near-duplicates by an inverted multi-index over vector halves."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.components import components
from tidewell.llm.similar import few
from tidewell.llm.tables import forget, settle, table


@dataclass(frozen=True)
class MultiIndex:
    """Production parameters. All vectors are indexed. Codes of a half number the square root of the cells that
    hold ``vectors_per_cell`` each, so that cells grow with the vectors. The codebooks are fitted on ``sample``
    distinct vectors, or on ``sample_per_code`` for each code, up to ``most_sample``, which is reached at two
    thousand million vectors; from there on cells hold more."""

    cosine: float = 0.95
    recall: float = 0.995
    sample: int = 20_000
    sample_per_code: int = 8
    most_sample: int = 1 << 17
    vectors_per_cell: int = 8
    rounds: int = 8
    block: int = 2048
    seed: int = 11


@dataclass(frozen=True)
class Codebooks:
    """Centroids of each half, and how far beyond its best cell a vector visits others."""

    first: np.ndarray
    second: np.ndarray
    reach: float

    @property
    def codes(self) -> int:
        return len(self.first)

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.first.shape[1]
        return _squared(x[:, :half], self.first), _squared(x[:, half:], self.second)

    def cells(self, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
        return d1.argmin(1) * self.codes + d2.argmin(1)

    def visits(self, d1: np.ndarray, d2: np.ndarray) -> Iterator[np.ndarray]:
        """Multi-sequence traversal: for each vector, its cells from near to far.

        Both halves' codes are sorted by distance; a cell (i, j) of the sorted grid can only be within
        reach if (i-1, j) and (i, j-1) are, so that the walk keeps to the corner that counts. It ends at
        the reach which ``fit`` has set for the target recall.
        """
        o1, o2 = d1.argsort(1), d2.argsort(1)
        s1, s2 = np.take_along_axis(d1, o1, 1), np.take_along_axis(d2, o2, 1)
        limit = s1[:, 0] + s2[:, 0] + self.reach
        for a, b, i, j, most in zip(s1, s2, o1, o2, limit):
            n1, n2 = np.searchsorted(a, most - b[0], "right"), np.searchsorted(b, most - a[0], "right")
            total = a[:n1, None] + b[None, :n2]
            at = np.argwhere(total <= most)
            at = at[total[at[:, 0], at[:, 1]].argsort(kind="stable")]
            yield i[at[:, 0]] * self.codes + j[at[:, 1]]


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None]


def _codes(total: int, how: MultiIndex) -> int:
    return max(2, min(int((total / how.vectors_per_cell) ** 0.5), how.most_sample // how.sample_per_code))


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    rows = _rows_at_once(len(c))
    return np.concatenate([_squared(x[at : at + rows], c).argmin(1) for at in range(0, len(x), rows)])


def _rows_at_once(codes: int) -> int:
    """Vectors whose distances to all codes are held at once: two million numbers."""
    return max(16, min(1024, (1 << 21) // codes))


def _means(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's algorithm from ``k`` sampled points; a code that no point is nearest to keeps its place."""
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(x, c)
        n = np.bincount(near, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def fit(sample: np.ndarray, total: int, how: MultiIndex) -> Codebooks:
    """Codebooks from unit vectors, for an index over ``total`` vectors.

    The reach is set on pairs made for it: each sample vector and a random one at exactly the linking
    cosine, the farthest that counts. Its quantile at the target recall is how far to walk.
    """
    rng = np.random.default_rng(how.seed)
    half = (sample.shape[1] + 1) // 2
    k = min(_codes(total, how), len(sample))
    books = Codebooks(_means(sample[:, :half], k, how.rounds, rng), _means(sample[:, half:], k, how.rounds, rng), 0.0)
    sample = sample[: how.sample]
    noise = rng.normal(size=sample.shape)
    noise -= (noise * sample).sum(1)[:, None] * sample
    norm = np.linalg.norm(noise, axis=1, keepdims=True)
    other = how.cosine * sample + (1 - how.cosine**2) ** 0.5 * noise / np.where(norm > 0, norm, 1)
    extra = []
    for at in range(0, len(sample), _rows_at_once(k)):
        d1, d2 = books.distances(sample[at : at + _rows_at_once(k)])
        cell = books.cells(*books.distances(other[at : at + _rows_at_once(k)]))
        rows = np.arange(len(d1))
        extra.append(d1[rows, cell // k] + d2[rows, cell % k] - d1.min(1) - d2.min(1))
    extra = np.concatenate(extra)
    return Codebooks(books.first, books.second, float(np.quantile(extra, how.recall)))


def _unit(vectors) -> np.ndarray:
    x = np.array(list(vectors), np.float64)
    scale = np.abs(x).max(1, keepdims=True)
    x = x / scale
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _block_links(t: pd.DataFrame, p: pd.DataFrame, cell: int, books: Codebooks, how: MultiIndex) -> pd.DataFrame:
    """Links between the probes ``p`` and the members ``t`` of a cell: counts by vector, and a forest.

    A pair is found if either end visits the other's cell. The probe counts its own finds; the member's
    side is added here only if the member's walk does not reach the probe's cell.
    """
    x, y = _unit(p["v"]), _unit(t["v"])
    a, b, wa, wb = (d[c].to_numpy() for c in ("rep", "m") for d in (p, t))
    i, j = np.nonzero(x @ y.T >= how.cosine)
    i, j = i[a[i] != b[j]], j[a[i] != b[j]]
    if not len(i):
        return pd.DataFrame({"a": [], "b": [], "n": []}).astype("int64")
    counts = [pd.DataFrame({"a": a[i], "n": wb[j]})]
    used, back = np.unique(j, return_inverse=True)
    d1, d2 = books.distances(y[used])
    own = books.cells(*books.distances(x))[i]
    missed = d1[back, own // books.codes] + d2[back, own % books.codes] > (d1.min(1) + d2.min(1) + books.reach)[back]
    counts.append(pd.DataFrame({"a": b[j[missed]], "n": wa[i[missed]]}))
    counts = pd.concat(counts).groupby("a", as_index=False)["n"].sum().assign(b=-1)
    label_a, label_b = a.copy(), b.copy()
    while True:
        was = label_a.sum() + label_b.sum()
        np.minimum.at(label_a, i, label_b[j])
        np.minimum.at(label_b, j, label_a[i])
        if label_a.sum() + label_b.sum() == was:
            break
    ends = pd.DataFrame({"a": np.r_[a[i], b[j]], "b": np.r_[label_a[i], label_b[j]]}).drop_duplicates().assign(n=0)
    return pd.concat([counts, ends[ends.a != ends.b]])[["a", "b", "n"]].astype("int64")


def _links(vectors: DataFrame, total: int, how: MultiIndex) -> DataFrame:
    """``(a, b, n)`` from distinct vectors ``(rep, m, v)``: a count row has b = -1, a link row n = 0."""
    wanted = min(how.most_sample, max(how.sample, how.sample_per_code * _codes(total, how)))
    sampled = vectors.orderBy(F.xxhash64("rep", F.lit(how.seed)), "rep").limit(wanted).select("v").toArrow().column("v").combine_chunks()
    books = fit(_unit(sampled.flatten().to_numpy(zero_copy_only=False).reshape(len(sampled), -1)), total, how)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), _rows_at_once(books.codes)):
                b = batch.slice(at, _rows_at_once(books.codes))
                d1, d2 = books.distances(_unit(b.column("v").to_pylist()))
                visited = list(books.visits(d1, d2))
                row = np.r_[np.arange(len(b)), np.repeat(np.arange(len(b)), [len(v) for v in visited])]
                cell = np.concatenate([books.cells(d1, d2), *visited])
                side = np.r_[np.zeros(len(b), bool), np.ones(len(row) - len(b), bool)]
                yield pa.record_batch([pa.array(cell, pa.int32()), pa.array(side), *(b.column(c).take(pa.array(row)) for c in ("rep", "m", "v"))], ["cell", "probe", "rep", "m", "v"])

    kind = vectors.schema["v"].dataType.simpleString()
    rows = settle(vectors.repartition("rep").mapInArrow(probe, f"cell int, probe boolean, rep long, m long, v {kind}"))
    sizes = rows.groupBy("cell").agg(F.count_if(~F.col("probe")).alias("nt"), F.count_if(F.col("probe")).alias("np")).where("nt > 0 and np > 0")
    parts = lambda n: F.ceil(F.col(n) / how.block).cast("int")
    # Cells grow with the vectors: they are broadcast while they are few, and joined by cell beyond that.
    sizes = settle(sizes.select("cell", parts("nt").alias("nt"), parts("np").alias("np")))
    dealt = rows.join(few(sizes, sizes.count()), "cell")
    part = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    dealt = dealt.withColumn("tb", F.explode(F.when(F.col("probe"), every("nt")).otherwise(F.array(part("nt")))))
    dealt = dealt.withColumn("pb", F.explode(F.when(F.col("probe"), F.array(part("np"))).otherwise(every("np"))))

    def verify(key: tuple, df: pd.DataFrame) -> pd.DataFrame:
        return _block_links(df[~df.probe], df[df.probe], key[0], books, how)

    found = settle(dealt.select("cell", "tb", "pb", "probe", "rep", "m", "v").groupBy("cell", "tb", "pb").applyInPandas(verify, "a long, b long, n long"))
    forget(rows, sizes)
    return found


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", how: MultiIndex = MultiIndex()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row.

    Equal vectors are one entry of the index with their number, and link with each other. A vector that
    is null, empty, zero or has a null or non-finite component links with nothing; vectors of different
    lengths never do, and each length has an index of its own. Repeated ids are vectors of their own; null
    ids take no part and get a null component. An empty table gives none; other columns play no part.
    """
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    good = F.coalesce(F.forall("v", fine) & F.exists("v", lambda x: x != 0), F.lit(False)) & F.col("vec_id").isNotNull()
    vectors = settle(rows.where(good).groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("m")))
    links = None
    for size, total in vectors.groupBy(F.size("v")).count().collect():
        own = _links(vectors.where(F.size("v") == size), total, how)
        links = own if links is None else links.union(own)
    if links is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    counts = links.where("b < 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    groups = components(links.where("n = 0").select("a", "b")).withColumnRenamed("node", "rep")
    named = vectors.join(counts, "rep", "left").join(groups, "rep", "left").select(
        F.col("v").alias("v_"), (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "rep").alias("c"))
    out = rows.join(named, good & (F.col("v") == F.col("v_")), "left")
    component = F.coalesce("c", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op10_multi_index(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
