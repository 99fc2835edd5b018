"""Toxicity: subword-bag embeddings, averaged, into a linear softmax; trained jointly in numpy.

A word is the mean of the embeddings of its character n-grams (hashed into a fixed number of buckets), a
document the mean of its words, and one linear layer with softmax gives the class. As everything up to
the softmax is linear, a trained model scores with one number per bucket: its embedding times the
difference of the classes' weights. Misspellings share most n-grams with the word that they hide.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.tables import table

WORD = re.compile(r"[^\W_]++(?:[*@$!'._-]++[^\W_]++)*+")
FOLDS = 5
#: Words whose n-grams are made at once.
WORDS = 1 << 14


@dataclass(frozen=True)
class Toxicity:
    """Production parameters. At most ``sample`` toxic and ``clean_per_toxic`` times as many clean labelled
    documents, of ``sample_bytes`` in all, are fitted on, the first by a hash of their ids; everything else
    covers all rows."""

    sample: int = 900
    clean_per_toxic: int = 3
    sample_bytes: int = 32 << 20
    text_bytes: int = 32 << 10
    toxic_weight: float = 1.0
    buckets: int = 1 << 16
    dim: int = 4
    grams: tuple[int, int] = (3, 5)
    epochs: int = 150
    rate: float = 0.3
    scale: float = 300.0
    prior: float = 0.1
    keep: float = 0.5
    min_docs: int = 2
    pad: int = 40
    seed: int = 7
    cache_words: int = 1 << 17
    texts: int = 256


def grams(words: list[str], how: Toxicity) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of the n-grams of each ``<word>``, and of the wholes, in the order of the words."""
    size = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    chars = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(chars))
    lo, hi = how.grams
    found = [(np.arange(len(words)), np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words)))]
    h = np.zeros(len(chars), np.uint64)
    for n in range(1, hi + 1):
        h = h[: max(0, len(chars) - n + 1)] * np.uint64(0x9E3779B97F4A7C15) + chars[n - 1 :] + np.uint64(1)
        if n >= lo:
            whole = left[: len(h)] >= n
            found.append((owner[: len(h)][whole], (h ^ (h >> np.uint64(29)))[whole] * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)))
    row, code = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(row, kind="stable")
    return row[order], (code[order] % np.uint64(how.buckets)).astype(np.int64)


def subwords(word: str, how: Toxicity) -> list[int]:
    """Buckets of the n-grams of ``<word>``, and of the whole."""
    return grams([word], how)[1].tolist()


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def fit(texts: list[str | None], labels: list[int], how: Toxicity = Toxicity()) -> tuple[np.ndarray, float]:
    """(weight of each bucket, bias) of the log-odds, from a joint fit of embeddings and softmax layer.

    Full-batch Adam. Both means are sparse products; the second index of each, sorted once, turns the
    scatter of the gradients into a segmented sum. Each epoch hides a random part of each document's words,
    so that rare words can't explain a document alone, and the steps shrink to nothing by the end.
    """
    # Each document's distinct words as numbers; a word is kept as text once for the whole sample.
    number: dict[str, int] = {}
    bags = []
    for t in texts:
        own = set(words(t))
        bags.append(np.fromiter((number.setdefault(w, len(number)) for w in own), np.int32, len(own)))
    size = np.array([len(b) for b in bags], np.int64)
    seen = np.bincount(np.concatenate([np.zeros(0, np.int32), *bags]), minlength=len(number))
    vocab = sorted(w for w, i in number.items() if seen[i] >= how.min_docs)
    if not vocab or len(set(labels)) < 2:
        share = (sum(labels) + 0.5) / (len(labels) + 2)
        return np.zeros(how.buckets), float(np.log(share / (1 - share)))
    place = np.full(len(number), -1, np.int32)
    place[[number[w] for w in vocab]] = np.arange(len(vocab), dtype=np.int32)
    known = [np.sort(k[k >= 0]) for k in (place[b] for b in bags)]
    n_known = [len(k) for k in known]
    doc = _sparse(np.repeat(np.arange(len(known), dtype=np.int32), n_known), np.concatenate(known), np.repeat((1 / (size + how.pad)).astype(np.float32), n_known), (len(known), len(vocab)))
    parts = [[(x + off).astype(np.int32) for x, off in zip(grams(vocab[at : at + WORDS], how), (at, 0))] for at in range(0, len(vocab), WORDS)]
    row, bucket = (np.concatenate(x) for x in zip(*parts))
    word = _sparse(row, bucket, (1 / np.bincount(row)).astype(np.float32)[row], (len(vocab), how.buckets))
    del number, bags, seen, place, known, parts, row, bucket, vocab
    rng = np.random.default_rng(how.seed)
    y = np.eye(2, dtype=np.float32)[:, labels]
    # A Gaussian prior weighs less against the mean loss the more documents there are.
    decay = np.float32(how.prior / len(labels))
    weight = np.where(y[1] > 0, how.toxic_weight, 1).astype(np.float32) / len(labels)
    # Embeddings start at zero: a bucket that the sample never met says nothing.
    params = [np.zeros((how.dim, how.buckets), np.float32), rng.normal(0, 0.5, (2, how.dim)).astype(np.float32), np.zeros((2, 1), np.float32)]
    pace = [np.zeros_like(p) for p in params]
    size = [np.zeros_like(p) for p in params]
    for t in range(1, how.epochs + 1):
        emb, out, bias = params
        rate = how.rate * (1 - (t - 1) / how.epochs)
        doc.thin(rng.random(len(doc.full)) < how.keep, how.keep)
        hidden = how.scale * doc.dot(word.dot(emb))
        z = out @ hidden + bias
        p = np.exp(z - z.max(0))
        p /= p.sum(0)
        d = (p - y) * weight
        grads = [word.back(doc.back(how.scale * out.T @ d)) + decay * emb, d @ hidden.T + decay * out, d.sum(1, keepdims=True)]
        for i, (x, g, a) in enumerate(zip(params, grads, pace)):
            a += 0.1 * (g - a)
            size[i] += 0.05 * (g * g - size[i])
            x -= rate * (a / (1 - 0.9**t)) / (np.sqrt(size[i] / (1 - 0.95**t)) + 1e-8)
    emb, out, bias = params
    return (how.scale * (out[1] - out[0]) @ emb).astype(np.float64), float(bias[1, 0] - bias[0, 0])


class _sparse:  # noqa: N801
    """Rows of (column, value), by which dense (dim, columns) matrices are multiplied in both directions."""

    def __init__(self, row: np.ndarray, col: np.ndarray, val: np.ndarray, shape: tuple[int, int]):
        self.col, self.val, self.shape = col, val, shape
        order = np.argsort(col, kind="stable").astype(np.int32)
        self.back_row, self.back_val = row[order], val[order]
        self.order, self.full = order, val
        self.ends = [self._starts(row), self._starts(col[order])]

    def thin(self, kept: np.ndarray, share: float) -> None:
        """Take only the ``kept`` entries from here on, scaled up so that sums keep their size."""
        self.val = self.full * (kept / np.float32(share))
        self.back_val = self.val[self.order]

    @staticmethod
    def _starts(index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(np.r_[True, index[1:] != index[:-1]]) if len(index) else np.zeros(0, np.int64)
        return at, index[at]

    @staticmethod
    def _sum(m: np.ndarray, index: np.ndarray, val: np.ndarray, ends: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
        """One dimension at a time, so that no product with all entries of all dimensions is held."""
        out = np.zeros((len(m), n), np.float32)
        if len(index):
            for x, into in zip(m, out):
                into[ends[1]] = np.add.reduceat(x[index] * val, ends[0])
        return out

    def dot(self, m: np.ndarray) -> np.ndarray:
        return self._sum(m, self.col, self.val, self.ends[0], self.shape[0])

    def back(self, m: np.ndarray) -> np.ndarray:
        return self._sum(m, self.back_row, self.back_val, self.ends[1], self.shape[1])


class Scorer:
    """Log-odds of whole texts; the weights of words met before are kept, up to a bound."""

    def __init__(self, weights: np.ndarray, bias: float, how: Toxicity):
        self.weights, self.bias, self.how, self.known = weights.astype(np.float64), bias, how, {}

    def learn(self, new: list[str]) -> None:
        for at in range(0, len(new), WORDS):
            some = new[at : at + WORDS]
            row, bucket = grams(some, self.how)
            self.known.update(zip(some, (np.bincount(row, self.weights[bucket]) / np.bincount(row)).tolist()))

    def many(self, texts: list[str | None]) -> list[float]:
        if len(self.known) > self.how.cache_words:
            self.known.clear()
        found = [set(words(t)) for t in texts]
        if new := set().union(*found).difference(self.known):
            self.learn(sorted(new))
        known, pad = self.known.__getitem__, self.how.pad
        # fsum: the score doesn't depend on the order of a set.
        z = [self.bias + math.fsum(map(known, f)) / (len(f) + pad) for f in found]
        return (1 / (1 + np.exp(-np.clip(z, -50, 50)))).tolist()

    def batch(self, texts: pa.Array) -> pa.Array:
        """Scores of a batch of any size, of which ``texts`` at a time become Python strings."""
        step = self.how.texts
        return pa.array([z for at in range(0, len(texts), step) for z in self.many(texts.slice(at, step).to_pylist())], pa.float64())

    def __call__(self, text: str | None) -> float:
        return self.many([text])[0]


def sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", how: Toxicity = Toxicity()) -> DataFrame:
    """``(_id, _label, _text)`` of the bounded sample that is fitted on; see ``Toxicity``.

    Texts of over ``text_bytes`` aren't learnt from, so no single one can take up the sample.

    Ids are chosen from the labels alone, with the larger label of an id that repeats; of an id's texts the
    first in order counts. Null ids and labels other than 0 and 1 are left out.
    """
    own = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"))
    known = own.where(F.col("_id").isNotNull() & ~held_out(F.col("_id")) & F.col("_label").isin(0, 1)).groupBy("_id").agg(F.max("_label").cast("int").alias("_label"))
    order = F.xxhash64("_id", F.lit(how.seed))
    pick = lambda label, n: known.where(F.col("_label") == label).orderBy(order, "_id").limit(n)
    # At most (1 + clean_per_toxic) * sample ids.
    chosen = pick(1, how.sample).unionByName(pick(0, how.sample * how.clean_per_toxic))
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text")).join(F.broadcast(chosen), "_id")
    texts = texts.groupBy("_id", "_label").agg(F.min("_text").alias("_text"))
    so_far = Window.orderBy(order, "_id").rowsBetween(Window.unboundedPreceding, 0)
    return texts.where(F.octet_length("_text") <= how.text_bytes).withColumn("_bytes", F.sum(F.octet_length("_text")).over(so_far)).where(F.col("_bytes") <= how.sample_bytes).select("_id", "_label", "_text")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", how: Toxicity = Toxicity()) -> tuple[np.ndarray, float]:
    """Fit in one task on a bounded sample of the labelled rows outside the held-out fold; see ``sample``.

    The driver gets one row, with a float for each bucket. Without labels of both kinds, or without
    documents, the model is the share of the labels alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        weights, bias = fit([r[2] for r in rows], [r[1] for r in rows], how)
        yield pa.record_batch([pa.array([weights.astype(np.float32)], pa.list_(pa.float32())), pa.array([bias])], ["weights", "bias"])

    row = sample(docs, labels, id_col, text_col, label_col, how).repartition(1).mapInArrow(run, "weights array<float>, bias double").first()
    return (np.array(row[0], np.float32), row[1]) if row else fit([], [], how)


def held_out(doc_id):
    """The fold that is never learnt from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def score_toxicity(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text", out: str = "toxicity", how: Toxicity = Toxicity()) -> DataFrame:
    """``docs`` with a column of scores from 0 to 1 for whole texts, from nothing but the text.

    Null and empty texts have the model's bias alone; repeated rows score alike; a column named ``out`` is
    replaced, any other stays; an empty table gives an empty table. Batch by batch without a shuffle, ``texts``
    of a batch at a time as Python strings; the model is one float for each bucket.
    """
    weights, bias = model[0].astype(np.float32), model[1]

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(weights, bias, how)
        for b in batches:
            yield scorer.batch(b)

    return docs.withColumn(out, run(F.col(text_col)))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, train(docs, table(spark, sf_dir, "labels")), out="score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
