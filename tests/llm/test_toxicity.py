import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidewell.llm.toxicity import Scorer, Toxicity, fit, grams, held_out, op4_toxicity, sample, score_toxicity, subwords, train, words

SMALL = Toxicity(buckets=1 << 12, epochs=40, scale=60.0)


def test_fit_learns_and_generalises_to_misspellings():
    rng = np.random.default_rng(1)
    plain = [f"w{x}" for x in range(300)]
    text = lambda bad: " ".join(rng.choice(plain, 30).tolist() + bad)
    texts = [text(["idiot", "scumbag", "idiots"]) for _ in range(60)] + [text([]) for _ in range(60)]
    score = Scorer(*fit(texts, [1] * 60 + [0] * 60, SMALL), SMALL)
    assert score(text(["idiot", "scumbag"])) > 0.5 > score(text([]))
    assert score(text(["idiotz", "scumbagg", "idioot"])) > score(text(["table", "window", "garden"]))
    assert 0 < score("") < 0.5 or score("") == score(None)
    assert fit([], [], SMALL)[0].sum() == 0 and fit(["a"] * 4, [1] * 4, SMALL)[1] > 0 > fit([], [], SMALL)[1]


def test_whole_text_is_scored_by_the_mean_of_its_distinct_words():
    w = np.random.default_rng(2).normal(size=SMALL.buckets)
    text = "Some words and som3 more words"
    own = [np.mean([w[b] for b in subwords(x, SMALL)]) for x in set(words(text))]
    z = 0.3 + sum(own) / (len(own) + SMALL.pad)
    assert np.isclose(Scorer(w, 0.3, SMALL)(text), 1 / (1 + np.exp(-z)))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op4_toxicity(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(labels[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in labels]
    good = np.mean([(s >= 0.5) == y for y, s in held])
    recall = np.mean([s >= 0.5 for y, s in held if y])
    assert good > 0.95 and recall > 0.8


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (2, "", 2.0), (None, "word", 3.0), (3, "x " * 100_000, 4.0), (3, "x", 5.0)], "doc_id long, text string, toxicity double")
    out = score_toxicity(docs, (np.zeros(1 << 16), -1.0))
    assert out.columns == docs.columns and all(0 <= r.toxicity <= 1 for r in out.collect())
    assert score_toxicity(docs.where(F.lit(False)), (np.zeros(1 << 16), 0.0)).count() == 0
    assert train(docs, spark.createDataFrame([], "doc_id long, toxic int"))[0].sum() == 0


def test_fit_against_a_dense_twin():
    """The same fit written with dense matrices: documents by words, words by buckets, softmax and Adam."""
    how = Toxicity(buckets=97, epochs=12, min_docs=2, scale=20.0)
    rng = np.random.default_rng(4)
    vocab = [f"wörd{chr(97 + i)}{i}" for i in range(26)]
    texts = [" ".join(rng.choice(vocab, 8)) for _ in range(25)]
    labels = rng.integers(0, 2, 25).tolist()
    bags = [set(t.split()) for t in texts]
    known = sorted(w for w in vocab if sum(w in b for b in bags) >= 2)
    doc = np.array([[(w in b) / (len(b) + how.pad) for w in known] for b in bags])
    word = np.zeros((len(known), how.buckets))
    for i, w in enumerate(known):
        own = subwords(w, how)
        for x in own:
            word[i, x] += 1 / len(own)
    dice = np.random.default_rng(how.seed)
    params = [np.zeros((how.dim, how.buckets)), dice.normal(0, 0.5, (2, how.dim)), np.zeros((2, 1))]
    pace, size = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    y = np.eye(2)[:, labels]
    for t in range(1, how.epochs + 1):
        emb, out, bias = params
        kept = np.zeros_like(doc)
        kept[doc > 0] = dice.random(int((doc > 0).sum())) < how.keep
        x = doc * kept / how.keep @ word
        z = out @ (how.scale * emb @ x.T) + bias
        p = np.exp(z) / np.exp(z).sum(0)
        d = (p - y) / len(labels)
        prior = how.prior / len(labels)
        grads = [how.scale * out.T @ d @ x + prior * emb, d @ (how.scale * emb @ x.T).T + prior * out, d.sum(1, keepdims=True)]
        for i, g in enumerate(grads):
            pace[i] = 0.9 * pace[i] + 0.1 * g
            size[i] = 0.95 * size[i] + 0.05 * g * g
            params[i] = params[i] - how.rate * (1 - (t - 1) / how.epochs) * (pace[i] / (1 - 0.9**t)) / (np.sqrt(size[i] / (1 - 0.95**t)) + 1e-8)
    emb, out, bias = params
    weights, b = fit(texts, labels, how)
    assert np.allclose(weights, how.scale * (out[1] - out[0]) @ emb, rtol=0.02, atol=0.02) and np.isclose(b, bias[1, 0] - bias[0, 0], atol=0.01)


def test_grams():
    """n-grams of a word with its ends marked, each as often as it occurs, and the whole word."""
    for w in ("a", "ab", "banana", "\U0001f600é", "x" * 3000):
        assert len(subwords(w, SMALL)) == 1 + sum(max(0, len(w) + 3 - n) for n in (3, 4, 5))
    assert set(subwords("banana", SMALL)) & set(subwords("bananas", SMALL)) and subwords("ab", SMALL) != subwords("ba", SMALL)
    row, bucket = grams(["one", "two", "one"], SMALL)
    assert bucket[row == 0].tolist() == bucket[row == 2].tolist() == subwords("one", SMALL)


def test_sample_is_bounded_and_leaves_the_held_out_fold(spark):
    docs = spark.createDataFrame([(i, "x" * 100) for i in range(400)] + [(7, "a"), (None, "n")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(7, 0), (3, 2), (None, 1)], "doc_id long, toxic int")
    how = Toxicity(sample=20, clean_per_toxic=2)
    rows = sample(docs, labels, how=how).collect()
    assert len(rows) == 60 == len({r[0] for r in rows}) and sum(r[1] for r in rows) == 20
    assert not [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert sum(len(r[2]) for r in sample(docs, labels, how=Toxicity(sample=20, clean_per_toxic=2, sample_bytes=1000)).collect()) <= 1000
    assert [r[2] for r in sample(docs, labels, how=Toxicity(sample=400)).where("_id = 7").collect()] == ["a"]
    model = train(docs.limit(0), labels)
    assert model[0].sum() == 0
    # One long text, wherever it comes in the order of hashes, leaves the others in.
    for seed in range(4):
        long = docs.withColumn("text", F.when(F.col("doc_id") == 11, F.repeat(F.lit("y"), 40 << 20)).otherwise(F.col("text")))
        assert sample(long, labels.where("doc_id <> 7"), how=Toxicity(sample=400, seed=seed)).where("_id <> 11").count() == labels.where("doc_id <> 7 AND toxic IN (0, 1)").where(~held_out(F.col("doc_id"))).count() - 1


def test_fit_and_scores_hold_few_words_as_text():
    """An executor's workers share its memory: words of a sample are held once, texts of a batch a few at a time."""
    rng = np.random.default_rng(5)
    vocab = [f"word{i}" for i in range(2000)]
    texts = [" ".join(rng.choice(vocab, 1500)) for _ in range(200)]
    size = sum(map(len, texts))
    tracemalloc.start()
    try:
        model = fit(texts, [i % 2 for i in range(200)], Toxicity(buckets=1 << 12, epochs=2))
        assert tracemalloc.get_traced_memory()[1] < 6 * size
        del texts[100:]
        scorer = Scorer(*model, Toxicity(buckets=1 << 12, texts=16))
        batch = pa.array([*texts, None, ""] * 20)
        scorer.batch(batch[:102])
        tracemalloc.reset_peak()
        before = tracemalloc.get_traced_memory()[0]
        scores = scorer.batch(batch).to_pylist()
        assert tracemalloc.get_traced_memory()[1] - before < batch.nbytes / 4
    finally:
        tracemalloc.stop()
    assert scores == [scorer(t) for t in [*texts, None, ""]] * 20
