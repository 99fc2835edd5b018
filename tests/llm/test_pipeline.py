
from collections import Counter

import corpus_pipeline
from tests.llm.test_lines import brute as brute_lines
from tests.llm.test_secrets import brute as brute_secrets
from tests.llm.test_similar import brute_kept
from tidewell.llm.lines import MAX_RATIO, MIN_PAGES
from tidewell.llm.toxicity import Scorer, Toxicity, train

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "simhash", "secrets", "packing"]
    rows = {}
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.settle(stage(spark, now, SF))
        assert now.schema.simpleString() == docs.schema.simpleString()
        rows[name] = [tuple(r) for r in now.collect()]
    model = train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    score = Scorer(model[0].astype("float32"), model[1], Toxicity())
    start = [tuple(r) for r in docs.collect()]
    assert Counter(rows["toxicity"]) == Counter(r for r in start if score(r[1]) < 0.5)
    cleaned = brute_lines([(r[0], r[3], r[1]) for r in rows["toxicity"]], MAX_RATIO, MIN_PAGES)
    assert Counter((r[0], r[3], r[1]) for r in rows["line_dedup"]) == Counter(cleaned)
    kept = brute_kept([(r[0], r[1]) for r in rows["line_dedup"]])
    assert Counter(rows["simhash"]) == Counter(r for r in rows["line_dedup"] if r[0] in kept)
    for r in rows["secrets"]:
        assert not [s for s in brute_secrets(r[1]) if s[1] < 3] and r[4] == len(r[1])
    assert {r[0] for r in rows["secrets"]} == {r[0] for r in rows["simhash"]}
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in packed} == {r[0] for r in rows["secrets"]}
    assert max(Counter((r.sequence_id, r.offset) for r in packed).values()) == 1


def test_empty_and_odd_documents(spark, tmp_path):
    docs = spark.createDataFrame([(1, None, "en", "s", 0), (2, "", None, None, 0), (2, "", None, None, 0), (None, "a b c", "en", "s", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for n, df in enumerate((docs, docs.limit(0))):
        path = str(tmp_path / str(n))
        df.write.parquet(f"{path}/documents.parquet")
        labels.write.parquet(f"{path}/labels.parquet")
        assert corpus_pipeline.run(spark, path).count() == (2 if n == 0 else 0)
