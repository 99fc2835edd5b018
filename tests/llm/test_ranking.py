import math
import re
from collections import Counter

import duckdb
import pytest

from tidewell.llm import ranking
from tidewell.llm.ranking import OP12_SQL, op12_ranked_search, rank_documents, terms

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top):
    found = [(i, Counter(split(t))) for i, t in docs if split(t)]
    n_docs, n_terms, out = len(found), sum(c.total() for _, c in found), []
    df = Counter(t for _, c in found for t in c)
    for item, text in items:
        scored = []
        for i, c in found:
            m = 75 + 25 * c.total() * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in split(text) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, k, i, -s) for k, (s, _, _, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def listed(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def test_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    got = listed(op12_ranked_search(spark, sf_dir))
    assert got == sorted(map(tuple, con.execute(f"select item_id, rank, doc_id, score from ({OP12_SQL})").fetchall()), key=str)
    assert len(got) == 20 * len({r[0] for r in got}) > 0


@pytest.mark.parametrize("block, items, carried", [(1024, 1024, (4, 16)), (3, 2, (0, 1)), (7, 5, (1, 100))])
def test_against_brute_force(spark, monkeypatch, block, items, carried):
    monkeypatch.setattr(ranking, "BLOCK_DOCS", block)
    monkeypatch.setattr(ranking, "BUNDLE_ITEMS", items)
    monkeypatch.setattr(ranking, "CARRIED", carried)
    words = [f"w{i}" for i in range(12)]
    docs = [(i, " ".join(words[(i * k) % (k + 3) % 12] for k in range(1, i % 9 + 1))) for i in range(60)]
    docs += [(100, "W1-w2_É w1"), (101, "w1 w2 É w1"), (None, "w1 w2 É w1"), (102, None), (103, ""), (104, "?!"), (105, "w3 " * 5000), (106, "w1 w2 É w1"), (106, "w1 w2 É w1"), (-5, "w1 w2 É w1")]
    wanted = [(1, "w1 w2 W2 é"), (2, "É w1"), (3, None), (4, ""), (5, "nowhere"), (6, "w3 w4 w5 w5 w11"), (7, " ".join(words))]
    own = spark.createDataFrame([(*d, i, 0) for i, d in enumerate(docs)], "doc_id long, text string, block long, owner int").repartition(5)
    asked = spark.createDataFrame([(*w, "x") for w in wanted], "item_id long, text string, rank string")
    assert listed(rank_documents(own, asked, top=6)) == brute(docs, wanted, 6)


def test_edge_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "item_id long, text string")
    assert listed(rank_documents(docs, items)) == brute([(1, "a b")], [(1, "a"), (1, "a"), (None, "b")], 20)
    assert rank_documents(docs.limit(0), items).count() == rank_documents(docs, items.limit(0)).count() == 0
    monkeypatch.setattr(ranking, "SLICE", 5)
    text = "Ab-cd efgh\x00ij kl é漢字x  " * 9
    assert [t.decode() for part in terms(text) for t in part] == split(text)
