import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from tidewell.llm.trie import OP11_SQL, in_order, op11_prefix_trie, prefix_trie, with_family_heads

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, own in members.items():
        subtree = [n for n in members if n[: len(node)] == node]
        child = lambda n: [m for m in members if len(m) == len(n) + 1 and m[: len(n)] == n]
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in subtree if n)
        ended = ",".join(map(str, sorted(c for c in own if len(convs[c]) == len(node))))
        out.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(child(node)), sum(not child(n) for n in subtree), saved, hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=str)


def listed(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def trie(df, band):
    return prefix_trie(*with_family_heads(in_order(df)), band=band)


@pytest.mark.parametrize("band", [2, 3, 32])
def test_against_brute_force(spark, band):
    rows = []
    for c in range(0, 70):
        for t in range(c % 6):
            rows.append((c, t if c % 5 else None if t == 0 else t, "user" if t % 2 == 0 else None, f"turn {t} of {c % 3}" + " more" * (c % 2) if t % 3 else "same  start"))
    rows += [(1000, 1, "u", "a"), (1000, 1, "u", "a"), (None, 1, "u", "a"), (80, 5, "u", "own only"), (2040, t := 0, "u", None)]
    rows += [(c, t, "u", f"long {t}" if t < 37 else f"{c} {t}") for c in (140, 141, 143, 147) for t in range(40)]
    df = spark.createDataFrame([(*r, i, "x") for i, r in enumerate(rows)], "conv_id long, turn long, role string, text string, place long, node string").repartition(4)
    assert listed(trie(df, band)) == brute(rebuilt(rows))


def test_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{sf_dir}/conversations.parquet'")
    want = sorted(map(tuple, con.execute(f"select {', '.join(COLUMNS)} from ({OP11_SQL})").fetchall()), key=str)
    assert listed(op11_prefix_trie(spark, sf_dir)) == want
    assert want == brute(rebuilt(con.execute("select conv_id, turn, role, text from conversations").fetchall()))


def test_edge_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert trie(spark.createDataFrame([], schema), 32).count() == 0
    assert trie(spark.createDataFrame([(None, 1, "a", "b")], schema), 32).count() == 0
    rows = [(c, 0, None, "word " * 5000) for c in range(1, 400)] + [(5, 1, "u", "")]
    assert listed(trie(spark.createDataFrame(rows, schema), 2)) == brute(rebuilt(rows))
