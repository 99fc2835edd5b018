import hashlib
import math
import random
import re

from pyspark.sql import functions as F

from tidewell.llm.secrets import ALLOW, CLASSES, KINDS, find_secrets, op1_secret_scan, redact_secrets

BASE = [
    (0, re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 8),
    (1, re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    (2, re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
]


def brute(text):
    text = text or ""
    spans = [(m.start(), k, m.end()) for k, p, ok in BASE for m in p.finditer(text) if ok(m)]
    for c in CLASSES:
        more = []
        for m in re.finditer(f"{c.pattern}{{{c.window},}}", text):
            if any(re.fullmatch(a, m[0]) for a in ALLOW):
                continue
            merged = []
            for i in range(len(m[0]) - c.window + 1):
                w = m[0][i : i + c.window]
                h = -sum(w.count(x) / c.window * math.log2(w.count(x) / c.window) for x in set(w))
                if h >= c.bits - 1e-9:
                    if merged and i <= merged[-1][1]:
                        merged[-1][1] = i + c.window
                    else:
                        merged.append([i, i + c.window])
            more += [(m.start() + a, KINDS.index(c.kind), m.start() + b) for a, b in merged]
        spans += [s for s in more if not any(b[0] <= s[0] and b[2] >= s[2] for b in spans)]
    return sorted(spans)


def texts():
    rnd = random.Random(5)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    out = [None, "", "é" * 50 + " password='" + "x" * 8 + "'", "token=apikey:12345678", "TOKEN : abc", "api_key=\"AKIA" + "A" * 12, "AKIA" + "B" * 11,
           "f" * 31 + " " + "0123456789abcdef" * 4, "a" * 200_000, "secret=" + "z" * 100_000 + " \U0001f600 passwd:" + "q9" * 8,
           "550e8400-e29b-41d4-a716-446655440000", "some/path/without/any/digits/in/it", "x" * 23 + "1"]
    for _ in range(40):
        n = rnd.randint(20, 90)
        out.append("é wörd " + "".join(rnd.choice(b64) for _ in range(n)) + " " + "".join(rnd.choice("0123456789abcdefABCDEF") for _ in range(n)) + "\nsecret = " + "".join(rnd.choice(b64) for _ in range(rnd.randint(5, 40))))
    return out + out[:3]


def test_against_brute_force(spark):
    rows = [(i, t, "other") for i, t in enumerate(texts())]
    df = find_secrets(spark.createDataFrame(rows, "doc_id long, text string, rank string"))
    got = {r.doc_id: [tuple(s) for s in r.secret_spans] for r in df.collect()}
    assert got == {i: brute(t) for i, t, _ in rows}
    assert any(s[1] == 3 for v in got.values() for s in v) and any(s[1] == 4 for v in got.values() for s in v)


def test_query_on_whole_table(spark, sf_dir):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op1_secret_scan(spark, sf_dir).collect()
    assert len(rows) == len(text)
    for r in rows:
        want = brute(text[r.doc_id])
        base = [s for s in want if s[1] < 3]
        word = lambda v: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in v)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[1] == k for s in base) for k in range(3))
        assert r.base_sha256 == hashlib.sha256(word(base).encode()).hexdigest() and r.spans == word(want)


def test_redaction(spark):
    rows = [(1, None, 1), (2, "", 2), (3, "ab é password=abcdefgh12 end", 3), (4, "clean", 4), (4, "clean", 4)]
    df = redact_secrets(spark.createDataFrame(rows, "doc_id long, text string, pos int"))
    assert [r.text for r in df.orderBy("doc_id").collect()] == [None, "", "ab é [SECRET] end", "clean", "clean"]
    assert df.columns == ["doc_id", "text", "pos"]
    assert redact_secrets(df.where(F.lit(False))).count() == 0
