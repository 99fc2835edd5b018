import random

import pytest
from pyspark.sql import functions as F

from tests.llm.test_secrets import brute
from tidewell.llm.secrets import find_secrets, redact_secrets

B64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def cut(text, spans, mark="[SECRET]"):
    out, pos, last = [], 0, 0
    for start, _, end in sorted(spans):
        if start >= pos:
            out += [text[last:start], mark]
        pos = last = max(pos, end)
    return "".join(out) + text[last:]


def texts():
    rnd = random.Random(9)
    run = lambda alphabet, n: "".join(rnd.choices(alphabet, k=n))
    out = [run(B64, 12_000), run("0123456789abcdef", 12_000), run("0123456789abcdefABCDEF", 9_000), "a-" * 9_000 + "1", "".join(run(B64, rnd.randint(20, 50)) + "a" * rnd.randint(0, 60) for _ in range(500))]
    out.append("é " + " ".join(run("0123456789abcdef", rnd.randint(28, 40)) for _ in range(800)) + " \U0001f600é" * 300 + " token=" + run(B64, 500))
    out.append("password=" + run(B64, 30) + "\U0001f600" + "secret='" + run(B64, 12) + "' " * 400 + "x" * 700)
    # Lengths around the edges of blocks and windows.
    out += [run(B64, n) for n in (23, 24, 25, 254, 255, 256, 257, 278, 279, 280, 281, 512, 535, 536)]
    return out + [None, "", out[0]]


def test_long_candidates_against_brute_force(spark):
    rows = [(i, t, "kept", 7) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _more string, _spans int")
    got = {r.doc_id: [tuple(s) for s in r.secret_spans] for r in find_secrets(docs).collect()}
    want = {i: brute(t) for i, t, *_ in rows}
    assert got == want
    redacted = redact_secrets(docs)
    assert redacted.columns == docs.columns
    for r in redacted.collect():
        t = rows[r.doc_id][1]
        assert r.text == (t if t is None else cut(t, want[r.doc_id])) and (r._more, r._spans) == ("kept", 7)
    assert find_secrets(docs.where(F.lit(False))).count() == 0


@pytest.mark.parametrize("text,n", [("a-" * 500_000 + "1", 0), ("a-" * 500_000, 0), ("/x=" * 300_000 + "Ab", 0), ("password=abcdefgh1 " * 20_000, 20_000), ("".join(random.Random(2).choices("0123456789abcdef", k=100_000)), 1)])
def test_a_million_characters(spark, text, n):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert find_secrets(docs).select(F.size("secret_spans")).first()[0] == n
    assert redact_secrets(docs).select(F.length("text")).first()[0] == len(cut(text, [tuple(s) for s in find_secrets(docs).first().secret_spans]))
