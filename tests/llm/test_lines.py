from collections import Counter

import duckdb
import pytest

from tidewell.llm.lines import MAX_RATIO, OP3_SQL, drop_boilerplate, op3_line_dedup


def brute(rows, max_ratio, min_pages):
    pages, on = Counter(), Counter()
    for _, host, text in rows:
        if host is not None:
            pages[host] += 1
            on.update((host, x) for x in {x.strip(" ") for x in (text or "").split("\n")} - {""})
    bad = {k for k, n in on.items() if n >= min_pages and n > pages[k[0]] * max_ratio}
    return sorted(((i, h, None if t is None else "\n".join(x for x in t.split("\n") if (h, x.strip(" ")) not in bad)) for i, h, t in rows), key=str)


@pytest.mark.parametrize("broadcast_lines", [1000, 0])
def test_against_brute_force(spark, broadcast_lines):
    rows = [(i, f"h{i % 3}" if i % 7 else None, f"Common line\n own {i}\n\n{'Rare' if i % 10 == 0 else 'x%d' % i}\n  Common line ") for i in range(90)]
    rows += [(90, "h0", None), (91, "h1", ""), (92, "h2", "Common line"), (92, "h2", "Common line"), (93, "one", "Common line"), (None, "h0", "Common line\nz"), (94, "h1", "line\n" * 50_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, source string, text string, host string")
    got = drop_boilerplate(df, max_ratio=0.5, min_pages=3, broadcast_lines=broadcast_lines)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.source, r.text) for r in got.collect()), key=str) == brute(rows, 0.5, 3)
    assert drop_boilerplate(df.limit(0)).count() == 0


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = con.execute(f"select doc_id, source, text, n_lines, n_dropped from ({OP3_SQL}) order by 1").fetchall()
    got = sorted(tuple(r) for r in op3_line_dedup(spark, sf).select("doc_id", "source", "text", "n_lines", "n_dropped").collect())
    assert got == want and MAX_RATIO < 1
