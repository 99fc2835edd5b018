import random

from tidewell.llm.secrets import find_secrets, redact_secrets

KEY = "".join(random.Random(8).sample("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 40))


def test_a_fragment_hides_its_own_part_only(spark):
    texts = [f"at /opt/example/{KEY} now", f"SVC_example={KEY}", f"{KEY}/XXXX/{KEY}", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", f"xxxx{KEY}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {r.doc_id: r.text for r in redact_secrets(docs).collect()}
    assert all(KEY not in left[i] for i in (0, 1, 2)) and left[0].startswith("at /opt/example/") and left[1].startswith("SVC_example=")
    assert "XXXX" in left[2]
    found = {r.doc_id: r.secret_spans for r in find_secrets(docs).collect()}
    assert [len(found[i]) for i in range(5)] == [1, 1, 2, 0, 0]
