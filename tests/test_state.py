"""State machines over streams of several micro-batches."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tests.test_library import at, feed
from tidewell.catalog import QUERIES
from tidewell.operators.load import error_code, outcome
from tidewell.operators.metrics import m_of_n
from tidewell.streaming.stateful import batch_starts, completions, redelivery, run_stateful, start_batches, stream_m_of_n
from tidewell.streaming.streams import attempts_by_message

CHANGE = "batch_id string, change string, new_status string, old_status string, run_id string, meta_domain string"
MANIFEST = "batch_id string, ds string, manifest_key string, source string"
DONE = ("MODIFY", "COMPLETE", "finalizing", None)


def run(spark, stream, path, ends):
    """Rows of each micro-batch that had any, and the query."""
    told = []

    def put(batch, _):
        if rows := batch.collect():
            told.append(rows)

    query = run_stateful(spark, stream.writeStream.foreachBatch(put).option("checkpointLocation", path).trigger(availableNow=True), ends)
    query.awaitTermination()
    return told, query


def starts_of(told):
    return [sorted((r.batch_id, r.attempt, [m.ds for m in r.manifests]) for r in rows) for rows in told]


def test_a_batch_without_manifests_starts_when_they_come(spark, tmp_path):
    changes = feed(spark, f"{tmp_path}/c", CHANGE, [("a", *DONE, ""), ("b", "MODIFY", "complete", "complete", None, "x"), ("early", *DONE, "own")], [("a", *DONE, ""), ("late", *DONE, None)], [("a", *DONE, ""), ("run", "MODIFY", "complete", "x", "arn", "x")])
    manifests = feed(spark, f"{tmp_path}/m", MANIFEST, [("early", "2024-01-02", "k2", "dynamodb"), ("early", "2024-01-01", "k1", "computed"), ("early", "2024-01-01", "k1", "computed"), ("never", "2024-01-01", "k", "s")],
                     [("a", "2024-01-01", "k", "dynamodb"), ("a", "", "k", "dynamodb")], [("late", "2024-01-03", "k", "chunk_summary")])
    starts = batch_starts(changes, manifests, {"domain": "market", "interval": "1d"})
    told, _ = run(spark, starts, f"{tmp_path}/cp", True)
    # Two deliveries of a, its manifest at the second: one start. late starts when its manifest comes, two batches on.
    assert starts_of(told) == [[("early", 1, ["2024-01-01", "2024-01-02"])], [("a", 1, ["2024-01-01"])], [("late", 1, ["2024-01-03"])]]
    assert [sorted(r.fields.items()) for rows in told for r in rows] == [[("domain", d), ("interval", "1d")] for d in ("own", "market", "market")]


def test_a_failed_start_gives_the_lock_back(spark, tmp_path):
    changes = feed(spark, f"{tmp_path}/c", CHANGE, [(b, *DONE, "") for b in ("ok", "bad", "worse")], [("ok", *DONE, ""), ("bad", *DONE, "")], [("ok", *DONE, "")], [("ok", *DONE, "")], [("worse", *DONE, "")])
    manifests = feed(spark, f"{tmp_path}/m", MANIFEST, [(b, "2024-01-01", "k", "s") for b in ("ok", "bad", "worse")])
    results = feed(spark, f"{tmp_path}/r", "batch_id string, ok boolean", [("unknown", False)], [("ok", True), ("bad", False), ("worse", False)], [("bad", True), ("worse", False)], [("bad", False), ("ok", False)])
    told, _ = run(spark, batch_starts(changes, manifests, {"domain": "market"}, results, attempts=2), f"{tmp_path}/cp", True)
    names = [[(b, n) for b, n, _ in rows] for rows in starts_of(told)]
    # worse has failed twice and starts anew when it is told complete again; what has started never starts again.
    assert names == [[("bad", 1), ("ok", 1), ("worse", 1)], [("bad", 2), ("worse", 2)], [("worse", 1)]]


def test_a_failed_start_is_tried_again_after_a_while(spark, tmp_path):
    changes = feed(spark, f"{tmp_path}/c", CHANGE, [("a", *DONE, "")])
    manifests = feed(spark, f"{tmp_path}/m", MANIFEST, [("a", "2024-01-01", "k", "s")])
    results = feed(spark, f"{tmp_path}/r", "batch_id string, ok boolean", [("x", True)], [("a", False)])
    told = []
    stream = batch_starts(changes, manifests, {"domain": "market"}, results, retry="2 seconds")
    query = run_stateful(spark, stream.writeStream.foreachBatch(lambda b, _: told.extend((r.batch_id, r.attempt) for r in b.collect())).option("checkpointLocation", f"{tmp_path}/cp").trigger(processingTime="1 seconds"))
    until = time.time() + 90
    while len(told) < 2 and time.time() < until:
        time.sleep(0.5)
    query.stop()
    assert told == [("a", 1), ("a", 2)]


def test_a_start_that_raises_is_given_again(spark, tmp_path):
    changes = feed(spark, f"{tmp_path}/c", CHANGE, [("a", *DONE, ""), ("b", *DONE, "")])
    manifests = feed(spark, f"{tmp_path}/m", MANIFEST, [("a", "2024-01-01", "k", "s")])
    calls = []

    def start(batch):
        calls.append(sorted(r.batch_id for r in batch.collect()))
        if len(calls) == 1:
            raise RuntimeError("no runs today")

    def go():
        start_batches(batch_starts(changes, manifests, {"domain": "market"}), start, f"{tmp_path}/cp")

    with pytest.raises(Exception, match="no runs today"):
        go()
    go()
    go()
    assert calls == [["a"], ["a"]]


CHUNK = "batch_id long, chunk_id long, expected_chunks long"


def test_batches_complete_once(spark, tmp_path):
    chunks = feed(spark, f"{tmp_path}/in", CHUNK, [(1, 1, 2), (1, 1, 2), (2, 1, 1), (3, 1, 2), (None, 1, 1), (9, None, 1)], [(1, 1, 2), (1, 2, 2), (2, 1, 1)] + [(100 + b, c, 5) for b in range(40) for c in range(3)],
                  [(1, 2, 2), (4, 1, 5)] + [(100 + b, c, 5) for b in range(40) for c in range(2, 5)], [(3, 2, 2), (1, 1, 2), (100, 4, 5)])
    told, _ = run(spark, completions(chunks), f"{tmp_path}/cp", True)
    assert [sorted(r.batch_id for r in rows) for rows in told] == [[2], [1], list(range(100, 140)), [3]]
    # Of 44 batches only the unfinished one's chunk is left; a finished batch is a mark alone.
    left = spark.read.format("statestore").option("stateVarName", "chunks").load(f"{tmp_path}/cp").count()
    marks = spark.read.format("statestore").option("stateVarName", "batch").load(f"{tmp_path}/cp").count()
    assert (left, marks) == (1, 44)


def test_state_of_batches_expires(spark, tmp_path):
    path = f"{tmp_path}/in"
    chunks = feed(spark, path, CHUNK, [(1, 1, 2), (2, 1, 1)])
    assert [r.batch_id for rows in run(spark, completions(chunks, "2 seconds"), f"{tmp_path}/cp", True)[0] for r in rows] == [2]
    time.sleep(3)
    spark.createDataFrame([(1, 2, 2), (2, 1, 1)], CHUNK).coalesce(1).write.mode("append").parquet(path)
    told, _ = run(spark, completions(spark.readStream.schema(CHUNK).parquet(path), "2 seconds"), f"{tmp_path}/cp", True)
    assert [r.batch_id for rows in told for r in rows] == [2]  # 1's first chunk had expired, and so had 2's mark


ATTEMPT = "message_id string, seq long, outcome string, ts timestamp"


def at_second(s):
    return dt.datetime(2024, 1, 1, 0, 0, 0, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=s)


def redelivered(spark, path, limit, *batches):
    told, query = run(spark, redelivery(feed(spark, f"{path}/in", ATTEMPT, *[[(m, i, o, at_second(s)) for i, (m, o, s) in enumerate(b)] for b in batches]), limit, keep="60 seconds"), f"{path}/cp", False)
    rows = sorted((r.message_id, int((r.at - dt.datetime(2024, 1, 1)).total_seconds()), r.attempts, r.last_outcome, r.disposition) for x in told for r in x)
    return rows, spark.read.format("statestore").option("stateVarName", "message").load(f"{path}/cp").count()


@pytest.mark.parametrize("cut", [1, 3])
def test_redelivery(spark, tmp_path, cut):
    """Loads may be received three times, however their attempts are cut into micro-batches; nothing is left at the end."""
    rows = [("ok", "SUCCESS", 0), ("twice", "RETRY", 0), ("twice", "SUCCESS", 3), ("dead", "EXCEPTION", 0), ("dead", "FAIL", 2), ("dead", "PARSE_ERROR", 5), ("fast", "RETRY", 0), ("fast", "RETRY", 0), ("fast", "RETRY", 0), ("fast", "RETRY", 0),
            ("gone", "FAIL", 0), ("dead", "SUCCESS", 40), ("clock", "SUCCESS", 500)]
    rows.sort(key=lambda r: r[2])
    batches = [rows[i * len(rows) // cut : (i + 1) * len(rows) // cut] for i in range(cut)]
    got, left = redelivered(spark, tmp_path, 3, *batches)
    assert got == sorted([
        ("ok", 0, 1, "SUCCESS", "DONE"), ("twice", 1, 1, "RETRY", "REDELIVER"), ("twice", 3, 2, "SUCCESS", "DONE"), ("dead", 1, 1, "EXCEPTION", "REDELIVER"), ("dead", 4, 2, "FAIL", "REDELIVER"),
        ("dead", 9, 3, "PARSE_ERROR", "DLQ"), ("dead", 40, 1, "SUCCESS", "DONE"), ("fast", 0, 4, "RETRY", "DLQ"), ("gone", 1, 1, "FAIL", "REDELIVER"), ("gone", 61, 1, "FAIL", "EXPIRED"), ("clock", 500, 1, "SUCCESS", "DONE")])
    assert left == 0


def test_ingest_may_be_received_five_times(spark, tmp_path):
    got, left = redelivered(spark, tmp_path, 5, [("m", "RETRY", 10 * k) for k in range(5)] + [("clock", "SUCCESS", 500)])
    assert [r[2:] for r in got if r[0] == "m" and r[4] != "REDELIVER"] == [(5, "RETRY", "DLQ")] and left == 0


def test_outcomes_and_codes(spark):
    df = spark.createDataFrame([("FileNotFoundError", None, None), ("KeyError", None, None), (None, "SUCCESS", None), (None, "RETRY", None), (None, "FAIL", None), (None, None, " parse_error ")], "kind string, answer string, code string")
    got = df.select(error_code(F.col("kind")).alias("c"), outcome(F.coalesce(error_code(F.col("kind")), "code"), F.col("answer")).alias("o")).collect()
    assert [tuple(r) for r in got] == [("FILE_NOT_FOUND", "EXCEPTION"), ("UNKNOWN_ERROR", "EXCEPTION"), (None, "SUCCESS"), (None, "RETRY"), (None, "FAIL"), (None, "PARSE_ERROR")]


def test_answers_of_loads_stand_as_they_are(spark):
    rows = [("again", 1, " ", "RETRY"), ("failed", 1, None, "FAIL"), ("failed", 2, "", "FAIL"), ("done", 1, "UNHEARD_OF", None), ("done", 2, None, None), ("raised", 1, "TIMEOUT_ERROR", "RETRY"), ("unread", 1, "PARSE_ERROR", None)]
    got = attempts_by_message(spark.createDataFrame(rows, "message_id string, seq long, error_code string, action string"), 1).collect()
    assert {tuple(r) for r in got} == {("again", 1, "RETRY", "RETRY"), ("failed", 2, "FAIL", "DLQ"), ("done", 2, "SUCCESS", "DONE"), ("raised", 1, "EXCEPTION", "RETRY"), ("unread", 1, "PARSE_ERROR", "RETRY")}


def test_dead_letter_query_has_every_outcome(spark, sf_dir):
    got = {r.last_outcome for r in QUERIES["stream_dead_letter"](spark, sf_dir).select("last_outcome").distinct().collect()}
    assert got == {"SUCCESS", "FAIL", "RETRY", "PARSE_ERROR", "EXCEPTION"}


def test_m_of_n_of_a_stream_equals_the_batch(spark, tmp_path):
    rows = [("a", 0, 3.0), ("a", 300, 101.0), ("a", 600, 102.0), ("a", 1500, 500.0), ("a", 1800, 100.0), ("b", 300, 200.0), ("b", 600, 200.0), ("b", 900, 200.0)]
    schema = "series string, window_start long, value double"
    want = {tuple(r) for r in m_of_n(spark.createDataFrame(rows, schema), 2, 100).select("series", "window_start", "value", "alarm").collect()}
    assert ("a", 1800, 100.0, False) in want and ("a", 600, 102.0, True) in want and ("a", 900, 0.0, False) in want
    stream = feed(spark, f"{tmp_path}/in", schema + ", ts timestamp", *[[(*r, at(1)) for r in part] for part in ([rows[0], rows[5]], [rows[1], rows[2], rows[6], rows[7]], rows[3:5])])
    told, _ = run(spark, stream_m_of_n(stream.withWatermark("ts", "1 days"), 2, 100), f"{tmp_path}/cp", False)
    assert {tuple(r) for x in told for r in x} == want
