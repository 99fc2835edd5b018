"""Keyed state machines over streams: starts of batches, completions, redelivery, alarms.

Each is a ``StatefulProcessor``; Spark shuffles its rows by key and keeps the state in RocksDB, whose provider
``run_stateful`` sets for the queries that it starts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tidewell.functions.scalars import filled
from tidewell.operators.batches import completed

#: What queries with timers, maps and expiry need. Checksum files of checkpoints are off: their threads, four for each
#: executor, wait for each other when as many partitions commit their state at once.
STATE_SETTINGS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
                  "spark.sql.streaming.checkpoint.fileChecksum.enabled": "false"}
UNITS = {"days": 86_400_000, "hours": 3_600_000, "minutes": 60_000, "seconds": 1000}


def milliseconds(duration: str) -> int:
    n, unit = duration.split()
    return int(n) * UNITS[unit]


@contextmanager
def state_settings(spark: SparkSession, ends: bool = False) -> Iterator[None]:
    """Queries that start within keep their state in RocksDB; the session's own settings come back after.

    State by the clock has Spark run on without data, to see what has expired; a run that ``ends`` with its data doesn't.
    """
    settings = STATE_SETTINGS | ({"spark.sql.streaming.noDataMicroBatches.enabled": "false"} if ends else {})
    before = {n: spark.conf.get(n, None) for n in settings}
    for n, v in settings.items():
        spark.conf.set(n, v)
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def run_stateful(spark: SparkSession, writer: DataStreamWriter, ends: bool = False) -> StreamingQuery:
    """Start a query with state of this module; one by the clock that is to stop at the end of its data ``ends``."""
    with state_settings(spark, ends):
        return writer.start()


#: Shared columns of what ``BatchStarts`` is told: a completion's fields, a manifest, or how a start went.
TOLD = "batch_id string, kind string, fields map<string,string>, ds string, manifest_key string, source string"
STARTS = "batch_id string, attempt int, fields map<string,string>, manifests array<struct<ds:string,manifest_key:string,source:string>>"


class BatchStarts(StatefulProcessor):
    """A batch is waiting, then starting, then started, and starts only with manifests.

    A completion without manifests takes no lock: the batch starts once they come, whichever comes first. While
    it is starting or started, completions that are told again do nothing. A failed start gives the lock
    back; it is tried again ``retry_ms`` later, at once if that is zero, up to ``attempts`` times, and after
    that when the batch is told complete again. State goes ``keep_ms`` after its last change.
    """

    def __init__(self, keep_ms: int, retry_ms: int = 0, attempts: int = 3):
        self.keep_ms, self.retry_ms, self.attempts = keep_ms, retry_ms, attempts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.phase = handle.getValueState("phase", "phase string, attempt int, fields map<string,string>", self.keep_ms)
        self.manifests = handle.getMapState("manifests", "ds string", "manifest_key string, source string", self.keep_ms)

    def _start(self, batch_id: str, attempt: int, fields: dict) -> Iterator[Row]:
        found = sorted((ds, key, source) for (ds,), (key, source) in self.manifests.iterator())
        if found:
            self.phase.update(("starting", attempt + 1, fields))
            yield Row(batch_id=batch_id, attempt=attempt + 1, fields=fields, manifests=[Row(ds=d, manifest_key=k, source=s) for d, k, s in found])
        else:
            self.phase.update(("waiting", attempt, fields))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # Manifests first, so that a batch starts with all that came with its completion.
        rows = sorted(rows, key=lambda r: ("manifest", "complete", "started", "failed").index(r.kind))
        known = self.phase.exists()
        phase, attempt, fields = self.phase.get() if known else ("idle", 0, None)
        told, failed, came = None, False, set()
        for r in rows:
            if r.kind == "manifest":
                if r.ds not in came and not (known and self.manifests.containsKey((r.ds,))):
                    self.manifests.updateValue((r.ds,), (r.manifest_key, r.source))
                came.add(r.ds)
            elif r.kind == "complete":
                told = told or dict(r.fields)
            elif phase == "starting":
                phase, failed = ("started", False) if r.kind == "started" else ("failed", True)
        if phase == "started":
            self.phase.update(("started", attempt, fields))
        elif failed and attempt < self.attempts and self.retry_ms:
            self.phase.update(("failed", attempt, fields))
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.retry_ms)
        elif failed and attempt < self.attempts:
            yield from self._start(key[0], attempt, fields)
        elif told and phase in ("idle", "waiting", "failed"):
            yield from self._start(key[0], 0, told)
        elif failed:
            self.phase.update(("failed", attempt, fields))
        elif phase == "waiting":
            yield from self._start(key[0], attempt, fields)
        elif not known:
            self.phase.update(("idle", 0, None))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        phase, attempt, fields = self.phase.get() if self.phase.exists() else ("idle", 0, None)
        if phase == "failed" and attempt < self.attempts:
            yield from self._start(key[0], attempt, fields)


def _told(df: DataFrame, kind: Column | str, **columns: Column) -> DataFrame:
    none = {"fields": F.lit(None).cast("map<string,string>"), **{c: F.lit(None).cast("string") for c in ("ds", "manifest_key", "source")}}
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return df.select(F.col("batch_id").cast("string").alias("batch_id"), kind.alias("kind"), *[columns.get(n, c).alias(n) for n, c in none.items()])


def batch_starts(changes: DataFrame, manifests: DataFrame, defaults: dict[str, str], results: DataFrame | None = None, keep: str = "7 days", retry: str = "0 seconds", attempts: int = 3) -> DataFrame:
    """A stream of starts ``batch_id, attempt, fields, manifests``: each batch that is complete and has manifests, once, see ``BatchStarts``.

    ``changes`` are those of the trackers (``completed`` picks the completions), ``manifests(batch_id, ds,
    manifest_key, source)`` the batches' manifests, of which the first of a day counts, and ``results(batch_id,
    ok)`` say how starts went. ``fields`` are the tracker's ``meta_`` values, or ``defaults`` where these are blank.
    """
    done = completed(changes)
    fields = F.create_map(*[x for n, v in defaults.items() for x in (F.lit(n), filled(F.col(f"meta_{n}") if f"meta_{n}" in changes.columns else F.lit(None).cast("string"), v))])
    told = _told(done, "complete", fields=fields).unionByName(_told(manifests.where("batch_id IS NOT NULL AND ds <> '' AND manifest_key <> ''"), "manifest", ds=F.col("ds"), manifest_key=F.col("manifest_key"), source=F.col("source")))
    if results is not None:
        told = told.unionByName(_told(results.where("batch_id IS NOT NULL AND ok IS NOT NULL"), F.when(F.col("ok"), "started").otherwise("failed")))
    processor = BatchStarts(milliseconds(keep), milliseconds(retry), attempts)
    return told.groupBy("batch_id").transformWithState(processor, STARTS, "append", "ProcessingTime")


def start_batches(starts: DataFrame, start: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Run a stream of ``batch_starts`` over all that is there: ``start`` gets each micro-batch's starts.

    A micro-batch whose ``start`` raises fails the query; a restart from the checkpoint gives the same starts
    again, as their state wasn't kept.
    """

    def put(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            start(batch)

    writer = starts.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = run_stateful(starts.sparkSession, writer, ends=True)
    query.awaitTermination()
    return query


class Completions(StatefulProcessor):
    """The chunks of a batch that have come, one map entry each, until it is complete; then a mark alone, until it expires."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.batch = handle.getValueState("batch", "done boolean, n long, expected long", self.keep_ms)
        self.chunks = handle.getMapState("chunks", "chunk_id long", "there boolean", self.keep_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.batch.get() if self.batch.exists() else None
        if known and known[0]:
            return
        n, expected, came = (known[1], known[2], set()) if known else (0, 0, set())
        for r in rows:
            came.add(r.chunk_id)
            expected = max(expected, r.expected_chunks)
        if n:
            came = {c for c in came if not self.chunks.containsKey((c,))}
        if n + len(came) >= expected:
            if n:
                self.chunks.clear()
            self.batch.update((True, n + len(came), expected))
            yield Row(batch_id=key[0], expected_chunks=expected)
        elif came:
            for c in came:
                self.chunks.updateValue((c,), (True,))
            self.batch.update((False, n + len(came), expected))


def completions(chunks: DataFrame, keep: str = "7 days") -> DataFrame:
    """``batch_id, expected_chunks`` of each batch when it is complete, once.

    ``chunks(batch_id, chunk_id, expected_chunks)`` is a stream; a chunk that is delivered again counts once,
    however late. A chunk is an entry of its own in the state, which a new chunk adds to without rewriting the
    others; a complete batch's are dropped. What is left expires ``keep`` after its last change. Rows without a
    batch, a chunk or an expected number are left out.
    """
    rows = chunks.where("batch_id IS NOT NULL AND chunk_id IS NOT NULL AND expected_chunks IS NOT NULL").select(*[F.col(c).cast("long").alias(c) for c in ("batch_id", "chunk_id", "expected_chunks")])
    return rows.groupBy("batch_id").transformWithState(Completions(milliseconds(keep)), "batch_id long, expected_chunks long", "append", "ProcessingTime")


DELIVERIES = "message_id string, attempts int, last_outcome string, disposition string, at timestamp"


def _time(ms: int) -> datetime:
    return datetime.fromtimestamp(ms / 1000, timezone.utc).replace(tzinfo=None)


class Redelivery(StatefulProcessor):
    """Receives of a message until it is done or dead.

    An attempt without success hides the message for a while, longer each time. Then it is due again, or dead
    if it has been received ``max_receives`` times; a receive beyond that number kills it at once. A message
    that is due and not received for ``keep_ms`` is dropped. Nothing is left of a message that has ended; one
    that comes again after that is a new one. Times are those of the attempts, so results don't depend on how
    these are cut into micro-batches.
    """

    def __init__(self, max_receives: int, backoff_ms: list[int], keep_ms: int):
        self.max_receives, self.backoff_ms, self.keep_ms = max_receives, backoff_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.message = handle.getValueState("message", "attempts int, outcome string, due long, told boolean")

    def _fire(self, key, state, now: int):
        """(rows, state) after all that is due by ``now``."""
        out = []
        while state and state[2] <= now:
            attempts, outcome, due, told = state
            if attempts >= self.max_receives:
                out.append(self._row(key, attempts, outcome, "DLQ", due))
                state = None
            elif told:
                out.append(self._row(key, attempts, outcome, "EXPIRED", due))
                state = None
            else:
                out.append(self._row(key, attempts, outcome, "REDELIVER", due))
                state = (attempts, outcome, due + self.keep_ms, True)
        return out, state

    @staticmethod
    def _row(key, attempts: int, outcome: str, disposition: str, ms: int) -> Row:
        return Row(message_id=key[0], attempts=attempts, last_outcome=outcome, disposition=disposition, at=_time(ms))

    def _keep(self, state) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if state:
            self.message.update(state)
            self.handle.registerTimer(state[2])
        elif self.message.exists():
            self.message.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state = self.message.get() if self.message.exists() else None
        for r in sorted(rows, key=lambda r: (r.ms, r.seq)):
            due, state = self._fire(key, state, r.ms)
            yield from due
            attempts = (state[0] if state else 0) + 1
            if r.outcome == "SUCCESS" or attempts > self.max_receives:
                yield self._row(key, attempts, r.outcome, "DONE" if r.outcome == "SUCCESS" else "DLQ", r.ms)
                state = None
            else:
                state = (attempts, r.outcome, r.ms + self.backoff_ms[min(attempts, len(self.backoff_ms)) - 1], False)
        self._keep(state)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # All that is due by now: what follows from one timer may be past as well.
        due, state = self._fire(key, self.message.get() if self.message.exists() else None, max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()))
        yield from due
        self._keep(state)


def redelivery(attempts: DataFrame, max_receives: int, backoff: tuple[str, ...] = ("1 seconds", "2 seconds", "4 seconds"), delay: str = "0 seconds", keep: str = "7 days") -> DataFrame:
    """What becomes of the messages of a stream of attempts: ``message_id, attempts, last_outcome, disposition, at``.

    ``attempts(message_id, seq, outcome, ts)``; ``seq`` orders those of one time. A row says that a message is
    DONE, is due again (REDELIVER), is dead (DLQ), or was due and never came (EXPIRED); see ``Redelivery``.
    ``delay`` is how late attempts may be. Rows without a message or a time are left out.
    """
    ms = (F.unix_micros("ts") / 1000).cast("long")
    rows = attempts.where("message_id IS NOT NULL AND ts IS NOT NULL").withWatermark("ts", delay).select(F.col("message_id").cast("string").alias("message_id"), F.col("seq").cast("long").alias("seq"), "outcome", ms.alias("ms"), "ts")
    processor = Redelivery(max_receives, [milliseconds(b) for b in backoff], milliseconds(keep))
    return rows.groupBy("message_id").transformWithState(processor, DELIVERIES, "append", "EventTime")


class LastWindows(StatefulProcessor):
    """The last ``periods`` - 1 windows of a series; a gap between windows is windows of zero."""

    def __init__(self, periods: int, threshold: float, step: int):
        self.periods, self.threshold, self.step = periods, threshold, step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getValueState("ring", "last long, run int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last, run = self.ring.get() if self.ring.exists() else (None, 0)
        for r in sorted(rows, key=lambda r: r.window_start):
            while last is not None and last + self.step < r.window_start:
                last += self.step
                run = min(self.periods, run + 1) if 0 > self.threshold else 0
                yield Row(series=key[0], window_start=last, value=0.0, alarm=run >= self.periods)
            last = r.window_start
            run = min(self.periods, run + 1) if r.value > self.threshold else 0
            yield Row(series=key[0], window_start=last, value=float(r.value), alarm=run >= self.periods)
        self.ring.update((last, run))


def stream_m_of_n(windows: DataFrame, periods: int, threshold: float, minutes: int = 5) -> DataFrame:
    """``series, window_start, value, alarm`` as the batch operator ``m_of_n`` has them, as windows close.

    ``windows(series, window_start, value)`` is a stream that has each closed window once, in order of its
    micro-batches: an aggregate by window in append mode, whose watermark closes it. A series keeps its last
    window and how many above the threshold it ends with. Windows without rows are told when the next one
    with rows closes.
    """
    processor = LastWindows(periods, float(threshold), minutes * 60)
    rows = windows.select("series", F.col("window_start").cast("long").alias("window_start"), F.col("value").cast("double").alias("value"))
    return rows.groupBy("series").transformWithState(processor, "series string, window_start long, value double, alarm boolean", "append", "EventTime")
