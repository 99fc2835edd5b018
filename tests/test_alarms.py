import datetime as dt

from tidewell.operators.metrics import metric_alarms
from tidewell.streaming.streams import drain_complete

AT = dt.datetime(2024, 1, 2, 3, 0, tzinfo=dt.timezone.utc)
#: (minute, metric, value): each of the five alarms once over and once under its threshold, without an error in the first window
ROWS = [
    (0, "queue_depth", 150.0), (4, "queue_depth", 50.0), (5, "queue_depth", 150.0), (9, "queue_depth", 49.0),
    (1, "oldest_age", 10.0), (2, "oldest_age", 300.0), (6, "oldest_age", 299.0), (7, "oldest_age", 299.0),
    (0, "throttles", 1.0), (5, "throttles", 0.0), (0, "job_failures", 1.0), (5, "job_failures", None),
    (0, "errors", 0.0), (5, "errors", 1.0), (0, "other", 1e9),
]
WANT = {
    (0, "queue_depth", 100.0, True), (5, "queue_depth", 99.5, False), (0, "oldest_age", 300.0, True), (5, "oldest_age", 299.0, False),
    (0, "throttles", 1.0, True), (5, "throttles", 0.0, False), (0, "job_failures", 1.0, True), (5, "job_failures", None, False),
    (0, "errors", 0.0, False), (5, "errors", 1.0, True),
}


def test_each_metric_has_its_alarm(spark, tmp_path):
    path = str(tmp_path / "metrics")
    spark.createDataFrame([(AT + dt.timedelta(minutes=m), k, v) for m, k, v in ROWS], "ts timestamp, metric string, value double").write.parquet(path)
    batch = spark.read.parquet(path)
    stream = spark.readStream.schema(batch.schema).parquet(path).withWatermark("ts", "10 minutes")
    for found in (metric_alarms(batch), drain_complete(metric_alarms(stream))):
        rows = found.selectExpr("(unix_timestamp(window_start) div 60) % 60 AS m", "metric", "value", "alarm").collect()
        assert len(rows) == len(WANT) and {tuple(r) for r in rows} == WANT
