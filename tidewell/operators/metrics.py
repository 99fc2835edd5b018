"""Error counters and alarms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Fixed values: (threshold, statistic) of the operational alarms.
THRESHOLDS = {"queue_depth": (100.0, "avg"), "oldest_age": (300.0, "max"), "errors": (1.0, "sum"), "throttles": (1.0, "sum"), "job_failures": (1.0, "sum")}


def normalized_errors(df: DataFrame) -> DataFrame:
    """Errors with a source and a message; severity ERROR, type UnknownError and an empty ``context``, if there is one, where none is given."""
    given = {"severity": F.coalesce("severity", F.lit("ERROR")), "error_type": F.coalesce("error_type", F.lit("UnknownError"))}
    if "context" in df.columns:
        given["context"] = F.coalesce("context", F.create_map().cast("map<string,string>"))
    return df.where("source IS NOT NULL AND source <> '' AND error_message IS NOT NULL AND error_message <> ''").withColumns(given)


def error_counts(df: DataFrame) -> DataFrame:
    """``metric, source, error_type, severity, domain, n``: the total and the severity's own counter, from one aggregate.

    ``environment`` and ``table_name`` are dimensions too where ``df`` has them.
    """
    by = ["source", "error_type", "severity", "domain"] + [c for c in ("environment", "table_name") if c in df.columns]
    counts = normalized_errors(df).groupBy(*by).agg(F.count("*").alias("n"))
    names = F.explode(F.array(F.lit("ErrorCount"), F.concat("severity", F.lit("Count"))))
    return counts.select(names.alias("metric"), *by, "n")


def windowed(df: DataFrame, minutes: int = 5) -> DataFrame:
    """Tumbling windows: errors and the mean value in each, for a batch or a stream."""
    return df.groupBy(F.window("ts", f"{minutes} minutes")).agg(F.count_if(F.col("source") == "error").alias("errors"), F.count("*").alias("n"), F.avg("value").alias("depth")).select(
        F.col("window.start").alias("window_start"), "errors", "n", "depth")


def metric_alarms(df: DataFrame, minutes: int = 5) -> DataFrame:
    """Per tumbling window and metric of ``THRESHOLDS``: ``window_start, metric, statistic, value, threshold, alarm``.

    ``df(ts, metric, value)`` is a batch or a stream; metrics without a threshold are left out, and a window
    has a row for each metric that reports in it. A null value counts for nothing.
    """
    rows = df.where(F.col("metric").isin(*THRESHOLDS)).groupBy(F.window("ts", f"{minutes} minutes"), "metric").agg(F.avg("value").alias("avg"), F.max("value").cast("double").alias("max"), F.sum("value").cast("double").alias("sum"))
    of = lambda pick: F.coalesce(*[F.when(F.col("metric") == m, pick(*t)) for m, t in THRESHOLDS.items()])
    shown = rows.select(F.col("window.start").alias("window_start"), "metric", of(lambda _, s: F.lit(s)).alias("statistic"), of(lambda _, s: F.col(s)).alias("value"), of(lambda t, _: F.lit(t)).alias("threshold"))
    return shown.withColumn("alarm", F.coalesce(F.col("value") >= F.col("threshold"), F.lit(False)))


def m_of_n(windows: DataFrame, periods: int, threshold: float, minutes: int = 5) -> DataFrame:
    """Alarm per window when all of the last ``periods`` windows are above the threshold; windows without rows count as zero.

    ``windows(series, window_start, value)`` with the start in whole epoch seconds; the grid of each series
    spans its own first to last window.
    """
    step = minutes * 60
    grid = windows.groupBy("series").agg(F.min("window_start").alias("lo"), F.max("window_start").alias("hi")).select("series", F.explode(F.sequence("lo", "hi", F.lit(step).cast("long"))).alias("window_start"))
    full = grid.join(windows, ["series", "window_start"], "left").withColumn("value", F.coalesce("value", F.lit(0)))
    last = Window.partitionBy("series").orderBy("window_start").rowsBetween(-(periods - 1), 0)
    return full.withColumn("alarm", F.sum((F.col("value") > threshold).cast("int")).over(last) == periods)


def dead_letters(attempts: DataFrame, max_receives: int) -> DataFrame:
    """Per message: attempts, last outcome and where it ends; beyond ``max_receives`` without success it is dead."""
    agg = attempts.groupBy("message_id").agg(F.count("*").alias("attempts"), F.max_by("outcome", "seq").alias("last_outcome"))
    return agg.withColumn("disposition", F.when(F.col("last_outcome") == "SUCCESS", "DONE").when(F.col("attempts") > max_receives, "DLQ").otherwise("RETRY"))
