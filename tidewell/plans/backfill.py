"""Which days to process, which to skip, and with what arguments."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.keys import LAYERED, ds_of_key, fill_from_key
from tidewell.functions.scalars import stripped


def backfill_days(ranges: DataFrame, start: str, end: str, limit: int = 31) -> DataFrame:
    """One row per day of each range, reversed or not, both ends included, the first ``limit`` days; none where an end is null or blank."""
    a, b = (F.to_date(F.nullif(stripped(F.col(c).cast("string")), F.lit(""))) for c in (start, end))
    days = F.when(a.isNotNull() & b.isNotNull(), F.slice(F.sequence(F.least(a, b), F.greatest(a, b), F.expr("interval 1 day")), 1, limit))
    return ranges.withColumn("ds", F.explode(days)).withColumn("ds", F.date_format("ds", "yyyy-MM-dd"))


def idempotent(requested: DataFrame, existing: DataFrame, on: list[str]) -> DataFrame:
    """``requested`` with ``proceed`` and ``code``: partitions that exist are skipped."""
    there = existing.select(*on).distinct().withColumn("_there", F.lit(True))
    joined = requested.join(there, on, "left")
    return joined.withColumns({"proceed": F.col("_there").isNull(), "code": F.when(F.col("_there"), "IDEMPOTENT_SKIP")}).drop("_there")


@dataclass(frozen=True)
class JobSettings:
    """What a deployment sets for its jobs. ``output_partitions`` is left out unless it is a number; then it is one at least."""

    environment: str = "dev"
    raw_bucket: str = ""
    curated_bucket: str = ""
    artifacts_bucket: str = ""
    compacted_layer: str = "compacted"
    expected_min_records: str = "100"
    max_critical_error_rate: str = "5.0"
    output_partitions: str = ""

    def partitions(self) -> str | None:
        try:
            return str(max(1, int(self.output_partitions)))
        except ValueError:
            return None


def job_arguments(plan: DataFrame, domain: Column, table_name: Column, interval: Column, source: Column, file_type: Column | None = None, settings: JobSettings = JobSettings()) -> DataFrame:
    """``plan(ds)`` with the arguments of each day's job as columns, all texts, and the day's path in each layer.

    Where ``plan`` has a ``proceed`` that is false, the day has no job and the arguments are null. ``ds`` has to
    be a day, as ``backfill_days`` gives it; what a day's prefix is made of is put together once for each row.
    """
    lit = F.lit
    given = {
        "environment": lit(settings.environment), "domain": domain, "table_name": table_name, "raw_bucket": lit(settings.raw_bucket),
        "raw_prefix": F.concat(domain, lit("/"), table_name, lit("/interval="), interval, lit("/data_source="), source, lit("/")),
        "compacted_bucket": lit(settings.curated_bucket), "curated_bucket": lit(settings.curated_bucket), "curated_layer": lit(LAYERED), "compacted_layer": lit(settings.compacted_layer),
        "schema_fingerprint_s3_uri": F.concat(lit(f"s3://{settings.artifacts_bucket}/"), domain, lit("/"), table_name, lit("/_schema/latest.json")),
        "codec": lit("zstd"), "target_file_mb": lit("256"), "expected_min_records": lit(settings.expected_min_records), "max_critical_error_rate": lit(settings.max_critical_error_rate),
        "file_type": lit("json") if file_type is None else file_type, "interval": interval, "data_source": source, "output_partitions": lit(settings.partitions()).cast("string"),
    }
    goes = F.col("proceed") if "proceed" in plan.columns else lit(True)
    part = lambda at, n: F.substring("ds", at, n)
    day = F.when(goes, F.concat(given["raw_prefix"], lit("year="), part(1, 4), lit("/month="), part(6, 2), lit("/day="), part(9, 2), lit("/layer=")))
    rows = plan.withColumn("_day", day).withColumns({n: F.when(goes, c) for n, c in given.items()})
    layers = {"compacted_path": settings.compacted_layer, "curated_path": LAYERED, "quarantine_path": "quarantine"}
    return rows.withColumns({n: F.concat("_day", lit(layer)) for n, layer in layers.items()}).drop("_day")


def backfill_items(requested: DataFrame, existing: DataFrame, domain: Column, table_name: Column, interval: Column, source: Column, file_type: Column | None = None,
                   catalog_update: Column | None = None, settings: JobSettings = JobSettings()) -> DataFrame:
    """What to do on each day of ``requested(ds)``: a job with its arguments, or none with the reason why.

    Days in ``existing(ds)`` have been processed. ``catalog_update`` is the request's policy, null unless it has one.
    """
    plan = idempotent(requested, existing, ["ds"])
    skipped = F.col("code").isNotNull()
    plan = plan.withColumns({"reason": F.when(skipped, "Already processed"), "message": F.when(skipped, "Curated partition already exists"),
                             "catalog_update": F.nullif(stripped(catalog_update), F.lit("")) if catalog_update is not None else F.lit(None).cast("string")})
    return job_arguments(plan, domain, table_name, interval, source, file_type, settings)


def preflight_code(domain: Column, table_name: Column, interval: Column, source: Column, key: Column, ds: Column, suffixes: tuple[str, ...]) -> Column:
    """Error code of a plan request, or null; a given day makes the key unnecessary."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    interval, source = fill_from_key(interval, key, "interval"), fill_from_key(source, key, "data_source")
    allowed = F.exists(F.array(*[F.lit(s.lower()) for s in suffixes]), lambda s: F.endswith(F.lower(key), s)) if suffixes else F.lit(True)
    return F.when(blank(domain) | blank(table_name) | blank(interval) | blank(source), "PRE_VALIDATION_FAILED").when(~blank(ds), F.lit(None).cast("string")).when(
        blank(key), "PRE_VALIDATION_FAILED").when(~allowed, "IGNORED_OBJECT").when(ds_of_key(key).isNull(), "PRE_VALIDATION_FAILED")


def normalized_request(df: DataFrame) -> DataFrame:
    """Plan requests with a lower-case file type (json unless given), the table name or its old alias, and clean suffixes."""
    clean = F.filter(F.transform("suffixes", stripped), lambda s: s != "")
    given = lambda c: F.coalesce(stripped(F.col(c).cast("string")) != "", F.lit(False))
    return df.withColumns({
        "file_type": F.coalesce(F.nullif(F.lower(F.trim("file_type")), F.lit("")), F.lit("json")),
        "table_name": F.trim(F.coalesce(F.nullif("table_name", F.lit("")), F.col("legacy_table"), F.lit(""))),
        "suffixes": clean, "has_range": given("range_start") & given("range_end"),
    })
