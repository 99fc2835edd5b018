"""Data quality per day, for any number of days in one job."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICE_COLUMNS = ("price", "close", "adjusted_close")
DECIMAL_COLUMNS = ("price", "amount", "value")
ISO_UTC = r"\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+]00:00)\z"


@dataclass(frozen=True)
class Gate:
    """At least so many records a day (else a warning), and at most so many per cent critical ones."""

    min_records: int = 1
    max_critical_rate: float = 5.0


def bad_row(columns: list[str], nan_is_bad: bool = False) -> Column:
    """A row with a null symbol or a negative price; NaN counts only if asked for."""
    checks = [F.col("symbol").isNull()] if "symbol" in columns else []
    for c in PRICE_COLUMNS:
        if c in columns:
            checks.append(F.coalesce(F.col(c) < 0, F.lit(False)))
            if nan_is_bad:
                checks.append(F.coalesce(F.isnan(c), F.lit(False)))
    return reduce(lambda a, b: a | b, checks, F.lit(False))


def key_column(columns: list[str]) -> str | None:
    """What a table's rows are known by."""
    return next((c for c in ("id", "symbol") if c in columns), None)


def duplicate_groups(df: DataFrame, by: str = "ds") -> DataFrame:
    """``ds, duplicate_key_groups``: keys (``id`` if there is one, else symbol) that occur more than once; nulls are one key.

    A table with neither has no keys, and so no groups.

    Counts are pre-aggregated per (day, key), so a hot key is one row per task.
    """
    key = key_column(df.columns)
    if key is None:
        return df.groupBy(by).agg(F.lit(0).cast("long").alias("duplicate_key_groups"))
    return df.groupBy(by, key).count().groupBy(by).agg(F.count_if(F.col("count") > 1).alias("duplicate_key_groups"))


def type_issues(df: DataFrame) -> int:
    """Price, amount and value columns whose type isn't decimal; from the schema alone."""
    return sum(f.name in DECIMAL_COLUMNS and not isinstance(f.dataType, T.DecimalType) for f in df.schema)


def _row_counts(columns: list[str]) -> tuple[Column, Column]:
    """Rows with a null symbol, and negative prices; a row may count once for each price column."""
    null_symbol = F.count_if(F.col("symbol").isNull()) if "symbol" in columns else F.sum(F.lit(0))
    return null_symbol.cast("long"), sum((F.count_if(F.coalesce(F.col(c) < 0, F.lit(False))) for c in PRICE_COLUMNS if c in columns), F.lit(0).cast("long"))


def metrics(df: DataFrame, by: str = "ds") -> DataFrame:
    """Counts per day in one aggregate."""
    null_symbol, negative = _row_counts(df.columns)
    return df.groupBy(by).agg(F.count("*").alias("record_count"), null_symbol.alias("null_symbol_count"), negative.alias("negative_price_count"))


def two_decimals(x: Column) -> Column:
    """A number from 0 up as text with two decimals, rounded by its exact binary value, ties to even.

    100 times the number is split into the nearest double and what that leaves, which decides where the double
    lies halfway between two whole numbers.
    """
    p = x * 100.0
    high = x * 134217729.0 - (x * 134217729.0 - x)
    left = (high * 100.0 - p) + (x - high) * 100.0
    floor = F.floor(p)
    over = p - floor
    up = (over > 0.5) | (over == 0.5) & ((left > 0) | (left == 0) & (floor % 2 == 1))
    cents = floor + up.cast("long")
    return F.concat(F.call_function("div", cents, F.lit(100)).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))


def verdict(m: DataFrame, gate: Gate = Gate(), key_label: str = "key") -> DataFrame:
    """``m`` (counts per day) with critical and warning counts, rate, action and ordered messages."""
    n, nulls, neg = F.col("record_count"), F.col("null_symbol_count"), F.col("negative_price_count")
    dups, types = F.col("duplicate_key_groups"), F.col("invalid_numeric_type_issues")
    empty = n <= 0
    critical = nulls + neg
    rate = F.when(empty, F.lit(0.0)).otherwise(critical / n * F.lit(100.0))
    shown = two_decimals(rate)
    text = lambda *parts: F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])
    found = F.array_compact(F.array(
        F.when(nulls > 0, text("null symbol present (", nulls, " records)")),
        F.when(neg > 0, text("negative price present (", neg, " records)")),
        F.when(dups > 0, text(f"duplicate {key_label} detected (", dups, " groups)")),
        F.when(n < gate.min_records, text("low record count: ", n, f" < {gate.min_records}")),
        F.when(types > 0, text("invalid numeric type issues: ", types)),
        F.when(critical > 0, F.concat(F.lit("Critical Error Rate: "), shown, F.lit(f"% (threshold: {gate.max_critical_rate}%)"))),
    ))
    messages = F.when(empty, F.array(F.lit("NO_RAW_DATA: No records found for partition"))).when(F.size(found) == 0, F.array(F.lit("DQ OK"))).otherwise(found)
    zero = F.lit(0).cast("long")
    return m.select(
        "*", F.when(empty, zero).otherwise(critical).alias("critical_violations"),
        F.when(empty, zero).otherwise(dups + types + (n < gate.min_records).cast("long")).alias("warning_violations"),
        rate.alias("critical_error_rate"), F.when(empty | (rate > gate.max_critical_rate), "quarantine").otherwise("proceed").alias("action"),
        messages.alias("messages"),
    )


def day_verdicts(df: DataFrame, gate: Gate = Gate(), by: str = "ds") -> DataFrame:
    """Verdict of each day of ``df``: counts per (day, key) first, with those of rows beside them, then per day; one scan."""
    key = key_column(df.columns)
    null_symbol, negative = _row_counts(df.columns)
    if key is None:
        m = metrics(df, by).withColumn("duplicate_key_groups", F.lit(0).cast("long"))
        return verdict(m.withColumn("invalid_numeric_type_issues", F.lit(type_issues(df)).cast("long")), gate)
    keys = df.groupBy(by, key).agg(F.count("*").alias("n"), null_symbol.alias("nulls"), negative.alias("negatives"))
    m = keys.groupBy(by).agg(F.sum("n").alias("record_count"), F.sum("nulls").alias("null_symbol_count"), F.sum("negatives").alias("negative_price_count"), F.count_if(F.col("n") > 1).alias("duplicate_key_groups"))
    return verdict(m.withColumn("invalid_numeric_type_issues", F.lit(type_issues(df)).cast("long")), gate)


def no_data(spark: SparkSession, gate: Gate = Gate()) -> DataFrame:
    """The verdict of an input without rows: one row, of no day."""
    counts = ("record_count", "null_symbol_count", "negative_price_count", "duplicate_key_groups", "invalid_numeric_type_issues")
    return verdict(spark.range(1).select(F.lit(None).cast("string").alias("ds"), *[F.lit(0).cast("long").alias(c) for c in counts]), gate)


def split_by_verdict(df: DataFrame, verdicts: DataFrame, by: str = "ds") -> tuple[DataFrame, DataFrame]:
    """(rows of the days that pass, rows of the days that don't)."""
    failing = verdicts.where("action = 'quarantine'").select(F.col(by).alias("_day"))
    same = F.col(by).eqNullSafe(F.col("_day"))
    return df.join(failing, same, "left_anti"), df.join(failing, same, "left_semi")


def with_layer(df: DataFrame, verdicts: DataFrame, by: str = "ds") -> DataFrame:
    """``df`` with ``layer``: quarantine for the rows of the days that don't pass, else adjusted."""
    failing = verdicts.where("action = 'quarantine'").select(F.col(by).alias("_day"), F.lit("quarantine").alias("_layer"))
    return df.join(failing, F.col(by).eqNullSafe(F.col("_day")), "left").withColumn("layer", F.coalesce("_layer", F.lit("adjusted"))).drop("_day", "_layer")


def gate_rows(df: DataFrame, gate: Gate = Gate(), by: str = "ds") -> tuple[DataFrame, DataFrame]:
    """(rows of the days that pass, rows of the days that don't). Only the rate decides, so keys aren't counted."""
    m = metrics(df, by).withColumns({"duplicate_key_groups": F.lit(0).cast("long"), "invalid_numeric_type_issues": F.lit(0).cast("long")})
    return split_by_verdict(df, verdict(m, gate), by)


#: Declared rules by (domain, table).
_RULES: dict[tuple[str, str], dict] = {}


def register_rules(domain: str, table: str, rules: dict) -> None:
    """Rules: ``required_columns``, ``non_null``, ``dtypes``, ``ranges`` {column: (low, high)}, ``allow_duplicates``."""
    _RULES[domain.lower(), table.lower()] = rules


def rules_for(domain: str, table: str) -> dict:
    """The registered rules, or ones that allow all."""
    return _RULES.get((domain.lower(), table.lower()), {"allow_duplicates": True})


#: The preset of market prices.
register_rules("market", "prices", {
    "required_columns": ["symbol", "date", "close"], "non_null": ["symbol", "date", "close"],
    "dtypes": {"symbol": "str", "date": "date", "close": "float"}, "allow_duplicates": False,
})

#: Spark's types by the names of rules; other names are Spark's own.
KINDS = {"str": ("string",), "float": ("double", "float"), "int": ("bigint", "int", "smallint", "tinyint"), "bool": ("boolean",)}


def rule_report(df: DataFrame, rules: dict, key: tuple[str, ...] = ("symbol", "date")) -> DataFrame:
    """``rule, target, violations``: schema rules from the schema, all row rules in one aggregate.

    Where duplicates aren't allowed, a row gives the keys (the columns of ``key`` that there are) that occur
    more than once; nulls are one key. Counts per key come before those of all rows.
    """
    kinds, schema, rows = dict(df.dtypes), [], []
    schema += [("required", c, 0 if c in kinds else 1) for c in rules.get("required_columns", [])]
    schema += [("dtype", c, 0 if kinds.get(c) in KINDS.get(t, (t,)) else 1) for c, t in rules.get("dtypes", {}).items()]
    rows += [("non_null", c, F.col(c).isNull()) for c in rules.get("non_null", []) if c in kinds]
    for c, (low, high) in rules.get("ranges", {}).items():
        if c in kinds:
            out = (F.col(c) < low if low is not None else F.lit(False)) | (F.col(c) > high if high is not None else F.lit(False))
            rows.append(("range", c, F.coalesce(out, F.lit(False))))
    own = [c for c in key if c in kinds] if not rules.get("allow_duplicates", True) else []
    counts = [F.count_if(x).alias(f"c{i}") for i, (_, _, x) in enumerate(rows)]
    if own:
        keys = df.groupBy(*own).agg(F.count("*").alias("n"), *counts)
        counted = keys.agg(F.count_if(F.col("n") > 1).alias("dups"), *[F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i in range(len(rows))])
    else:
        counted = df.agg(*counts) if rows else df.sparkSession.range(1)
    listed = [F.struct(F.lit(r).alias("rule"), F.lit(c).alias("target"), F.lit(n).cast("long").alias("violations")) for r, c, n in schema]
    listed += [F.struct(F.lit(r).alias("rule"), F.lit(c).alias("target"), F.col(f"c{i}").alias("violations")) for i, (r, c, _) in enumerate(rows)]
    if own:
        listed.append(F.struct(F.lit("duplicates").alias("rule"), F.lit(",".join(own)).alias("target"), F.col("dups").alias("violations")))
    return counted.select(F.inline(F.array(*listed)))


def validation_report(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """``name, passed, overall`` of named checks, each a condition on aggregates of ``df``; a null condition fails."""
    held = [F.struct(F.lit(n).alias("name"), F.coalesce(c, F.lit(False)).alias("passed")) for n, c in checks.items()]
    return df.agg(F.array(*held).alias("checks")).select(F.inline("checks"), F.forall("checks", lambda c: c["passed"]).alias("overall"))


def row_contract(df: DataFrame) -> DataFrame:
    """``df`` with ``contract_errors``: the raw row's rules that fail, in order; a timestamp is ISO-8601 with a T and a UTC zone."""
    bad = lambda c: F.coalesce(F.col(c) < 0, F.lit(False))
    return df.withColumn("contract_errors", F.array_compact(F.array(
        F.when(~F.coalesce(F.col("symbol").rlike("^[A-Z0-9.-]{1,20}$"), F.lit(False)), "symbol"),
        F.when(~F.coalesce(F.col("timestamp").rlike(ISO_UTC), F.lit(False)) | F.try_to_timestamp("timestamp").isNull(), "timestamp"),
        *[F.when(bad(c), c) for c in ("open", "high", "low", "close", "adjusted_close", "volume")],
    )))
