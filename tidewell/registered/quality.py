from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.operators.quality import Gate, bad_row, day_verdicts, duplicate_groups, gate_rows, metrics, row_contract as contract, rule_report as report, rules_for, validation_report as validated
from tidewell.registered.prices import PRICES
from tidewell.registered.registry import query
from tidewell.views import view

GATE = Gate(min_records=20)
METRICS = PRICES + """, m AS (SELECT ds, count(*) AS record_count, count(*) FILTER (WHERE symbol IS NULL) AS null_symbol_count,
 count(*) FILTER (WHERE close < 0) + count(*) FILTER (WHERE adjusted_close < 0) AS negative_price_count FROM prices GROUP BY ds),
d AS (SELECT ds, count(*) FILTER (WHERE n > 1) AS duplicate_key_groups FROM (SELECT ds, symbol, count(*) AS n FROM prices GROUP BY ds, symbol) GROUP BY ds),
c AS (SELECT m.*, duplicate_key_groups, CAST(0 AS BIGINT) AS invalid_numeric_type_issues, null_symbol_count + negative_price_count AS critical FROM m JOIN d USING (ds)),
v AS (SELECT *, critical / record_count * 100.0E0 AS rate FROM c)"""


@query(f"{PRICES} SELECT * FROM prices WHERE symbol IS NULL OR close < 0 OR adjusted_close < 0")
def bad_rows(spark, sf_dir):
    df = view(spark, sf_dir, "prices")
    return df.where(bad_row(df.columns))


@query(f"{METRICS} SELECT * FROM m")
def dq_metrics(spark, sf_dir):
    return metrics(view(spark, sf_dir, "prices"))


@query(f"{METRICS} SELECT * FROM d")
def dq_duplicates(spark, sf_dir):
    return duplicate_groups(view(spark, sf_dir, "prices"))


@query(METRICS + f""" SELECT ds, record_count, null_symbol_count, negative_price_count, duplicate_key_groups, critical AS critical_violations,
 duplicate_key_groups + CASE WHEN record_count < {GATE.min_records} THEN 1 ELSE 0 END AS warning_violations, rate AS critical_error_rate,
 CASE WHEN rate > {GATE.max_critical_rate} THEN 'quarantine' ELSE 'proceed' END AS action,
 coalesce(nullif(concat_ws('; ', CASE WHEN null_symbol_count > 0 THEN 'null symbol present (' || null_symbol_count || ' records)' END,
  CASE WHEN negative_price_count > 0 THEN 'negative price present (' || negative_price_count || ' records)' END,
  CASE WHEN duplicate_key_groups > 0 THEN 'duplicate key detected (' || duplicate_key_groups || ' groups)' END,
  CASE WHEN record_count < {GATE.min_records} THEN 'low record count: ' || record_count || ' < {GATE.min_records}' END,
  CASE WHEN critical > 0 THEN 'Critical Error Rate: ' || printf('%.2f', rate) || '% (threshold: {GATE.max_critical_rate}%)' END), ''), 'DQ OK') AS messages FROM v""")
def dq_verdict(spark, sf_dir):
    v = day_verdicts(view(spark, sf_dir, "prices"), GATE).drop("invalid_numeric_type_issues")
    return v.withColumn("messages", F.array_join("messages", "; "))


@query(f"{METRICS} SELECT p.* FROM prices p JOIN v USING (ds) WHERE rate <= {GATE.max_critical_rate}")
def dq_gate_pass(spark, sf_dir):
    return gate_rows(view(spark, sf_dir, "prices"), GATE)[0]


@query(f"{METRICS} SELECT p.* FROM prices p JOIN v USING (ds) WHERE rate > {GATE.max_critical_rate}")
def quarantine_rows(spark, sf_dir):
    return gate_rows(view(spark, sf_dir, "prices"), GATE)[1]


@query(f"""{PRICES} SELECT * FROM (VALUES ('required', 'symbol', 0), ('required', 'date', 0), ('required', 'close', 0), ('dtype', 'symbol', 0), ('dtype', 'date', 0), ('dtype', 'close', 0)) t(rule, target, violations)
 UNION ALL SELECT 'non_null', 'symbol', count(*) FILTER (WHERE symbol IS NULL) FROM prices UNION ALL SELECT 'non_null', 'date', count(*) FILTER (WHERE ds IS NULL) FROM prices
 UNION ALL SELECT 'non_null', 'close', count(*) FILTER (WHERE close IS NULL) FROM prices
 UNION ALL SELECT 'duplicates', 'symbol,date', count(*) FROM (SELECT symbol, ds FROM prices GROUP BY ALL HAVING count(*) > 1)""")
def rule_report(spark, sf_dir):
    return report(view(spark, sf_dir, "prices").withColumn("date", F.to_date("ds")), rules_for("MARKET", "Prices"))


_RANGED = {"required_columns": ["symbol", "spread"], "dtypes": {"volume": "bigint", "close": "date"}, "ranges": {"close": (0.0, None), "adjusted_close": (0.0, None), "volume": (1, 40), "spread": (0, 1)}}


@query(f"""{PRICES} SELECT * FROM (VALUES ('required', 'symbol', 0), ('required', 'spread', 1), ('dtype', 'volume', 0), ('dtype', 'close', 1)) t(rule, target, violations)
 UNION ALL SELECT 'range', 'close', count(*) FILTER (WHERE close < 0) FROM prices UNION ALL SELECT 'range', 'adjusted_close', count(*) FILTER (WHERE adjusted_close < 0) FROM prices
 UNION ALL SELECT 'range', 'volume', count(*) FILTER (WHERE volume < 1 OR volume > 40) FROM prices""")
def rule_ranges(spark, sf_dir):
    """Rules of a table's own: ranges, a column that isn't there, a type that differs."""
    return report(view(spark, sf_dir, "prices"), _RANGED)


@query(f"""{PRICES} SELECT symbol, ds, concat_ws(',', CASE WHEN symbol IS NULL THEN 'symbol' END, CASE WHEN volume > 45 THEN 'timestamp' END, CASE WHEN close < 0 THEN 'close' END, CASE WHEN adjusted_close < 0 THEN 'adjusted_close' END,
 CASE WHEN open < 0 THEN 'open' END) AS contract_errors FROM prices""")
def row_contract(spark, sf_dir):
    # A day alone, a text and a time of another zone are no ISO time in UTC.
    wrong = F.when(F.col("volume") == 46, F.col("ds")).when(F.col("volume") == 47, "noon").when(F.col("volume") > 47, F.concat("ds", F.lit("T00:00:00+02:00")))
    df = contract(view(spark, sf_dir, "prices").withColumn("timestamp", F.coalesce(wrong, F.concat("ds", F.lit("T00:00:00Z")))))
    return df.select("symbol", "ds", F.array_join("contract_errors", ",").alias("contract_errors"))


@query(f"""{PRICES}, r AS (SELECT 'symbol' AS name, count(*) FILTER (WHERE symbol IS NULL) = 0 AS passed FROM prices UNION ALL SELECT 'price', count(*) FILTER (WHERE close < 0) = 0 FROM prices
 UNION ALL SELECT 'rows', count(*) >= 1 FROM prices) SELECT name, passed, (SELECT bool_and(passed) FROM r) AS overall FROM r""")
def validation_report(spark, sf_dir):
    """Named checks of one aggregate, each with the overall result."""
    checks = {"symbol": F.count_if(F.col("symbol").isNull()) == 0, "price": F.count_if(F.col("close") < 0) == 0, "rows": F.count("*") >= 1}
    return validated(view(spark, sf_dir, "prices"), checks)
