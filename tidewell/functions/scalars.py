"""Scalar functions on symbols, numbers, days, defaults and texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Routing priority by domain, others 3.
PRIORITY = {"market": "1", "daily-prices-data": "2", "product": "3", "analytics": "3"}
#: What a pipeline event without a name is called.
UNNAMED = {"pipeline": "Unknown Pipeline", "status": "UNKNOWN", "domain": "Unknown", "table": "Unknown", "environment": "Unknown"}
STATUS_SIGN = {"SUCCEEDED": "✅", "FAILED": "❌", "ERROR": "🚨", "TIMEOUT": "⏰", "RUNNING": "🔄", "STARTED": "🟡"}


#: White space of any kind, as Unicode has it, and the four separators of ASCII.
SPACE = r"(?U)[\s\x1c-\x1f]"
#: Ends of lines: what SPACE has of them.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def stripped(s: Column) -> Column:
    """A text without the white space at its ends: tabs and line ends too."""
    return F.regexp_replace(s, rf"\A{SPACE}+|{SPACE}+\z", "")


def normalize_symbol(s: Column) -> Column:
    return F.regexp_replace(F.upper(stripped(s)), r"\.", "-")


def safe_double(s: Column) -> Column:
    """A number, or null where the text is none; NaN stays NaN."""
    return s.try_cast("double")


def utc_day(ts: Column) -> Column:
    """UTC day as text; a time without a zone is UTC. The session's zone has to be UTC."""
    return F.date_format(F.to_timestamp(ts), "yyyy-MM-dd")


def filled(value: Column, default: str) -> Column:
    """``value`` unless null or empty."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def priority(domain: Column, table: dict[str, str] = PRIORITY) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, domain), F.lit("3"))


def correlation_id(*fields: Column) -> Column:
    """The first field that isn't blank, else a new random UUID."""
    return F.coalesce(*[F.nullif(F.trim(f), F.lit("")) for f in fields], F.expr("uuid()"))


def status_text(e: dict[str, Column]) -> Column:
    """Message of a pipeline event; details only for a failure or a success that has any of them.

    ``e`` names columns; those that it leaves out, ``execution_arn`` and ``duration`` among them, are null. A
    missing name is Unknown, a missing time now; a blank run or duration has no line.
    """
    none = F.lit(None).cast("string")
    e = {n: e.get(n, none) for n in ("pipeline", "domain", "table", "status", "environment", "timestamp", "execution_arn", "duration", "error_type", "error_message", "records", "location")}
    e |= {n: F.coalesce(e[n], F.lit(v)) for n, v in UNNAMED.items()}
    e["timestamp"] = F.coalesce(e["timestamp"], F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))
    failed = e["status"].isin("FAILED", "ERROR", "TIMEOUT") & (e["error_type"].isNotNull() | e["error_message"].isNotNull())
    done = (e["status"] == "SUCCEEDED") & (e["records"].isNotNull() | e["location"].isNotNull())
    line = lambda name, c: F.concat(F.lit(f"{name}: "), c)
    given = lambda name, c: F.when(F.coalesce(c.cast("string"), F.lit("")) != "", line(name, c.cast("string")))
    return F.concat_ws(
        "\n", line("Pipeline", e["pipeline"]), line("Domain", e["domain"]), line("Table", e["table"]), line("Status", e["status"]), line("Environment", e["environment"]), line("Timestamp", e["timestamp"]),
        given("Execution ARN", e["execution_arn"]), given("Duration", e["duration"]),
        F.when(failed, F.concat(F.lit("\nError Details:\n  Error Type: "), F.coalesce(e["error_type"], F.lit("Unknown")), F.lit("\n  Error Message: "), F.coalesce(e["error_message"], F.lit("No details available")))),
        F.when(done, F.concat(F.lit("\nSuccess Details:\n  Records Processed: "), F.coalesce(e["records"].cast("string"), F.lit("N/A")), F.lit("\n  Output Location: "), F.coalesce(e["location"], F.lit("N/A")))),
    )


def status_subject(status: Column, domain: Column, table: Column, environment: Column) -> Column:
    status, domain, table, environment = (F.coalesce(c, F.lit(UNNAMED[n])) for n, c in {"status": status, "domain": domain, "table": table, "environment": environment}.items())
    sign = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in STATUS_SIGN.items() for x in kv]), status), F.lit("❓"))
    return F.concat(sign, F.lit(" Pipeline "), status, F.lit(" - "), domain, F.lit("/"), table, F.lit(" ("), environment, F.lit(")"))
