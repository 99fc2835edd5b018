"""From new curated files to validated, prioritised load messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.keys import BUCKET, curated_key_error, first_of, is_curated_key, parse_curated_key, whole
from tidewell.functions.scalars import PRIORITY, priority, stripped

MIN_FILE_BYTES = 1024
#: Fields of a message that equal the key's, with their names in texts; fields that have a format, in order.
EQUAL = (("domain", "Domain"), ("table_name", "Table name"), ("interval", "Interval"), ("layer", "Layer"), ("year", "Year"), ("month", "Month"), ("day", "Day"), ("data_source", "Data source"), ("ds", "ds"))
FORMATTED = ("interval", "data_source", "year", "month", "day", "layer", "ds")
#: Codes of the errors that a load may raise, by their kind; others are unknown.
ERROR_CODES = {"FileNotFoundError": "FILE_NOT_FOUND", "TimeoutError": "TIMEOUT_ERROR", "ConnectionError": "CONNECTION_ERROR", "PermissionError": "PERMISSION_ERROR",
               "MemoryError": "MEMORY_ERROR", "ValueError": "VALIDATION_ERROR"}


def _wanted(layers: tuple[str, ...], domains: tuple[str, ...]) -> tuple[Column, Column, Column, Column, Column]:
    """What an event that passes fulfils: size, type, bucket, layer, domain."""
    key = parse_curated_key(F.col("key"))
    return (F.coalesce(F.col("size") >= MIN_FILE_BYTES, F.lit(False)), (F.col("source") == "aws.s3") & (F.col("detail_type") == "Object Created"),
            F.coalesce(F.col("bucket").rlike(BUCKET), F.lit(False)), key["layer"].isin(*layers) if layers else F.lit(True), key["domain"].isin(*domains))


def passes(layers: tuple[str, ...] = (), domains: tuple[str, ...] = tuple(PRIORITY)) -> Column:
    """Whether a file event (source, detail_type, bucket, key, size) gives a message; the same as a null ``skip_reason``, for less."""
    size, kind, bucket, layer, domain = _wanted(layers, domains)
    return size & kind & bucket & is_curated_key(F.col("key")) & layer & domain


def skip_reason(layers: tuple[str, ...] = (), domains: tuple[str, ...] = tuple(PRIORITY)) -> Column:
    """Why a file event gives no message, or null; no layers means all."""
    size, kind, bucket, layer, domain = _wanted(layers, domains)
    key = F.col("key")
    return F.when(~size, "File size below threshold").when(~F.coalesce(kind, F.lit(False)), "Unsupported event type").when(
        ~is_curated_key(key), curated_key_error(key)).when(~bucket, "Invalid S3 bucket format").when(
        ~layer, F.concat(F.lit("Layer not allowed: "), parse_curated_key(key)["layer"])).when(~domain, "Unknown domain")


def load_gate(events: DataFrame, layers: tuple[str, ...] = (), domains: tuple[str, ...] = tuple(PRIORITY)) -> DataFrame:
    """``events`` with ``skip_reason``; rows with null go on."""
    return events.withColumn("skip_reason", skip_reason(layers, domains))


def without_quarantine(files: DataFrame, key: str = "key") -> DataFrame:
    """Files that a catalog may show: no quarantined layer, no temporary folder, no marker of a commit."""
    name = F.element_at(F.split(key, "/"), -1)
    hidden = F.contains(key, F.lit("/_temporary/")) | name.isin("_SUCCESS", "_started", "_committed") | name.rlike(r"\A_(started|committed)_")
    return files.where(~F.contains(key, F.lit("/layer=quarantine/")) & ~hidden)


def load_messages(events: DataFrame, layers: tuple[str, ...] = (), domains: tuple[str, ...] = tuple(PRIORITY), correlation: Column | None = None) -> DataFrame:
    """Messages of the events that pass: the fields of the key, and sink columns ``message_key, body, headers``."""
    passed = events.where(passes(layers, domains))
    fields = parse_curated_key(F.col("key"))
    rows = passed.select("bucket", "key", *[c.alias(n) for n, c in fields.items()], F.col("size").alias("file_size"), (correlation if correlation is not None else F.expr("uuid()")).alias("correlation_id"))
    body = F.to_json(F.struct(*rows.columns))
    headers = F.create_map(F.lit("ContentType"), F.lit("application/json"), F.lit("Domain"), F.col("domain"), F.lit("TableName"), F.col("table_name"), F.lit("Priority"), priority(F.col("domain")))
    return rows.select("*", priority(F.col("domain")).alias("priority"), F.col("key").alias("message_key"), body.alias("body"), headers.alias("headers"))


def message_rejects(events: DataFrame, layers: tuple[str, ...] = (), domains: tuple[str, ...] = tuple(PRIORITY)) -> DataFrame:
    """The events that give no message, with ``skip_reason``: together with ``load_messages`` all of them."""
    return load_gate(events, layers, domains).where("skip_reason IS NOT NULL")


def is_uuid(text: Column) -> Column:
    """Whether a text is a UUID in any of its forms: with or without hyphens, braces or prefixes, of any version."""
    bare = F.replace(F.regexp_replace(F.replace(F.replace(text, F.lit("urn:"), F.lit("")), F.lit("uuid:"), F.lit("")), r"\A[{}]+|[{}]+\z", ""), F.lit("-"), F.lit(""))
    return F.coalesce(bare.rlike(r"\A[0-9a-fA-F]{32}\z"), F.lit(False))


def message_error() -> Column:
    """Why a load message's columns are invalid, or null. Bucket, key, equality with the key, formats, id, size and URL, in this order."""
    key = parse_curated_key(F.col("key"))
    field = lambda n: F.coalesce(~F.col(n).rlike(whole(n)), F.lit(n != "data_source"))
    rest = first_of(
        *((~F.col(n).eqNullSafe(key[n]), f"{label} does not match S3 key") for n, label in EQUAL),
        *((field(n), f"Invalid {n} format") for n in FORMATTED),
        (~is_uuid(F.col("correlation_id")), "Invalid correlation_id"),
        (F.coalesce(F.col("file_size") <= 0, F.lit(False)), "file_size must be positive"),
        (F.coalesce(~F.startswith(F.col("presigned_url"), F.lit("https://")), F.lit(False)), "presigned_url must be https"),
    )
    return F.when(F.coalesce(~F.col("bucket").rlike(BUCKET), F.lit(True)), "Invalid S3 bucket format").when(~is_curated_key(F.col("key")), curated_key_error(F.col("key"))).otherwise(rest)


def error_code(kind: Column) -> Column:
    """Code of a raised error by its kind; null for none."""
    known = F.create_map(*[F.lit(x) for kv in ERROR_CODES.items() for x in kv])
    return F.when(kind.isNotNull(), F.coalesce(F.try_element_at(known, kind), F.lit("UNKNOWN_ERROR")))


def outcome(error_code: Column, action: Column | None = None) -> Column:
    """Outcome of an attempt: PARSE_ERROR for a body that isn't parsed, EXCEPTION for any raised error, else what the load answered.

    Without an error and an ``action`` it is SUCCESS; an answer is SUCCESS, RETRY or any other, which fails.
    """
    code = F.nullif(F.upper(stripped(error_code)), F.lit(""))
    answer = F.coalesce(action, F.lit("SUCCESS")) if action is not None else F.lit("SUCCESS")
    return F.when(code == "PARSE_ERROR", "PARSE_ERROR").when(code.isNotNull(), "EXCEPTION").otherwise(answer)


def ledger(rows: DataFrame, *also: Column) -> DataFrame:
    """One row per file of a loaded table: name, records and bytes, from the files' metadata, and ``also`` of them."""
    return rows.groupBy(*also, F.col("_metadata.file_path").alias("file_path")).agg(F.count("*").alias("record_count"), F.max("_metadata.file_size").alias("file_size"))
