"""Object keys of the layered store: building, parsing and checking."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The formats of key segments and message fields.
FORMATS = {
    "domain": r"[a-z0-9-]{1,50}",
    "table_name": r"[a-z0-9_]{1,50}",
    "interval": r"[a-z0-9_-]{1,50}",
    "data_source": r"[a-z0-9_-]{1,100}",
    "year": r"\d{4}",
    "month": r"0[1-9]|1[0-2]",
    "day": r"0[1-9]|[12]\d|3[01]",
    "layer": r"[a-z0-9_-]{1,50}",
    "ds": r"\d{4}-\d{2}-\d{2}",
}
BUCKET = r"\A[a-z0-9][a-z0-9.-]{1,61}[a-z0-9]\z"
#: The layer that curated days are in.
LAYERED = "adjusted"
_NAMED = ("interval", "data_source", "year", "month", "day", "layer")
#: A whole curated key; its groups are the fields before ``ds``, in order.
_CURATED = rf"\A({FORMATS['domain']})/({FORMATS['table_name']})/interval=({FORMATS['interval']})(?:/data_source=({FORMATS['data_source']}))?" + "".join(
    f"/{n}=({FORMATS[n]})" for n in ("year", "month", "day", "layer")) + r"/(?s:.*)\.parquet\z"


def whole(name: str) -> str:
    """Pattern of a text that is a field in full."""
    return rf"\A(?:{FORMATS[name]})\z"


def first_of(*checks: tuple[Column, str]) -> Column:
    """The text of the first check that holds, else null."""
    return reduce(lambda chain, c: chain.when(F.coalesce(c[0], F.lit(True)), c[1]), checks[1:], F.when(F.coalesce(checks[0][0], F.lit(True)), checks[0][1]))


def _parts(key: Column) -> tuple[Column, dict[str, Column]]:
    p = F.split(key, "/", -1)
    sourced = (F.size(p) > 7) & F.startswith(F.get(p, F.lit(3)), F.lit("data_source="))
    at = F.when(sourced, 4).otherwise(3)
    where = {"interval": F.get(p, F.lit(2)), "data_source": F.when(sourced, F.get(p, F.lit(3)))}
    return p, where | {n: F.get(p, at + i) for i, n in enumerate(("year", "month", "day", "layer"))}


def is_curated_key(key: Column) -> Column:
    """Whether a key is a curated Parquet file's: one match, for what needs no reason. False for null."""
    return F.coalesce(key.rlike(_CURATED), F.lit(False))


def curated_key_error(key: Column) -> Column:
    """Why a key is no curated Parquet file's, or null; the first failing rule decides."""
    p, seg = _parts(key)
    bad = lambda n: ~seg[n].rlike(rf"\A{n}=(?:{FORMATS[n]})\z")
    reason = first_of(
        (key == "", "key must be a non-empty string"),
        (F.size(p) < 8, "Invalid curated key format"),
        (~F.get(p, F.lit(0)).rlike(whole("domain")), "Invalid domain in key"),
        (~F.get(p, F.lit(1)).rlike(whole("table_name")), "Invalid table in key"),
        (bad("interval"), "Invalid interval segment in key"),
        (seg["data_source"].isNotNull() & F.coalesce(bad("data_source"), F.lit(False)), "Invalid data_source segment in key"),
        *((bad(n), f"Invalid {n} segment in key") for n in ("year", "month", "day", "layer")),
        (~F.endswith(key, F.lit(".parquet")), "Load objects must be Parquet files"),
    )
    return F.when(~is_curated_key(key), reason)


def parse_curated_key(key: Column) -> dict[str, Column]:
    """Columns of a valid key; check ``is_curated_key`` or ``curated_key_error`` first."""
    out = {n: F.regexp_extract(key, _CURATED, i) for i, n in enumerate(("domain", "table_name", *_NAMED), 1)}
    out["data_source"] = F.nullif(out["data_source"], F.lit(""))
    return out | {"ds": F.concat_ws("-", out["year"], out["month"], out["day"])}


def _found(key: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(key, pattern, group), F.lit(""))


def ds_of_key(key: Column) -> Column:
    """Day of a raw key: a legacy ``ingestion_date=`` first, else its year, month and day."""
    parts = [_found(key, r"year=(\d{4})/month=(\d{2})/day=(\d{2})", g) for g in (1, 2, 3)]
    return F.coalesce(_found(key, r"ingestion_date=(\d{4}-\d{2}-\d{2})"), F.when(parts[0].isNotNull(), F.concat_ws("-", *parts)))


def manifest_ds(key: Column) -> Column:
    """Day of a manifest key: year, month and day first, else a legacy ``ds=``."""
    parts = [_found(key, r"year=(\d{4})/month=(\d{2})/day=(\d{2})", g) for g in (1, 2, 3)]
    return F.coalesce(F.when(parts[0].isNotNull(), F.concat_ws("-", *parts)), _found(key, r"ds=(\d{4}-\d{2}-\d{2})"))


def fill_from_key(value: Column, key: Column, name: str) -> Column:
    """A given value that isn't blank, else the key's ``name=`` segment."""
    return F.coalesce(F.nullif(F.trim(value), F.lit("")), _found(key, f"{name}=([^/]+)/"))


def _day_path(domain: Column, table: Column, interval: Column, source: Column, ds: Column, *rest: Column) -> Column:
    """A day's prefix and what follows it; a blank source leaves its segment out, a day that is none gives null."""
    day = F.when(ds.rlike(whole("ds")), F.split(ds, "-"))
    source = F.nullif(source, F.lit(""))
    return F.when(day.isNotNull(), F.concat_ws("/", domain, table, F.concat(F.lit("interval="), interval), F.concat(F.lit("data_source="), source),
                  F.concat(F.lit("year="), day[0]), F.concat(F.lit("month="), day[1]), F.concat(F.lit("day="), day[2]), *rest))


def layer_path(domain: Column, table: Column, interval: Column, source: Column, ds: Column, layer: Column) -> Column:
    """Prefix of a day's layer; a blank source leaves its segment out, a day that is none gives null."""
    return _day_path(domain, table, interval, source, ds, F.concat(F.lit("layer="), layer))


def raw_key(domain: Column, table: Column, interval: Column, source: Column, ds: Column, symbol: Column, file_type: str = "json", gzip: bool = False) -> Column:
    """Key of a symbol's raw file of a day; a blank symbol gives null."""
    named = F.coalesce(symbol, F.lit("")) != ""
    return F.when(named, _day_path(domain, table, interval, source, ds, F.concat(symbol, F.lit(f".{file_type.lower()}" + ".gz" * gzip))))


def manifest_key(domain: Column, table: Column, interval: Column, source: Column, ds: Column, basename: str = "_batch", suffix: str = ".manifest.json") -> Column:
    """Key of a day's manifest; a suffix gets its leading dot, blank names their defaults."""
    suffix = suffix.strip() or ".manifest.json"
    return _day_path(domain, table, interval, source, ds, F.lit((basename or "_batch") + (suffix if suffix.startswith(".") else f".{suffix}")))
