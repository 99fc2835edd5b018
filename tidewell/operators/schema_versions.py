"""Schema fingerprints, their versions and what a change means."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window


def fingerprint(schema: StructType, codec: str = "zstd", drop: tuple[str, ...] = ("ds",)) -> dict:
    """Ordered (name, type) columns without ``ds``, and the SHA-256 of their canonical JSON; the codec is no part of it."""
    columns = [{"name": f.name, "type": f.dataType.simpleString()} for f in schema if f.name not in drop]
    text = json.dumps({"columns": columns}, sort_keys=True, separators=(",", ":"))
    return {"columns": columns, "codec": codec, "hash": hashlib.sha256(text.encode()).hexdigest()}


def previous_hash(versions: DataFrame) -> DataFrame:
    """``versions(table_name, version, hash)`` with the hash of the version before."""
    return versions.withColumn("previous_hash", F.lag("hash").over(Window.partitionBy("table_name").orderBy("version")))


def refresh_needed(policy: Column, latest: Column, previous: Column, has_path: Column, default: str = "on_schema_change") -> Column:
    """Whether the catalog has to be refreshed."""
    policy = F.coalesce(F.nullif(F.trim(policy), F.lit("")), F.lit(default))
    return F.when(policy == "never", False).when(policy == "force", True).when(~has_path, False).when(latest.isNull() | previous.isNull(), True).otherwise(latest != previous)


def diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """``name, change`` (added, removed, retyped) between two column tables ``(name, type)``."""
    o, n = old.select("name", F.col("type").alias("old_type")), new.select("name", F.col("type").alias("new_type"))
    change = F.when(F.col("old_type").isNull(), "added").when(F.col("new_type").isNull(), "removed").when(F.col("old_type") != F.col("new_type"), "retyped")
    return o.join(n, "name", "full_outer").withColumn("change", change).where("change IS NOT NULL")
