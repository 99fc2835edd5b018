"""Catalog tables over layered folders, brought up to date by what a listing shows."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.session import settle
from tidewell.sources.listing import PARTS, listed_partitions

#: Partitions that one statement adds or drops, and that one schema is read of.
BATCH = 500
#: Quarantined ones too.
ALL_LAYERS = ("*",)
#: Types that a wider one holds, in the order of their width.
_WIDER = (("tinyint", "smallint", "int", "bigint"), ("float", "double"), ("int", "double"), ("smallint", "double"), ("tinyint", "double"), ("date", "timestamp_ntz"))


def wider(a: T.DataType, b: T.DataType, name: str = "column") -> T.DataType:
    """The type that holds both, or an error: whole numbers, floating ones, decimals and structs widen, nothing becomes text."""
    if a == b:
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return combined(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType, name))
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    for chain in _WIDER:
        if {a.simpleString(), b.simpleString()} <= set(chain):
            return max(a, b, key=lambda t: chain.index(t.simpleString()))
    raise ValueError(f"{name}: {a.simpleString()} and {b.simpleString()} have no common type")


def combined(known: T.StructType, found: T.StructType) -> T.StructType:
    """The columns of both, in the order of the first, each of the wider type; names are compared without case."""
    out = {f.name.lower(): f for f in known.fields}
    for f in found.fields:
        old = out.get(f.name.lower())
        out[f.name.lower()] = T.StructField(old.name if old else f.name, wider(old.dataType, f.dataType, f.name) if old else f.dataType)
    return T.StructType(list(out.values()))


def shown_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that a view shows of both: the wider one, double for other numbers, text for what has nothing in common."""
    try:
        return wider(a, b)
    except ValueError:
        return T.DoubleType() if isinstance(a, T.NumericType) and isinstance(b, T.NumericType) else T.StringType()


def _batches(rows: DataFrame) -> Iterator[list]:
    at = rows.toLocalIterator()
    while batch := list(islice(at, BATCH)):
        yield batch


def _spec(row, parts: tuple[str, ...]) -> str:
    return ", ".join(f"{p}='{row[p]}'" for p in parts)


def _of_layers(rows: DataFrame, parts: tuple[str, ...], layers: tuple[str, ...]) -> DataFrame:
    if "layer" not in parts or layers == ALL_LAYERS:
        return rows
    return rows.where(F.col("layer").isin(*layers) if layers else F.col("layer") != "quarantine")


def partition_changes(spark: SparkSession, name: str, root: str, parts: tuple[str, ...] = PARTS, layers: tuple[str, ...] = ()) -> DataFrame:
    """``parts, change``: partitions with files that the table doesn't know (added), and known ones without files (deleted).

    From the listing and the catalog alone, of some layers or of all but the quarantined one.
    """
    there = _of_layers(listed_partitions(spark, root, parts), parts, layers)
    known = spark.sql(f"SHOW PARTITIONS {name}").select(*[F.regexp_extract("partition", rf"(?:\A|/){p}=([^/]*)", 1).alias(p) for p in parts])
    both = there.select(*parts, F.lit(True).alias("_there")).join(known.withColumn("_known", F.lit(True)), list(parts), "full_outer")
    change = F.when(F.col("_known").isNull(), "added").when(F.col("_there").isNull(), "deleted")
    return both.select(*parts, change.alias("change")).where("change IS NOT NULL")


def _folder_schema(spark: SparkSession, root: str, rows: list, parts: tuple[str, ...]) -> T.StructType:
    """The columns of some partitions' files: of all at once where they agree, else one by one."""
    paths = ["/".join([root.rstrip("/"), *[f"{p}={r[p]}" for p in parts]]) for r in rows]
    try:
        return spark.read.option("mergeSchema", True).parquet(*paths).schema
    except Exception as e:
        if "CANNOT_MERGE" not in str(e):
            raise
    found = T.StructType()
    for p in paths:
        found = combined(found, spark.read.option("mergeSchema", True).parquet(p).schema)
    return found


def _create(spark: SparkSession, name: str, root: str, schema: T.StructType, parts: tuple[str, ...]) -> None:
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in parts] + [f"`{p}` STRING" for p in parts]
    spark.sql(f"CREATE TABLE {name} ({', '.join(columns)}) USING parquet PARTITIONED BY ({', '.join(parts)}) LOCATION '{root}'")


def _alter(spark: SparkSession, name: str, verb: str, rows: DataFrame, parts: tuple[str, ...]) -> None:
    glue = " " if verb.startswith("ADD") else ", "
    for batch in _batches(rows):
        spark.sql(f"ALTER TABLE {name} {verb} " + glue.join(f"PARTITION ({_spec(r, parts)})" for r in batch))


def sync_table(spark: SparkSession, name: str, root: str, parts: tuple[str, ...] = PARTS, drop_deleted: bool = False, layers: tuple[str, ...] = ()) -> DataFrame:
    """Bring a catalog table over a layered root up to date; ``parts, change`` of what has changed, as a settled table.

    New partitions are added, and with them new columns and wider types; columns that can't be combined raise
    before anything changes. Partitions whose files are gone are reported, and dropped if asked. Files of known
    partitions aren't looked at. Types change by making the table's entry anew; its files stay as they are.
    A table that isn't there is made, unless the root has no files. Folders are listed once; partitions pass
    through the driver by the batch.
    """
    exists = spark.catalog.tableExists(name)
    if not exists:
        first = _of_layers(listed_partitions(spark, root, parts), parts, layers)
        changes = settle(first.select(*parts, F.lit("added").alias("change")))
    else:
        changes = settle(partition_changes(spark, name, root, parts, layers))
    added = changes.where("change = 'added'").select(*parts)
    own = T.StructType([f for f in spark.table(name).schema.fields if f.name not in parts]) if exists else T.StructType()
    schema = own
    for batch in _batches(added):
        schema = combined(schema, T.StructType([f for f in _folder_schema(spark, root, batch, parts).fields if f.name not in parts]))
    kinds = {f.name: f.dataType for f in schema.fields}
    if not exists:
        if schema.fields:
            _create(spark, name, root, schema, parts)
    elif any(kinds[f.name] != f.dataType for f in own.fields):
        known = settle(spark.sql(f"SHOW PARTITIONS {name}").select(*[F.regexp_extract("partition", rf"(?:\A|/){p}=([^/]*)", 1).alias(p) for p in parts]))
        spark.sql(f"DROP TABLE {name}")
        _create(spark, name, root, schema, parts)
        _alter(spark, name, "ADD IF NOT EXISTS", known, parts)
    elif new := [f for f in schema.fields if f.name not in {x.name for x in own.fields}]:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
    if schema.fields:
        _alter(spark, name, "ADD IF NOT EXISTS", added, parts)
        if drop_deleted:
            _alter(spark, name, "DROP IF EXISTS", changes.where("change = 'deleted'").select(*parts), parts)
    return changes
