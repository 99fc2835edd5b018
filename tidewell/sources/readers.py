"""Readers of raw and compacted prices, manifests and symbol lists."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.scalars import LINE_END, normalize_symbol, stripped

RAW_PRICE = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("ds", T.StringType())]
                         + [T.StructField(c, T.DoubleType()) for c in ("open", "high", "low", "close", "adjusted_close")] + [T.StructField("volume", T.LongType())])
MANIFEST = T.StructType([T.StructField("ds", T.StringType()), T.StructField("raw_prefix", T.StringType()), T.StructField("batch_id", T.StringType()), T.StructField("objects", T.ArrayType(T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("key", T.StringType()), T.StructField("records", T.LongType())])))])


def read_raw(spark: SparkSession, path: str, file_type: str, schema: T.StructType = RAW_PRICE, unknown: str = "raise") -> DataFrame:
    """JSON lines, CSV with a header, or Parquet, in any case; an unknown type raises or is taken for Parquet."""
    kind = file_type.lower()
    if kind not in FILE_TYPES:
        if unknown == "raise":
            raise ValueError(f"unsupported file type: {file_type}")
        kind = "parquet"
    reader = spark.read.schema(schema)
    return reader.option("header", True).csv(path) if kind == "csv" else getattr(reader, kind)(path)


def read_layers(spark: SparkSession, root: str, partitions: tuple[str, ...] = ("year", "month", "day", "layer")) -> DataFrame:
    """A partitioned table whose partition values stay text, so that month=06 is "06" whatever the session infers."""
    found = spark.read.parquet(root).schema
    kinds = [T.StructField(f.name, T.StringType() if f.name in partitions else f.dataType) for f in found.fields]
    return spark.read.schema(T.StructType(kinds)).parquet(root)


def read_day(spark: SparkSession, root: str, ds: str, **layer: str) -> DataFrame:
    """One day of a partitioned table, by partition filters that prune the listing; a day that is none raises."""
    parts = ds.split("-")
    if [len(x) for x in parts] != [4, 2, 2] or not "".join(parts).isdigit():
        raise ValueError(f"invalid ds: {ds}")
    wanted = dict(zip(("year", "month", "day"), parts)) | layer
    df = read_layers(spark, root, tuple(wanted))
    for name, value in wanted.items():
        df = df.where(F.col(name) == value)
    return df


def raw_location(prefix: str, ds: str) -> str:
    """A raw prefix with its day's segments, unless it has all of them already; a day that is none raises."""
    parts = ds.split("-")
    if [len(x) for x in parts] != [4, 2, 2] or not "".join(parts).isdigit():
        raise ValueError(f"invalid ds: {ds}")
    prefix = prefix.rstrip("/")
    if all(f"{n}=" in prefix for n in ("year", "month", "day")):
        return prefix
    return f"{prefix}/year={parts[0]}/month={parts[1]}/day={parts[2]}"


def read_compacted_first(spark: SparkSession, compacted: str, raw: str, file_type: str) -> DataFrame:
    """The compacted layer; where its path is missing, the raw one."""
    try:
        return spark.read.schema(RAW_PRICE).parquet(compacted)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return read_raw(spark, raw, file_type, unknown="parquet")


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``file, place, document, error`` of the manifests in the JSON files under a path, one row each, nested folders too.

    A file is one document in any layout, a list of documents, or has one on each line. ``document`` is what
    ``MANIFEST`` names of it. A file that is none of these, a blank one too, has one row with an ``error`` and no
    document; so has an entry of a list that isn't an object. Spark leaves out files without a byte. A file is
    parsed as a whole, in one row.
    """
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="[!_.]*").select(F.col("_metadata.file_path").alias("file"), "value")
    lines = F.filter(F.transform(F.split("value", "\r\n|\n|\r"), stripped), lambda x: x != "")
    by_line = (F.size(lines) > 0) & F.forall(lines, lambda x: F.startswith(x, F.lit("{")) & F.try_parse_json(x).isNotNull())
    # Read as an array, a lone object is an array of one.
    whole = F.from_json("value", T.ArrayType(T.StringType()), {"mode": "PERMISSIVE"})
    ends = F.concat(F.substring(stripped(F.col("value")), 1, 1), F.right(stripped(F.col("value")), F.lit(1)))
    entries = F.when(by_line, lines).when(F.try_parse_json("value").isNull(), None).when(ends == "{}", F.array("value")).when(ends == "[]", whole)
    rows = files.select("file", F.posexplode_outer(entries).alias("place", "entry"), F.size(entries).alias("n"))
    document = F.from_json("entry", MANIFEST)
    good = F.coalesce(F.startswith(stripped(F.col("entry")), F.lit("{")), F.lit(False)) & F.try_parse_json("entry").isNotNull()
    reason = F.when(F.col("n") == 0, None).when(F.col("entry").isNull(), "not a JSON document").when(~good, "not an object")
    return rows.select("file", F.coalesce("place", F.lit(0)).alias("place"), F.when(good, document).alias("document"), reason.alias("error")).where("document IS NOT NULL OR error IS NOT NULL")


def manifest_objects(spark: SparkSession, path: str) -> DataFrame:
    """``ds, symbol, key, records`` of all manifests and chunk summaries under a path, one row each; ``read_documents`` shows what gives none."""
    return read_documents(spark, path).where("document.ds <> ''").select("document.ds", F.inline("document.objects"))


def parse_symbols(text: Column) -> Column:
    """Symbols of a JSON array, or else of lines; blank ones are dropped, order is kept.

    Of an array's members only texts and whole numbers count. A text that is no JSON array, broken JSON too,
    is lines.
    """
    json = F.try_parse_json(text)
    is_list = F.coalesce(F.startswith(F.schema_of_variant(json), F.lit("ARRAY")) & F.endswith(stripped(text), F.lit("]")), F.lit(False))
    members = F.try_variant_get(json, "$", "array<variant>")
    known = F.filter(members, lambda m: F.schema_of_variant(m).isin("STRING", "BIGINT") | F.schema_of_variant(m).rlike(r"\ADECIMAL\(\d+,0\)\z"))
    listed = F.when(is_list, F.transform(known, lambda m: F.try_variant_get(m, "$", "string"))).otherwise(F.split(text, LINE_END))
    return F.filter(F.transform(listed, stripped), lambda s: s.isNotNull() & (s != ""))


#: The symbols of a universe that no source names.
DEFAULT_SYMBOLS = ("AAPL",)


def first_symbols(*texts: Column) -> Column:
    """Symbols of the first text, in the order of precedence, that has any; else the default."""
    parsed = [F.when(F.size(parse_symbols(t)) > 0, parse_symbols(t)) for t in texts]
    return F.coalesce(*parsed, F.array(*[F.lit(s) for s in DEFAULT_SYMBOLS]))


def read_listing(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """An exchange's listing as landed: text with a header, all columns as text; ``|`` separates the pipe-delimited ones."""
    return spark.read.option("header", True).option("sep", sep).option("inferSchema", False).csv(path)


def listed_symbols(listing: DataFrame, symbol: str, test_issue: str | None = None, exchange: tuple[str, str] | None = None) -> DataFrame:
    """``symbol`` of real issues, normalised: no test issue, of the exchange (column, code) if asked, no null and no trailer row."""
    rows = listing.where(F.col(symbol).isNotNull() & ~F.startswith(F.col(symbol), F.lit("File Creation Time")))
    if test_issue:
        rows = rows.where(F.col(test_issue) == "N")
    if exchange:
        rows = rows.where(F.col(exchange[0]) == exchange[1])
    return rows.select(normalize_symbol(F.col(symbol)).alias("symbol"))


def universe(*lists: DataFrame) -> DataFrame:
    """The distinct symbols of all lists, in order, without blank ones."""
    every = reduce(DataFrame.unionByName, [df.select("symbol") for df in lists])
    return every.where("symbol <> ''").distinct().orderBy("symbol")


def split_symbols(df: DataFrame, symbol: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a symbol, without the white space around it; rows without one)."""
    clean = F.nullif(stripped(F.col(symbol).cast("string")), F.lit(""))
    return df.withColumn(symbol, clean).where(F.col(symbol).isNotNull()), df.where(clean.isNull())


#: File types that are read.
FILE_TYPES = ("json", "csv", "parquet")


def file_type_allowed(kind: Column) -> Column:
    """Whether a file type is one that is read, in any case; null isn't."""
    return F.coalesce(F.lower(kind).isin(*FILE_TYPES), F.lit(False))


def listed_objects(spark: SparkSession, path: str) -> DataFrame:
    """``key, size`` of the files under a prefix, for a summary that lists no objects; contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.col("path").alias("key"), F.col("length").alias("size"))


def wide_to_long(df: DataFrame, ids: list[str], fields: list[str]) -> DataFrame:
    """Columns ``SYMBOL_field`` to one row per id and symbol; a symbol without any value is left out."""
    symbols = sorted({c.rsplit("_", 1)[0] for c in df.columns if c not in ids})
    rows = F.explode(F.array(*[F.struct(F.lit(s).alias("symbol"), *[(F.col(f"{s}_{f}") if f"{s}_{f}" in df.columns else F.lit(None)).cast("double").alias(f) for f in fields]) for s in symbols]))
    return df.select(*ids, rows.alias("r")).select(*ids, "r.*").where(" OR ".join(f"{f} IS NOT NULL" for f in fields))
