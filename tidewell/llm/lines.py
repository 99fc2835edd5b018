"""Line dedup by site-relative frequency, in native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.tables import settle, table, unused

#: Drop a line that stands on more than this part of its host's pages, and on at least so many pages.
MAX_RATIO = 0.1
MIN_PAGES = 5
#: Hosts' line lists are broadcast while there are at most so many lines (32 bytes each) in all.
BROADCAST_LINES = 200_000
SALTS = 32


def _line_key(line: Column) -> Column:
    """128 bits for a line without the spaces around it; null for a blank line."""
    line = F.trim(line)
    return F.when(line != "", F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("line"), line).alias("h2")))


def boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, h1, h2)`` of the lines on more than ``max_ratio`` of their host's pages.

    A page counts once for a line however often it repeats it. Pages are the rows with a host; counts per
    (host, line) are added up before the shuffle, so a host with a third of all rows is spread by line.
    A host can have no more such lines than a page has lines, on average, divided by ``max_ratio``.
    """
    pages = docs.where(F.col(host_col).isNotNull()).select(F.col(host_col).alias("host"), F.col(text_col).alias("text"))
    # Distinct on strings goes through a hash set; on structs Spark would compare all pairs of a long page.
    lines = F.array_distinct(F.transform(F.split("text", "\n", -1), lambda line: F.trim(line)))
    on = pages.select("host", F.explode(F.transform(F.filter(lines, lambda line: line != ""), _line_key)).alias("k"))
    on = on.groupBy("host", F.col("k.h1").alias("h1"), F.col("k.h2").alias("h2")).agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    hosts = pages.groupBy("host").agg(F.count("*").alias("pages"))
    return on.join(hosts, "host").where(F.col("n") > F.col("pages") * F.lit(max_ratio)).select("host", "h1", "h2")


def drop_boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", max_ratio: float = MAX_RATIO,
                     min_pages: int = MIN_PAGES, broadcast_lines: int = BROADCAST_LINES, counts: bool = False) -> DataFrame:
    """``docs`` with the boilerplate lines of each host taken out of the text; no row is dropped.

    Lines end at ``\\n``; blank lines are never dropped and count for nothing. Null text stays null and a
    null host keeps all its lines. ``counts`` adds ``n_lines`` and ``n_dropped``, in place of columns of that
    name; any other column stays. Repeated rows are pages of their own; an empty table gives an empty table.
    The lists of lines are
    broadcast after their rows are counted; beyond ``broadcast_lines`` the pages are joined to them by
    host and salt, so that a hot host goes to many tasks.
    """
    lines = settle(boilerplate(docs, host_col, text_col, max_ratio, min_pages))
    few = lines.count() <= broadcast_lines
    host, bad, salt, own = unused(docs, "host", "lines", "salt", "own")
    lists = lines.groupBy(F.col("host").alias(host)).agg(F.collect_set(F.struct("h1", "h2")).alias(bad))
    if few:
        joined = docs.join(F.broadcast(lists), F.col(host_col) == F.col(host), "left")
    else:
        salted = lists.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = docs.withColumn(own, F.pmod(F.xxhash64(text_col), F.lit(SALTS)).cast("int"))
        joined = dealt.join(salted, (F.col(host_col) == F.col(host)) & (F.col(own) == F.col(salt)), "left").drop(own, salt)
    parts = F.split(text_col, "\n", -1)
    gone = lambda line: F.coalesce(F.array_contains(F.col(bad), _line_key(line)), F.lit(False))
    kept = F.filter(parts, lambda line: ~gone(line))
    cleaned = F.when(F.col(bad).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    if counts:
        joined = joined.withColumns({"n_lines": F.coalesce(F.size(F.filter(parts, lambda x: F.trim(x) != "")), F.lit(0)).cast("long"),
                                     "n_dropped": F.when(F.col(bad).isNull() | F.col(text_col).isNull(), 0).otherwise(F.size(parts) - F.size(kept)).cast("long")})
    return joined.withColumn(text_col, cleaned).drop(host, bad)


def op3_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return drop_boilerplate(docs, counts=True)


OP3_SQL = f"""
WITH l AS (SELECT source, doc_id, unnest(list_distinct([trim(x) FOR x IN string_split(text, chr(10))])) AS line FROM documents WHERE source IS NOT NULL),
n AS (SELECT source, line, count(*) AS n FROM l WHERE line <> '' GROUP BY ALL),
h AS (SELECT source, count(*) AS pages FROM documents WHERE source IS NOT NULL GROUP BY ALL),
b AS (SELECT source, list(line) AS lines FROM n JOIN h USING (source) WHERE n >= {MIN_PAGES} AND n > pages * {MAX_RATIO}::DOUBLE GROUP BY ALL),
d AS (SELECT d.doc_id, d.source, string_split(d.text, chr(10)) AS p, coalesce(b.lines, []) AS bad FROM documents d LEFT JOIN b ON d.source = b.source),
k AS (SELECT *, [x FOR x IN p IF NOT list_contains(bad, trim(x))] AS q FROM d)
SELECT doc_id, source, array_to_string(q, chr(10)) AS text,
  coalesce(len([x FOR x IN p IF trim(x) <> '']), 0) AS n_lines, coalesce(len(p) - len(q), 0) AS n_dropped
FROM k
"""
