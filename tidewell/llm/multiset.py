"""Document fingerprints by a homomorphic multiset hash of paragraphs, in native expressions.

A document's vector is the sum of its paragraphs' vectors, lane by lane modulo a power of two. So it doesn't
depend on the paragraphs' order, and a paragraph is put in or taken out by adding or subtracting its vector.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.tables import table

#: Lanes that tell paragraphs apart: uniform, modulo 2**32.
WHOLE = 8
WHOLE_BITS = 32
#: Lanes that tell how alike texts are: sums of +1 and -1, modulo 2**24. A hash gives 62, two to a counter of 64 bits.
HASHES = 2
HALF = 31
LANES = HASHES * 2 * HALF
LANE_BITS = 24
#: Spaces around a paragraph or between words.
SPACES = " \t\x0b\x0c\r"
#: Documents are put in order in so many blocks of ids at most, with about BLOCK_ROWS in one as long as that is enough.
BLOCKS = 8192
BLOCK_ROWS = 256


def paragraphs(text: Column) -> Column:
    """The lines of a text without the spaces around them; blank ones are none."""
    return F.filter(F.transform(F.split(text, "\n", -1), lambda p: F.btrim(p, F.lit(SPACES))), lambda p: p != "")


def _whole(text: Column) -> list[Column]:
    """The lanes of whole paragraphs, summed; a text has under 2**31 of them, so a sum fits in 63 bits."""
    mask = F.lit((1 << WHOLE_BITS) - 1)
    lane = lambda i: F.aggregate(paragraphs(text), F.lit(0).cast("long"), lambda s, p: s + F.xxhash64(p, F.lit(i)).bitwiseAND(mask))
    return [lane(i).bitwiseAND(mask) for i in range(WHOLE)]


def _features(text: Column) -> Column:
    """Hashes of the neighbouring words of each paragraph, whose start and end count as a word.

    A line end is a word of its own here, so no pair reaches from one paragraph into another. A pair of line
    ends stands for a blank line and counts for nothing, see ``_blank``.
    """
    words, end = F.regexp_extract_all(text, F.lit(r"\n|[^\x20\x09-\x0D]+"), F.lit(0)), F.array(F.lit("\n"))
    return F.zip_with(F.concat(end, words), F.concat(words, end), lambda a, b: F.xxhash64(a, b))


def _blank(h: Column) -> Column:
    return h == F.xxhash64(F.lit("\n"), F.lit("\n"))


def summed(texts: DataFrame, text_col: str, *keys: str) -> DataFrame:
    """``keys`` and ``vector`` of each of ``texts``, whose ``keys`` name one row each: WHOLE lanes, then LANES.

    A word pair's hash has a +1 or -1 for each of its lanes; the lanes of a text are the sums over its
    paragraphs' pairs. They are counted as ones, two counters of 32 bits in a long, and no text has as many
    pairs as a counter holds. A null text is an empty one: all lanes are zero.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = texts.select(*keys, text.alias("t"), *[c.alias(f"w{i}") for i, c in enumerate(_whole(text))])  # before the rows multiply
    rows = rows.select(*keys, *[f"w{i}" for i in range(WHOLE)], F.explode(_features(F.col("t"))).alias("h"))
    rows = rows.withColumn("own", F.when(_blank(F.col("h")), 0).otherwise(1))
    two = F.lit(1 | 1 << 32)
    counters = []
    for k in range(HASHES):
        h = F.when(F.col("own") == 0, F.lit(0).cast("long")).otherwise(F.xxhash64("h", F.lit(k)) if k else F.col("h"))
        counters += [F.sum(F.shiftrightunsigned(h, j).bitwiseAND(two)).alias(f"c{k}_{j}") for j in range(HALF)]
    sums = rows.groupBy(*keys).agg(F.sum("own").alias("n"), *[F.max(f"w{i}").alias(f"w{i}") for i in range(WHOLE)], *counters)
    counts = F.array(*[F.col(f"c{k}_{j}") for k in range(HASHES) for j in range(HALF)])
    signed = lambda ones: F.pmod(2 * ones - F.col("n"), F.lit(1 << LANE_BITS))
    lanes = F.flatten(F.transform(counts, lambda c: F.array(signed(c.bitwiseAND(F.lit((1 << 32) - 1))), signed(F.shiftrightunsigned(c, 32)))))
    return sums.select(*keys, F.concat(F.array(*[F.col(f"w{i}") for i in range(WHOLE)]), lanes).alias("vector"))


def _modulo(x: Column, i: Column) -> Column:
    return F.pmod(x, F.when(i < WHOLE, F.lit(1 << WHOLE_BITS)).otherwise(F.lit(1 << LANE_BITS)))


def _lanewise(v: Column, w: Column, sign: int) -> Column:
    return F.transform(F.zip_with(v, w, lambda a, b: a + b if sign > 0 else a - b), _modulo)


def added(v: Column, w: Column) -> Column:
    """Vector of the texts of ``v`` and ``w`` together: paragraphs put in."""
    return _lanewise(v, w, 1)


def removed(v: Column, w: Column) -> Column:
    """Vector of the text of ``v`` without the paragraphs of ``w``."""
    return _lanewise(v, w, -1)


def encoded(v: Column) -> Column:
    """A vector as hexadecimal text: the fingerprint."""
    return F.array_join(F.transform(v, lambda x, i: F.lower(F.lpad(F.hex(x), F.when(i < WHOLE, WHOLE_BITS // 4).otherwise(LANE_BITS // 4), F.lit("0")))), "")


def decoded(fingerprint: Column) -> Column:
    """The vector of a fingerprint."""
    whole, lane = WHOLE_BITS // 4, LANE_BITS // 4
    digits = lambda i: F.when(i < WHOLE, F.substring(fingerprint, i * whole + 1, F.lit(whole))).otherwise(F.substring(fingerprint, WHOLE * whole + (i - WHOLE) * lane + 1, F.lit(lane)))
    return F.transform(F.sequence(F.lit(0), F.lit(WHOLE + LANES - 1)), lambda i: F.conv(digits(i), 16, 10).cast("long"))


def likeness(v: Column, w: Column) -> Column:
    """From 0 to 1: an estimate of the cosine between the word pairs of two texts, within about ``LANES ** -0.5``.

    Equal vectors have 1, and so do two texts without words; a text without words is unlike all others.
    """
    top = F.lit(1 << (LANE_BITS - 1))
    lanes = lambda x: F.transform(F.slice(x, WHOLE + 1, LANES), lambda c: (F.pmod(c + top, F.lit(1 << LANE_BITS)) - top).cast("double"))
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda s, p: s + p)
    a, b = lanes(v), lanes(w)
    cosine = dot(a, b) / F.nullif(F.sqrt(dot(a, a) * dot(b, b)), F.lit(0.0))
    return F.when(v == w, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(cosine, F.lit(0.0)))))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, vector, fingerprint`` for each distinct id, which has to name one text; an empty table gives an empty table."""
    found = summed(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", "id")
    return found.select("id", "vector", encoded(F.col("vector")).alias("fingerprint"))


def _block_of(id_: Column, edges: list[int]) -> Column:
    """The number of ``edges`` (in order) that are at most an id, by halving; -1 for a null one."""
    listed = F.array(*[F.lit(e).cast("long") for e in edges]) if edges else F.array().cast("array<long>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, len(edges).bit_length())))])
    at = F.aggregate(steps, F.lit(0), lambda p, s: F.when(F.coalesce(F.get(listed, p + s - 1) <= id_, F.lit(False)), p + s).otherwise(p))
    return F.when(id_.isNull(), -1).otherwise(at)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: int | None = None) -> DataFrame:
    """``block, place, copied, doc_id, text, next_text``: each document beside the next one in descending order of ids.

    After the last comes the first. Rows of one id are in the order of a hash of their text, null ids are
    last, a null text is an empty one. Ids are cut into blocks of about equal numbers by their quantiles; a
    block is sorted in one task, and whole texts are shuffled once. The first document of each block is also
    sent to the block before it, as the row with ``copied``, behind its own. Quantiles and the blocks' first
    ids, at most BLOCKS of them, pass through the driver.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = blocks or min(BLOCKS, rows.count() // BLOCK_ROWS + 1)
    parts = [k / n for k in range(1, n)]
    edges = sorted(set((rows.agg(F.percentile_approx("doc_id", parts, 100_000)).first()[0] or []) if parts else []))
    block = _block_of(F.col("doc_id"), edges)
    heads = sorted((r[0], r[1]) for r in rows.select(block.alias("b"), "doc_id").groupBy("b").agg(F.max("doc_id")).collect())
    sent = [(first, heads[(k + 1) % len(heads)][0]) for k, (_, first) in enumerate(heads)]
    to = F.broadcast(docs.sparkSession.createDataFrame(sent, "first long, to int"))
    own = F.struct(block.alias("block"), F.lit(False).alias("copied"))
    copy = F.when(F.col("to").isNotNull(), F.struct(F.col("to").alias("block"), F.lit(True).alias("copied")))
    dealt = rows.join(to, F.col("doc_id").eqNullSafe(F.col("first")), "left").select("doc_id", "text", F.explode(F.array_compact(F.array(own, copy))).alias("b"))
    dealt = dealt.select("b.block", "b.copied", "doc_id", "text", F.xxhash64("text").alias("hash"))
    order = Window.partitionBy("block").orderBy("copied", F.col("doc_id").desc(), F.col("hash").desc())
    return dealt.select("block", F.row_number().over(order).alias("place"), "copied", "doc_id", "text", F.lead("text").over(order).alias("next_text"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: int | None = None) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how alike it is to that and to the next document.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. The edited text
    has its last half (rounded down) replaced by as much of the beginning of the next document, see
    ``with_next``. A null text is an empty one; repeated rows and null ids are documents like any other; an
    empty table gives an empty table; other columns play no part.
    """
    rows = with_next(docs, id_col, text_col, blocks).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("edited", F.when(~F.col("copied"), F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))))
    keys = ["block", "place", "kind", "copied", "doc_id", "n_chars", "edited_sha256"]
    two = rows.withColumn("edited_sha256", F.sha2(F.encode("edited", "UTF-8"), 256)).select(*[k for k in keys if k != "kind"], F.posexplode(F.array("text", "edited")).alias("kind", "text"))
    vectors = summed(two.where(~F.col("copied") | (F.col("kind") == 0)), "text", *keys)
    # A document has two rows, its own text's and its edited one's; then comes the next document.
    order = Window.partitionBy("block").orderBy("place", "kind")
    near = vectors.select("*", F.lead("vector", 1).over(order).alias("edited"), F.lead("vector", 2).over(order).alias("next")).where("kind = 0 AND NOT copied")
    return near.select("doc_id", "n_chars", "edited_sha256", encoded(F.col("vector")).alias("fingerprint"), encoded(F.col("edited")).alias("edited_fingerprint"),
                       likeness(F.col("vector"), F.col("edited")).alias("near_edited"), likeness(F.col("vector"), F.col("next")).alias("near_next"))


def op13_fingerprints(spark, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))
