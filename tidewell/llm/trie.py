"""The trie of conversations' prefixes, and totals over its subtrees by depth-band rollup.

A node is known by 128 bits: the exclusive or of a hash of each of its turns and their places. Its parent's
name is its own one without the last turn's hash.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.tables import forget, settle, table

#: A node explodes to at most so many ancestors, those of its band of depths.
BAND = 32
#: Turns whose hashes are summed up in one group of a conversation.
RUN = 1024
#: Conversations of a family take over up to FAMILY_TURNS - 1 turns of the first of FAMILY ids.
FAMILY = 20
FAMILY_TURNS = 4
#: Bytes of ids that are joined into one piece before they meet those of other partitions.
PIECE = 1 << 16


def in_order(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, place, h1, h2, words`` of each turn: its place in its conversation from 1, its hash, its words.

    Turns are in the order of their numbers, null first, those of one number in that of their hashes. Null
    role and text are empty; rows without a conversation are left out. All turns are sorted over ranges, so a
    conversation with a third of all rows lies in many partitions; places follow from the counts of the
    partitions' conversations. The table is settled.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.xxhash64(role, text).alias("h1"), F.xxhash64(text, role, F.lit(1)).alias("h2"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    order = ["conv_id", "turn", "h1", "h2"]
    # Row ids are partition numbers and places in them; equal rows are all the same.
    dealt = settle(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "h1", "h2", "words", F.monotonically_increasing_id().alias("id")))
    part = F.shiftright("id", 33)
    parts = dealt.groupBy("conv_id", part.alias("part")).agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select("conv_id", "part", (before - F.col("first") + 1).alias("shift"))
    out = settle(dealt.withColumn("part", part).join(starts, ["conv_id", "part"]).select("conv_id", (F.col("id") + F.col("shift")).alias("place"), "h1", "h2", "words"))
    forget(dealt)
    return out


def with_family_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns of the rebuilt conversations as ``in_order`` gives them, all ``conv_id`` with what they take over); both are settled.

    Conversation c takes over the first h turns of conversation c - c % FAMILY (all if it has fewer, none if
    there is none) in place of its own first h; h is crc32 of c in decimal, modulo FAMILY_TURNS.
    """
    h = F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % FAMILY_TURNS
    heads = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < FAMILY_TURNS)).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "h1", "h2", "words"))).alias("head"))
    convs = turns.select("conv_id").distinct().select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    taken = convs.join(heads.withColumnRenamed("conv_id", "base"), "base", "left").select("conv_id", "h", F.coalesce(F.slice("head", F.lit(1), F.col("h").cast("int")), F.array()).alias("head"))
    taken = settle(taken)
    own = turns.join(taken.select("conv_id", "h", F.size("head").alias("n")), "conv_id").where(F.col("place") > F.col("h"))
    own = own.select("conv_id", (F.col("place") - F.col("h") + F.col("n")).alias("place"), "h1", "h2", "words")
    return settle(own.unionByName(taken.select("conv_id", F.inline("head")))), taken


def paths(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """``conv_id, depth, node, parent, words`` of each prefix of each of ``convs(conv_id)``; the root is depth 0.

    Hashes are summed up within runs of turns, and runs by their totals.
    """
    own = turns.select("conv_id", F.col("place").alias("depth"), F.expr(f"(place - 1) div {RUN}").alias("run"), "words", *[F.xxhash64("place", "h1", "h2", F.lit(k)).alias(n) for k, n in enumerate("ab")])
    upto = Window.partitionBy("conv_id", "run").orderBy("depth")
    own = own.withColumns({f"{n}_own": F.bit_xor(n).over(upto) for n in "ab"})
    earlier = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = own.groupBy("conv_id", "run").agg(*[F.bit_xor(n).alias(n) for n in "ab"])
    runs = runs.select("conv_id", "run", *[F.coalesce(F.bit_xor(n).over(earlier), F.lit(0)).alias(f"{n}_before") for n in "ab"])
    own = own.join(runs, ["conv_id", "run"]).withColumns({f"{n}_node": F.col(f"{n}_own").bitwiseXOR(F.col(f"{n}_before")) for n in "ab"})
    named = lambda *c: F.struct(*[x.alias(n) for x, n in zip(c, "ab")])
    node, parent = named(*[F.col(f"{n}_node") for n in "ab"]), named(*[F.col(f"{n}_node").bitwiseXOR(F.col(n)) for n in "ab"])
    root, none = named(*[F.lit(0).cast("long")] * 2), F.lit(None).cast("struct<a:bigint,b:bigint>")
    roots = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), root.alias("node"), none.alias("parent"), F.lit(0).cast("long").alias("words"))
    return roots.unionByName(own.select("conv_id", "depth", node.alias("node"), parent.alias("parent"), "words"))


def _sums(df: DataFrame, by: str, names: list[str]) -> DataFrame:
    return df.groupBy(F.col(by).alias("node")).agg(*[F.sum(n).alias(n) for n in names])


def roll_up(rows: DataFrame, values: DataFrame, names: list[str], deepest: int, band: int = BAND) -> DataFrame:
    """``node`` and the sums of ``names`` over its subtree, itself included.

    ``rows(conv_id, depth, node, parent)`` are paths from the root, ``values(node, *names)`` each node's own.
    Depths are cut into bands. A node explodes to its ancestors within its band, never more than ``band``, and
    these add up what they get. The first nodes of all bands are a trie of their own, ``band`` times lower;
    rolling that up completes them, and each one's total goes to its ancestors within the band above. So the
    number of rounds is the logarithm of the depth, to the base ``band``.
    """
    # The parents down to each row of a band: its ancestors there, and for the band below's first node all of them.
    within = Window.partitionBy("conv_id", F.expr(f"(depth - 1) div {band}"), F.col("depth") == 0).orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    above = rows.withColumn("above", F.collect_list("parent").over(within))
    nodes = settle(above.groupBy("node").agg(F.max("depth").alias("depth"), F.any_value("above").alias("above")))
    own = nodes.join(values, "node")
    first = F.col("depth") % band == 0
    targets = F.when(first, F.array("node")).otherwise(F.array_append("above", F.col("node")))
    partial = _sums(own.select(F.explode(targets).alias("to"), *names), "to", names)
    if deepest < band:
        return partial
    partial = settle(partial)
    fewer = above.where(first).select("conv_id", F.expr(f"depth div {band}").alias("depth"), "node", F.get("above", F.lit(0)).alias("parent"))
    # A total of the smaller trie adds up its nodes' partial sums, in which each node of a band counts once.
    tops = roll_up(fewer, partial.join(nodes.where(first).select("node"), "node", "left_semi"), names, deepest // band, band)
    passed = nodes.where(first).select("node", "above").join(tops, "node").select(F.explode("above").alias("to"), *names)
    return _sums(partial.unionByName(_sums(passed, "to", names)), "node", names)


def _ended(batches, piece: int):
    """From sorted ``(node a, b, id)``: ids of equal nodes joined by commas, in pieces of about ``piece`` bytes."""
    key, ids, size, out = None, [], 0, []

    def put():
        if ids:
            out.append((*key, ids[0], ",".join(map(str, ids))))

    for batch in batches:
        for a, b, i in zip(*(c.to_pylist() for c in batch.columns)):
            if (a, b) != key or size > piece:
                put()
                key, ids, size = (a, b), [], 0
            ids.append(i)
            size += len(str(i)) + 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["a", "b", "first", "ids"])
            out.clear()
    put()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["a", "b", "first", "ids"])


def _digests(batches):
    """From pieces sorted by node and first id: the SHA-256 of each node's pieces, joined by commas."""
    key, state, out = None, None, []
    for batch in batches:
        for a, b, text in zip(*(batch.column(n).to_pylist() for n in ("a", "b", "ids"))):
            if (a, b) == key:
                state.update(b"," + text.encode())
                continue
            if key:
                out.append((*key, state.hexdigest()))
            key, state = (a, b), hashlib.sha256(text.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.string()))], ["a", "b", "ends_sha256"])
            out.clear()
    if key:
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*key, state.hexdigest()), (pa.int64(), pa.int64(), pa.string()))], ["a", "b", "ends_sha256"])


def ends(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """``node, ends_sha256``: the digest of the ascending, comma-joined ids of the conversations that end at a node.

    Ids are sorted over ranges of (node, id), and joined into pieces there, so that a node's pieces are few when
    they meet. A digest reads a node's ids one after the other, which one task does, piece by piece.
    """
    last = rows.groupBy("conv_id").agg(F.max("depth").alias("depth"))
    own = rows.join(last, ["conv_id", "depth"]).select("node.a", "node.b", "conv_id")
    pieces = own.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id").mapInArrow(lambda x: _ended(x, piece), "a long, b long, first long, ids string")
    whole = pieces.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(_digests, "a long, b long, ends_sha256 string")
    return whole.select(F.struct("a", "b").alias("node"), "ends_sha256")


def _hex(node: str) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(f"{node}.{c}"), 16, "0") for c in "ab"]))


def prefix_trie(turns: DataFrame, convs: DataFrame, band: int = BAND) -> DataFrame:
    """The trie of ``turns(conv_id, place, h1, h2, words)`` of ``convs(conv_id)``, one row a node.

    ``node, parent`` (hexadecimal), ``conv_id`` (the smallest member), ``depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256``. ``n_leaves`` counts the subtree's nodes without
    children, ``saved_tokens`` sums, over the subtree, the words of each node's last turn times its other
    members: what a cache of prefixes saves. Places are gapless from 1; conversations without turns are
    members of the root; no conversations give no nodes.

    Members, children and sums are counted before their shuffle, so the root, of which all are members, is a
    row for each task.
    """
    rows = settle(paths(turns, convs))
    deepest = rows.agg(F.max("depth")).first()[0] or 0
    nodes = rows.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.count("*").alias("n_convs"), F.max("words").alias("words"), F.max("parent.a").alias("pa"), F.max("parent.b").alias("pb"))
    nodes = settle(nodes.withColumn("parent", F.when(F.col("pa").isNotNull(), F.struct(F.col("pa").alias("a"), F.col("pb").alias("b")))).drop("pa", "pb"))
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    counted = settle(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    values = counted.select("node", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    totals = roll_up(rows, values, ["n_leaves", "saved_tokens"], deepest, band)
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = counted.join(totals, "node").join(ends(rows), "node", "left").join(above, "parent", "left")
    return out.select(_hex("node").alias("node"), _hex("parent").alias("parent"), "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    turns = in_order(table(spark, sf_dir, "conversations"))
    rebuilt, convs = with_family_heads(turns)
    forget(turns)
    out = prefix_trie(rebuilt, convs).drop("node", "parent")
    forget(rebuilt, convs)
    return out


_CRC = "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [ord(x)::BIGINT FOR x IN string_split(conv_id::VARCHAR, '')]), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"
OP11_SQL = f"""
WITH o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, ({_CRC})::BIGINT % {FAMILY_TURNS} AS h, conv_id - conv_id % {FAMILY} AS base FROM (SELECT DISTINCT conv_id FROM o)),
r AS (SELECT c.conv_id, o.place AS p, o.role, o.text FROM c JOIN o ON o.conv_id = c.base AND o.place <= c.h
  UNION ALL SELECT o.conv_id, o.place + 1000000, o.role, o.text FROM c JOIN o ON o.conv_id = c.conv_id AND o.place > c.h),
t AS (SELECT conv_id, row_number() OVER w AS depth, sha256(string_agg(sha256(role) || sha256(text), '') OVER w) AS node, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
a AS (SELECT conv_id, 0 AS depth, '' AS node, 0 AS words FROM c UNION ALL SELECT * FROM t),
l AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent, depth = max(depth) OVER (PARTITION BY conv_id) AS ended FROM a),
n AS (SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(parent) AS parent, count(*) AS n_convs, any_value(words) AS words,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256 FROM l GROUP BY node),
k AS (SELECT n.*, (SELECT count(*) FROM n m WHERE m.parent = n.node) AS n_children FROM n),
s AS (SELECT l.node, sum((k.n_children = 0)::INT) AS n_leaves, sum((k.n_convs - 1) * k.words) AS saved_tokens FROM k JOIN l ON l.conv_id = k.conv_id AND l.depth <= k.depth GROUP BY l.node)
SELECT k.conv_id, k.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, k.n_convs, k.n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, k.ends_sha256
FROM k JOIN s ON s.node = k.node LEFT JOIN n u ON u.node = k.parent
"""
