"""Secret scans: fixed-format detectors plus sliding-window Shannon entropy, all in native expressions.

A span is ``kind:start:end`` in code points, end exclusive. Spans of one pattern are found by splitting
the text at the matches: the lengths of the pieces and of the matches, summed up, are the offsets.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.tables import table, unused

#: The base detectors, in the order in which spans that start together are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")
ASSIGN_VALUE_CHARS = 8

#: Windows, matches and characters that are handled at once; results don't depend on it.
CHUNK = 256


@dataclass(frozen=True)
class EntropyClass:
    """One character class: its characters, the window width and the bits from which a window counts."""

    kind: str
    alphabet: str
    pattern: str
    window: int
    bits: float


#: The production parameters of the entropy scan. Random hex fills about 3.4 of 4 bits in 24 characters,
#: random base64 about 4.3 of 4.58; prose words and identifiers stay well below.
CLASSES = (
    EntropyClass("entropy_hex", "0123456789abcdefABCDEF", "[0-9a-fA-F]", 24, 3.1),
    EntropyClass("entropy_base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-", "[A-Za-z0-9+/=_-]", 24, 4.0),
)

#: Candidates that match one of these in full are no secrets: words, compound identifiers and paths
#: without digits, rulers, plain numbers and UUIDs. A repeated group is possessive, so that matching
#: neither goes deeper nor back with a candidate's length.
ALLOW = (
    r"[A-Za-z]?[a-z]+",
    r"[A-Z]+",
    r"(?:[A-Za-z]?[a-z]*+[/_=+-]++)*+[A-Za-z]?[a-z]*+",
    r"[0-9+/=_-]+",
    r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}",
)

#: Placeholders and the alphabet written out: what makes a part of a candidate, up to the next / or =, no secret.
FRAGMENTS = (r"EXAMPLE|example|XXXX|xxxx", r"abcdefghij|ABCDEFGHIJ|0123456789")


@dataclass(frozen=True)
class SecretScan:
    classes: tuple[EntropyClass, ...] = CLASSES
    allow: tuple[str, ...] = field(default=ALLOW)
    fragments: tuple[str, ...] = field(default=FRAGMENTS)

    def base(self, text: Column) -> Column:
        text = F.coalesce(text, F.lit(""))
        return F.concat(_matches(text, ASSIGN, 0, ASSIGN_VALUE_CHARS), _matches(text, ACCESS, 1), _matches(text, HEX, 2))

    def windows(self, text: Column, c: EntropyClass) -> Column:
        rank = KINDS.index(c.kind)
        pattern = f"{c.pattern}{{{c.window},}}"
        allowed = "^(?:" + "|".join(self.allow) + ")$"

        def spread(run: Column) -> Column:
            return F.when(run["text"].rlike(allowed), _no_spans()).otherwise(
                F.transform(_entropy_spans(run["text"], c), lambda s: _span(run["start"] + s["start"], rank, run["start"] + s["end"]))
            )

        def pieces(run: Column) -> Column:
            """The run, or what is left of it beside the parts with a fragment."""
            if not self.fragments:
                return F.array(run)
            some = "|".join(self.fragments)
            parts = F.transform(F.split(run["text"], "(?<=[/=])"), lambda p: F.when(p.rlike(some), F.rpad(F.lit(""), F.length(p), F.lit(" "))).otherwise(p))
            left = F.transform(_runs(F.array_join(parts, ""), pattern), lambda r: F.struct((run["start"] + r["start"]).alias("start"), (run["start"] + r["end"]).alias("end"), r["text"].alias("text")))
            return F.when(run["text"].rlike(some), left).otherwise(F.array(run))

        found = F.flatten(F.transform(_runs(text, pattern), pieces))
        return F.when(text.rlike(pattern), F.flatten(F.transform(found, spread))).otherwise(_no_spans())


def _span(start: Column, rank: int, end: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), F.lit(rank).alias("rank"), end.cast("int").alias("end"))


def _no_spans() -> Column:
    return F.array().cast("array<struct<start:int,rank:int,end:int>>")


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _chunks(values: Column, size: int, overlap: int = 0) -> Column:
    """Slices of ``size + overlap`` entries, one from each ``size``-th; the array has more than ``overlap`` entries."""
    last = F.call_function("div", F.size(values) - 1 - overlap, F.lit(size))
    return F.transform(F.sequence(F.lit(0).cast("bigint"), last), lambda k: F.slice(values, (k * size + 1).cast("int"), F.lit(size + overlap)))


def _scan(values: Column, op, kind: str) -> Column:
    """Running results of ``op`` over an array: within chunks first, then over the chunks, so that the work grows with the array."""
    start = F.array().cast(f"array<{kind}>")

    def small(part: Column) -> Column:
        return F.aggregate(part, start, lambda out, x: F.array_append(out, F.when(F.size(out) == 0, x).otherwise(op(F.element_at(out, -1), x))))

    def join(parts: Column, carry: Column) -> Column:
        return F.flatten(F.transform(parts, lambda p, k: F.when(k == 0, p).otherwise(F.transform(p, lambda x: op(F.element_at(carry, k), x)))))

    def whole(v: Column) -> Column:
        return _let(F.transform(_chunks(v, CHUNK), small), lambda parts: _let(small(F.transform(parts, lambda p: F.element_at(p, -1))), lambda carry: join(parts, carry)))

    return _let(values, lambda v: F.when(F.size(v) == 0, start).otherwise(whole(v)))


def _join_new(base: Column, more: Column, rank: int) -> Column:
    """``base`` and those of ``more``, of one rank, that lie within no span of a lower rank."""

    def new(every: Column) -> Column:
        # In the order of starts, a span lies within one before it if the farthest end so far reaches its own.
        far = _scan(F.transform(every, lambda s: F.when(s["rank"] < rank, s["end"]).otherwise(-1)), F.greatest, "int")
        return F.filter(F.zip_with(every, far, lambda s, f: F.when((s["rank"] < rank) | (f < s["end"]), s)), lambda s: s.isNotNull())

    return F.when(F.size(more) == 0, base).otherwise(_let(F.array_sort(F.concat(base, more)), new))


def _runs(text: Column, pattern: str, group: int = 0) -> Column:
    """Matches with their offsets: array of ``struct(start, end, text)``; ``text`` is the asked group."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    asked = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole))
    steps = F.zip_with(
        F.arrays_zip(whole.alias("w"), asked.alias("a")), gaps,
        lambda m, gap: F.struct(F.length(gap).alias("gap"), F.length(m["w"]).alias("len"), m["a"].alias("text")),
    )

    def placed(steps: Column) -> Column:
        ends = _scan(F.transform(steps, lambda s: s["gap"] + s["len"]), lambda a, b: a + b, "int")
        return F.zip_with(steps, ends, lambda s, end: F.struct((end - s["len"]).alias("start"), end.alias("end"), s["text"].alias("text")))

    return _let(steps, placed)


def _matches(text: Column, pattern: str, rank: int, value_chars: int = 0) -> Column:
    """Spans of a detector; with ``value_chars``, group 2 has at least so many characters."""
    runs = _runs(text, pattern, 2 if value_chars else 0)
    if value_chars:
        runs = F.filter(runs, lambda r: F.length(r["text"]) >= value_chars)
    return F.when(text.rlike(pattern), F.transform(runs, lambda r: _span(r["start"], rank, r["end"]))).otherwise(_no_spans())


def _merged(spans: Column) -> Column:
    """Spans in the order of their starts, and of their ends, with those joined that overlap or touch."""

    def join(v: Column) -> Column:
        first = F.filter(v, lambda s, k: (k == 0) | (s["start"] > F.get(v, k - 1)["end"]))
        last = F.filter(v, lambda s, k: (k == F.size(v) - 1) | (F.get(v, k + 1)["start"] > s["end"]))
        return F.zip_with(first, last, lambda a, b: F.struct(a["start"].alias("start"), b["end"].alias("end")))

    return _let(spans, join)


def _entropy_spans(run: Column, c: EntropyClass) -> Column:
    """Merged windows of ``run`` whose entropy reaches the class's bits: array of ``struct(start, end)``.

    One pass over the characters. The state holds the count of each character of the class in the window
    and S = sum of n*log2(n) over these counts; as one character enters and one leaves, two counts and
    two terms of S change, and the window's entropy is log2(W) - S/W. Counts stand side by side in 64-bit
    words. A long run is cut into blocks that overlap by a window less one character; the spans of
    neighbouring blocks that overlap or touch are joined, as they are within a block.
    """
    w = c.window
    field_bits = w.bit_length()
    per_word = 63 // field_bits
    places = range(len(c.alphabet))
    term = F.array(*[F.lit(x) for x in [0.0] + [n * math.log2(n) for n in range(1, w + 1)]])
    word = F.array(*[F.lit(k // per_word + 1) for k in places])
    shift = F.array(*[F.lit(k % per_word * field_bits) for k in places])
    one = F.array(*[F.lit(1 << k % per_word * field_bits) for k in places]).cast("array<bigint>")
    most = w * (math.log2(w) - c.bits) + 1e-9
    state = F.struct(
        F.array_repeat(F.lit(0).cast("bigint"), -(-len(c.alphabet) // per_word)).alias("n"), F.lit(0.0).alias("s"),
        F.lit(-1).alias("from"), F.lit(-1).alias("to"), F.array().cast("array<struct<start:int,end:int>>").alias("out"),
    )

    def term_at(n: Column) -> Column:
        return F.element_at(term, (n + 1).cast("int"))

    def count(n: Column, word_: Column, shift_: Column) -> Column:
        return F.call_function("shiftright", F.element_at(n, word_), shift_).bitwiseAND(F.lit((1 << field_bits) - 1))

    def closed(acc: Column) -> Column:
        return F.when(acc["from"] < 0, acc["out"]).otherwise(F.array_append(acc["out"], F.struct(acc["from"].alias("start"), acc["to"].alias("end"))))

    def moved(codes: Column) -> Column:
        """What enters and leaves at each character of a block."""

        def at(enter: Column, i: Column) -> Column:
            leave = F.when(i >= w, F.get(codes, i - w)).otherwise(0)
            look = lambda table, code: F.element_at(table, F.greatest(code, F.lit(1)))
            return F.struct(i.cast("int").alias("i"), enter.alias("in"), leave.alias("out"), look(word, enter).alias("iw"), look(shift, enter).alias("is"), look(one, enter).alias("i1"),
                            look(word, leave).alias("ow"), look(shift, leave).alias("os"), F.when(leave == 0, F.lit(0).cast("bigint")).otherwise(look(one, leave)).alias("o1"))

        return F.transform(codes, at)

    def step(acc: Column, x: Column) -> Column:
        new = F.transform(acc["n"], lambda n, k: n + F.when(k + 1 == x["iw"], x["i1"]).otherwise(0) - F.when(k + 1 == x["ow"], x["o1"]).otherwise(0))
        up, down = count(acc["n"], x["iw"], x["is"]), count(acc["n"], x["ow"], x["os"])
        more = term_at(up + 1) - term_at(up)
        s = F.when(x["out"] == 0, acc["s"] + more).when(x["out"] == x["in"], acc["s"]).otherwise(acc["s"] + more + term_at(down - 1) - term_at(down))
        return F.struct(new.alias("n"), s.alias("s"), acc["from"].alias("from"), acc["to"].alias("to"), acc["out"].alias("out"), x["i"].alias("i"))

    def judge(acc: Column) -> Column:
        i = acc["i"]
        high = (i >= w - 1) & (acc["s"] <= most)
        first = i - (w - 1)
        joins = high & (acc["from"] >= 0) & (first <= acc["to"])
        return F.struct(
            acc["n"].alias("n"), acc["s"].alias("s"),
            F.when(joins, acc["from"]).when(high, first).otherwise(acc["from"]).alias("from"),
            F.when(high, i + 1).otherwise(acc["to"]).alias("to"),
            F.when(high & ~joins, closed(acc)).otherwise(acc["out"]).alias("out"),
        )

    def block(codes: Column, k: Column) -> Column:
        found = F.aggregate(moved(codes), state, lambda acc, x: _let(step(acc, x), judge), closed)
        at = (k * CHUNK).cast("int")
        return F.transform(found, lambda s: F.struct((at + s["start"]).alias("start"), (at + s["end"]).alias("end")))

    codes = F.transform(F.split(run, ""), lambda ch: F.instr(F.lit(c.alphabet), ch))
    return _merged(F.flatten(F.transform(_let(codes, lambda v: _chunks(v, CHUNK, w - 1)), block)))


def kind_name(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in KINDS]), rank + 1)


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind_name(s["rank"]), s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame, text_col: str = "text", out: str = "secret_spans", scan: SecretScan = SecretScan()) -> DataFrame:
    """``docs`` with a column of all spans: array of ``struct(start, rank, end)`` by start, then kind as listed.

    An entropy span that lies within a base span, or within one of a class listed before, is the same find
    and isn't repeated. Null and empty texts have no spans; very long texts are scanned whole, in time that
    grows with their length; repeated rows each get theirs; an empty table gives an empty table; a column
    named ``out`` is replaced, any other stays. Narrow projections without a shuffle: no group of rows
    meets anywhere.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.withColumn(out, scan.base(text))
    (more,) = unused(found, "more")
    for c in scan.classes:
        found = found.withColumn(more, scan.windows(text, c)).withColumn(out, _join_new(F.col(out), F.col(more), KINDS.index(c.kind)))
    return found.withColumn(out, F.array_sort(out)).drop(more)


def redact_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", scan: SecretScan = SecretScan()) -> DataFrame:
    """``docs`` with each secret in the text replaced by ``mark``; spans that overlap are replaced once.

    Null text stays null; texts without a find stay as they are; repeated rows are each redacted; no row
    is dropped and no other column changed; an empty table gives an empty table.
    """
    (spans,) = unused(docs, "spans")
    text = F.col(text_col)

    def pieces(chunks: Column, cuts: Column) -> Column:
        """The text between the cuts, put together from chunks of it."""

        def between(a: Column, b: Column) -> Column:
            k = F.call_function("div", a, F.lit(CHUNK))
            held = F.slice(chunks, (k + 1).cast("int"), (F.call_function("div", b, F.lit(CHUNK)) - k + 1).cast("int"))
            return F.substring(F.array_join(held, ""), a - (k * CHUNK).cast("int") + 1, b - a)

        before = F.transform(cuts, lambda s, k: between(F.when(k == 0, 0).otherwise(F.get(cuts, k - 1)["end"]), s["start"]))
        return F.array_append(before, between(F.element_at(cuts, -1)["end"], F.length(text)))

    def cuts(v: Column) -> Column:
        # Spans that touch without overlapping have a mark each.
        ends = _scan(F.transform(v, lambda s: s["end"]), F.greatest, "int")
        return _let(ends, lambda far: F.zip_with(
            F.filter(v, lambda s, k: (k == 0) | (s["start"] >= F.get(far, k - 1))),
            F.filter(far, lambda e, k: (k == F.size(v) - 1) | (F.get(v, k + 1)["start"] >= e)),
            lambda s, e: F.struct(s["start"].alias("start"), e.alias("end"))))

    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}+"), F.lit(0))
    joined = _let(F.struct(chunks.alias("chunks"), _let(F.col(spans), cuts).alias("cuts")), lambda x: F.array_join(pieces(x["chunks"], x["cuts"]), mark))
    return find_secrets(docs, text_col, spans, scan).withColumn(text_col, F.when(F.size(spans) > 0, joined).otherwise(text)).drop(spans)


def op1_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), out="s")
    count = lambda rank: F.size(F.filter("s", lambda x: x["rank"] == rank)).cast("long")
    return docs.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(listed(F.filter("s", lambda x: x["rank"] <= 2)), 256).alias("base_sha256"),
        listed(F.col("s")).alias("spans"), F.size(F.filter("s", lambda x: x["rank"] > 2)).cast("long").alias("n_entropy"),
    )
