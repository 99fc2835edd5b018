"""Public tokenizers inside tasks, and exact length histograms."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.tables import settle, table


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file is; pass another path to use another file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer(dict):
    """Ids of a word-level BPE tokenizer, as little-endian 32-bit bytes; words met before are kept.

    A text of Latin-1 letters, digits, signs and plain white space splits into words here exactly as in
    the tokenizer, and its ids are those of its words; all other texts go to the tokenizer as a whole.
    The words of a batch that are new are encoded as one text and cut where a word ends.
    """

    SIMPLE = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xff]*")
    _LETTER, _DIGIT = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
    WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^\s{_LETTER}{_DIGIT}]+")
    MOST = 1 << 18

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    @staticmethod
    @lru_cache(maxsize=2)
    def load(path: str) -> WordTokenizer:
        return WordTokenizer(path)

    def encode(self, text: str) -> np.ndarray:
        # A batch of one text runs on the calling thread alone and skips the offsets.
        return np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, new: list[str]) -> None:
        ids = self.encode(" ".join(new))
        cuts = (np.flatnonzero(self.last[ids]) + 1).tolist()
        if len(cuts) != len(new):  # a vocabulary whose word ends aren't marked alike: word by word
            self.update((w, self.encode(w).tobytes()) for w in new)
            return
        raw = ids.tobytes()
        self.update(zip(new, (raw[4 * i : 4 * j] for i, j in zip([0, *cuts], cuts))))

    def id_bytes(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, for a batch of texts."""
        if len(self) >= self.MOST:
            self.clear()
        out, split = [b""] * len(texts), {}
        for i, t in enumerate(texts):
            if "<|" in t or not self.SIMPLE.fullmatch(t):
                out[i] = self.encode(t).tobytes()
            else:
                split[i] = self.WORDS.findall(t.lower())
        if new := set().union(*split.values()).difference(self):
            self._learn(sorted(new))
        for i, words in split.items():
            out[i] = b"".join(map(self.__getitem__, words))
        return out


#: Context limits that a histogram's rows stand for are its lengths themselves; lengths are summed in steps of this.
STEP = 256
TOKENIZER = "byte_bpe_50k.tiktoken"


@lru_cache(maxsize=2)
def byte_encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, text_col: str = "text", out: str = "n_tokens", path: str | None = None) -> DataFrame:
    """``docs`` with the number of tokens of each whole text; null and empty texts have none. No shuffle.

    Repeated rows are counted each; an empty table gives an empty table; a column named ``out`` is replaced, any other stays.
    """
    path = path or tokenizer_path(TOKENIZER)

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = byte_encoding(path).encode_ordinary
        for b in batches:
            yield pd.Series([len(encode(t)) if t else 0 for t in b], dtype="int64")

    return docs.withColumn(out, run(F.col(text_col)))


def length_histogram(counted: DataFrame, col: str = "n_tokens", step: int = STEP) -> DataFrame:
    """One row per length that occurs, taken as a context limit L too:

    ``n_tokens`` L, ``n_docs`` of that length, ``docs_from`` and ``tokens_from`` of length L or more,
    ``total_docs``, ``total_tokens``, ``quantile`` (part of documents of length L or less) and
    ``truncated_tokens``, the sum of min(length, L). Null lengths are left out; an empty table gives none.

    Documents are counted per length before the shuffle, and the counts written once, so that each length is
    worked out once. Suffix sums go first over steps of lengths, then within each, so no task sorts all lengths.
    """
    hist = settle(counted.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("long").alias("n_tokens")).agg(F.count("*").alias("n_docs")))
    hist = hist.withColumn("_step", F.expr(f"n_tokens div {step}"))
    steps = hist.groupBy("_step").agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("t"))
    after = Window.orderBy(F.col("_step").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    steps = steps.select(F.col("_step"), F.coalesce(F.sum("d").over(after), F.lit(0)).alias("_d"), F.coalesce(F.sum("t").over(after), F.lit(0)).alias("_t"),
                         F.sum("d").over(every).alias("total_docs"), F.sum("t").over(every).alias("total_tokens"))
    within = Window.partitionBy("_step").orderBy(F.col("n_tokens").desc())
    rows = hist.join(steps, "_step").withColumns({
        "docs_from": F.col("_d") + F.sum("n_docs").over(within),
        "tokens_from": F.col("_t") + F.sum(F.col("n_docs") * F.col("n_tokens")).over(within),
    })
    return rows.select(
        "n_tokens", "n_docs", "docs_from", "tokens_from", "total_docs", "total_tokens",
        ((F.col("total_docs") - F.col("docs_from") + F.col("n_docs")) / F.col("total_docs")).alias("quantile"),
        (F.col("total_tokens") - F.col("tokens_from") + F.col("docs_from") * F.col("n_tokens")).alias("truncated_tokens"),
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """One row per context limit, whether or not a text has that length: ``context_limit, n_docs, n_tokens,
    docs_over, truncated_tokens``, from the suffix sums at the least length that is longer.

    An empty histogram gives no documents and no tokens at each limit.
    """
    longer = lambda n: F.min_by(F.struct("docs_from", "tokens_from"), F.when(F.col("n_tokens") > n, F.col("n_tokens")))
    rows = F.array(*[F.struct(F.lit(n).cast("long").alias("context_limit"), longer(n).alias("s")) for n in limits])
    found = histogram.agg(F.coalesce(F.first("total_docs"), F.lit(0)).alias("n_docs"), F.coalesce(F.first("total_tokens"), F.lit(0)).alias("n_tokens"), rows.alias("r"))
    over, tokens = F.coalesce("r.s.docs_from", F.lit(0)), F.coalesce("r.s.tokens_from", F.lit(0))
    return found.withColumn("r", F.explode("r")).select("r.context_limit", "n_docs", "n_tokens", over.alias("docs_over"), (F.col("n_tokens") - tokens + over * F.col("r.context_limit")).alias("truncated_tokens"))


def quantile_lengths(histogram: DataFrame, parts: list[float]) -> DataFrame:
    """``part, n_tokens``: the least length that at least a part of all documents doesn't exceed; null for an empty histogram."""
    rows = F.array(*[F.struct(F.lit(q).alias("part"), F.min(F.when(F.col("quantile") >= q, F.col("n_tokens"))).alias("n_tokens")) for q in parts])
    return histogram.agg(rows.alias("r")).select(F.explode("r").alias("r")).select("r.part", "r.n_tokens")


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    return length_histogram(token_counts(table(spark, sf_dir, "documents").select("text")))
