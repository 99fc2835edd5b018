"""Ranked lexical search by pipelined term partitioning.

Terms are dealt to owners. A bundle of items goes from owner to owner with sparse accumulators of its documents'
scores, and each owner adds the contributions of its own terms. The owners of rare terms come first, so what
a bundle carries stays small; at the last owner, that of the frequent terms, the best documents are chosen.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.tables import forget, settle, table

TOP = 20
#: A bundle's accumulators lie in blocks of about so many documents.
BLOCK_DOCS = 1024
#: A bundle has about so many items and characters of items at most (and one item at least).
BUNDLE_ITEMS = 1024
BUNDLE_CHARS = 8_000_000
#: What a bundle carries after each owner but the last: at most so many accumulators for each document.
CARRIED = (4, 16)
#: Bytes of a text that are split into terms at once.
SLICE = 1 << 20

#: Digits and letters stay, A to Z in lower case; other ASCII is a separator; bytes of other characters stay.
_TERMS = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))

_ACCUMULATORS = "block int, item int, docs array<long>, scores array<long>"


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists that cover SLICE bytes or one term each."""
    left = (text or "").encode("utf-8", "surrogatepass").translate(_TERMS)
    at = 0
    while at < len(left):
        end = left.find(b" ", at + SLICE)
        end = len(left) if end < 0 else end
        yield left[at:end].split()
        at = end


def term_counts(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n, terms, tfs`` of the documents with a term: how many terms it has, and how often each one of ``vocabulary`` occurs."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        ids = known.value
        for b in batches:
            rows, sizes, found, often = [], [], [], []
            for k, text in enumerate(b.column(1)):
                counts: Counter = Counter()
                for part in terms(text.as_py()):
                    counts.update(part)
                if counts:
                    own = [(ids[t], n) for t, n in counts.items() if t in ids]
                    rows.append(k)
                    sizes.append(counts.total())
                    found.append([t for t, _ in own])
                    often.append([n for _, n in own])
            yield pa.record_batch([b.column(0).take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int32())), pa.array(often, pa.list_(pa.int64()))], ["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("text IS NOT NULL").mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def owners(df: dict[int, int], uses: Counter, n_docs: int) -> np.ndarray:
    """The owner of each term: terms in the order of their document counts, cut where ``CARRIED`` is reached."""
    out, made = np.full(max(df, default=-1) + 1, len(CARRIED)), 0
    for t in sorted(df, key=lambda t: (df[t], t)):
        made += df[t] * uses[t]
        out[t] = sum(made > c * n_docs for c in CARRIED)
    return out


def _deal(counts: DataFrame, owner: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """``block, owner, row, doc_id, m, terms, tfs``: what each owner has of a document, without others' terms.

    The last owner has a row for each document with any, as the documents' ids are there.
    """
    last, names = len(CARRIED), ["block", "owner", "row", "doc_id", "m", "terms", "tfs"]

    def run(batches):
        for b in batches:
            block, row, doc_id, n, lists, tfs = b.columns
            sizes = np.diff(lists.offsets.to_numpy())
            doc = np.repeat(np.arange(len(b)), sizes)
            flat, often = lists.flatten().to_numpy(), tfs.flatten().to_numpy()
            m = 75 + 25 * n.to_numpy() * n_docs // n_terms
            for k in range(last + 1):
                mine = owner[flat] == k
                some = np.flatnonzero(np.bincount(doc[mine], minlength=len(b)) if k < last else sizes)
                ends = np.searchsorted(doc[mine], some, "right")
                offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                take = pa.array(some)
                yield pa.record_batch([block.take(take), pa.array(np.full(len(some), k, np.int32)), row.take(take), doc_id.take(take), pa.array(m[some], pa.int64()),
                                       pa.ListArray.from_arrays(offsets, pa.array(flat[mine], pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(often[mine], pa.int64()))], names)

    return counts.select("block", "row", "doc_id", "n", "terms", "tfs").mapInArrow(run, "block int, owner int, row long, doc_id long, m long, terms array<int>, tfs array<long>")


def _flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(values, number of them in each list)."""
    lists = lists.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())


def _added(items: list[tuple[np.ndarray, np.ndarray]], carried: pa.Table, own: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(rows of documents, scores by item and document): what was carried, and the owner's contributions."""
    rows, m = own.column("row").to_numpy(), own.column("m").to_numpy()
    before, n_before = _flat(carried.column("docs"))
    docs = np.unique(np.concatenate([rows, before]).astype(np.int64))
    scores = np.zeros((len(items), len(docs)), np.int64)
    scores[np.repeat(carried.column("item").to_numpy(), n_before), np.searchsorted(docs, before)] = _flat(carried.column("scores"))[0]
    term, sizes = _flat(own.column("terms"))
    tf, doc = _flat(own.column("tfs"))[0], np.repeat(np.searchsorted(docs, rows), sizes)
    share = 1_000_000_000 * tf // (1000 * tf + 12 * np.repeat(m, sizes))
    order = np.argsort(term, kind="stable")
    term, doc, share = term[order], doc[order], share[order]
    for k, (wanted, weights) in enumerate(items):
        lo, hi = np.searchsorted(term, wanted), np.searchsorted(term, wanted, "right")
        for x in np.flatnonzero(lo < hi):  # a document has one row, so none is met twice under a term
            scores[k, doc[lo[x] : hi[x]]] += weights[x] * share[lo[x] : hi[x]]
    return docs, scores


def _best(scores: np.ndarray, ids: np.ndarray, none: np.ndarray, top: int) -> np.ndarray:
    """Places of the highest scores above 0, equal ones by ascending id, null ids last."""
    at = np.flatnonzero(scores > 0)
    if len(at) > top:
        at = at[scores[at] >= np.partition(scores[at], -top)[-top]]
    return at[np.lexsort((ids[at], none[at], -scores[at]))][:top]


def _rank_bundle(docs: DataFrame, bundle: list[tuple[int | None, str | None]], top: int, id_col: str, text_col: str) -> DataFrame:
    """``item (place in bundle), doc_id, score`` of the best of each block: the best of all documents are among them."""
    spark = docs.sparkSession
    wanted = [Counter(t for part in terms(text) for t in part) for _, text in bundle]
    vocabulary = {t: k for k, t in enumerate(sorted(set().union(*wanted)))}
    raw = settle(term_counts(docs, vocabulary, id_col, text_col).withColumn("row", F.monotonically_increasing_id()))
    n_docs, n_terms = raw.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = {r[0]: r[1] for r in raw.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}
    uses = Counter(vocabulary[t] for w in wanted for t in w)
    owner = owners(df, uses, n_docs)
    listed = [sorted((vocabulary[t], k * weight(n_docs, df[vocabulary[t]])) for t, k in w.items() if vocabulary[t] in df) for w in wanted]
    items = spark.sparkContext.broadcast([(np.array([t for t, _ in x], np.int32), np.array([w for _, w in x], np.int64)) for x in listed])
    blocks = n_docs // BLOCK_DOCS + 1
    postings = settle(_deal(raw.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")), owner, n_docs, max(1, n_terms)))
    forget(raw)

    def visit(carried: pa.Table, own: pa.Table) -> pa.Table:
        docs, scores = _added(items.value, carried, own)
        block = (own if len(own) else carried).column("block")[0].as_py()
        some = [k for k in range(len(scores)) if scores[k].any()]
        places = [np.flatnonzero(scores[k]) for k in some]
        return pa.table({"block": pa.array([block] * len(some), pa.int32()), "item": pa.array(some, pa.int32()), "docs": pa.array([docs[p] for p in places], pa.list_(pa.int64())),
                         "scores": pa.array([scores[k][p] for k, p in zip(some, places)], pa.list_(pa.int64()))})

    def choose(carried: pa.Table, own: pa.Table) -> pa.Table:
        docs, scores = _added(items.value, carried, own)
        order = np.argsort(own.column("row").to_numpy())
        ids = own.column("doc_id").combine_chunks().take(pa.array(order))
        plain, none = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
        best = [_best(s, plain, none, top) for s in scores]
        place = np.concatenate([np.zeros(0, np.int64), *best])
        item = np.repeat(np.arange(len(best)), [len(b) for b in best])
        return pa.table({"item": pa.array(item, pa.int32()), "doc_id": ids.take(pa.array(place)), "score": pa.array(scores[item, place], pa.int64())})

    bundles = spark.createDataFrame([], _ACCUMULATORS)
    for k in range(len(CARRIED) + 1):
        last = k == len(CARRIED)
        own = postings.where(F.col("owner") == k).groupBy("block")
        bundles = bundles.groupBy("block").cogroup(own).applyInArrow(choose if last else visit, "item int, doc_id long, score long" if last else _ACCUMULATORS)
    return bundles


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of each item with a score above 0.

    A term weighs more the fewer documents hold it, and a document's share of that grows with how often it
    holds the term and falls with its length; all sums are of whole numbers. Equal scores are in the order of
    ascending ids, null ids last. Repeated rows are documents and items of their own, null and empty texts
    have no terms, and an empty table of either gives an empty table; other columns play no part.

    Items go in bundles of bounded size, one after the other; a bundle's terms and weights, and their
    document counts, are what passes through the driver. Documents' term counts are written once for each
    bundle, cut by the owners of the terms, and meet the bundle's accumulators in blocks of documents.
    """
    n, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.length(item_text)), F.lit(0))).first()
    cuts = max(1, -(-n // BUNDLE_ITEMS), -(-chars // BUNDLE_CHARS))
    rows = items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")).withColumn("bundle", F.pmod(F.xxhash64("item_id", "text"), F.lit(cuts)))
    if n == 0:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = []
    for k in range(cuts):
        bundle = [(r.item_id, r.text) for r in rows.where(F.col("bundle") == k).orderBy("item_id", "text").collect()]
        if bundle:
            names = docs.sparkSession.createDataFrame([(i, x[0]) for i, x in enumerate(bundle)], "item int, item_id long")
            best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
            ranked = _rank_bundle(docs, bundle, top, id_col, text_col).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
            found.append(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return reduce(DataFrame.unionByName, found)


def op12_ranked_search(spark, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SQL_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_TERMS} AS t FROM documents WHERE text IS NOT NULL),
e AS (SELECT r, doc_id, len(t) AS n, t FROM d WHERE len(t) > 0),
s AS (SELECT count(*)::BIGINT AS all_docs, sum(n)::BIGINT AS all_terms FROM e),
q AS (SELECT item_id, term, count(*) AS k FROM (SELECT item_id, unnest({_SQL_TERMS}) AS term FROM benchmark) GROUP BY ALL),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(t) AS term FROM e) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
f AS (SELECT term, floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, s GROUP BY term, all_docs),
c AS (SELECT item_id, r, doc_id, sum(k * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * all_docs) // all_terms))))::BIGINT AS score FROM q JOIN p USING (term) JOIN f USING (term), s GROUP BY ALL),
o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM c WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM o WHERE rank <= {TOP}
"""
