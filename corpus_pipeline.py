"""A corpus pipeline of five stages; each is given what the one before it kept.

``STAGES`` are (name, function) with ``function(spark, docs, sf_dir) -> DataFrame``. All but the last
return the columns of ``documents``. ``run`` writes each stage's rows as Parquet in the shared folder and
reads them again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.lines import drop_boilerplate
from tidewell.llm.packing import pack, token_pieces
from tidewell.llm.secrets import redact_secrets
from tidewell.llm.similar import keep_one_similar
from tidewell.llm.tables import forget, settle, table, unused
from tidewell.llm.toxicity import score_toxicity, train


def _measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``n_chars`` follows a changed text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(columns) if "n_chars" in columns else docs.select(columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.5 or more go.

    Null and empty texts have the model's bias alone; repeated rows stay or go together; without labels of
    both kinds all stay or go by the labels' share; an empty table gives an empty table.
    """
    model = train(docs, table(spark, sf_dir, "labels"))
    (score,) = unused(docs, "toxicity")
    return score_toxicity(docs, model, out=score).where(F.col(score) < 0.5).drop(score)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each source leave its texts; every document stays.

    Null texts and those of a null source stay as they are; repeated rows are pages of their own; an empty
    table gives an empty table.
    """
    return _measured(drop_boilerplate(docs), docs.columns)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with 5-word shingle similarity of 0.8 or more stays, that of the smallest id.

    Texts without words, null ones too, are one group; rows without an id all stay; of equal rows one stays;
    an empty table gives an empty table.
    """
    return keep_one_similar(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; every document stays. Null texts stay null; an empty table gives an empty table."""
    return _measured(redact_secrets(docs), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, each with its sequence and its place there.

    A null or empty text has a piece of its end id alone; repeated rows and null ids are packed like any
    other; an empty table gives none.
    """
    return pack(token_pieces(docs))


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("simhash", simhash), ("secrets", secrets), ("packing", packing)]

#: A fitted classifier and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before, docs = docs, settle(stage(spark, docs, sf_dir))
        forget(before)
    return STAGES[-1][1](spark, docs, sf_dir)
