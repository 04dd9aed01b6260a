"""A corpus pipeline of five stages; each is written as Parquet and read again as the next one's documents.

Defined results of ``run``: null and empty texts pass the first four stages as they are and are packed as empty documents; a null doc_id
is an id like others, repeated rows and texts under one id are judged by their text; of equal texts one row stays, the one with the smallest id; very long texts are whole rows in
every stage; columns beyond those of documents, whatever their names, pass the first four stages unchanged; an empty table gives an empty result,
and without labels of both kinds no document is toxic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fwloom.llm import neardup, packing, secrets, suffixes, toxicity
from fwloom.llm.common import materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that operator 4 does not predict to be toxic; a null text stays."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_texts(docs, model, "__score")
    return scored.where(F.col("__score") < toxicity.THRESHOLD).select(*(F.col(f"`{c}`") for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of operator 2, the one with the smallest id."""
    return neardup.keep_one(docs)


def strip_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that start earlier in the corpus; every document stays."""
    return suffixes.strip_repeats(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a mark in place of every secret, and ``n_chars`` to match; documents without secrets, null and empty texts are unchanged, no row goes."""
    return secrets.redacted(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 2048 tokens: at least a piece for each row, null and empty texts too; a long text has several; repeated rows have places of their own."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_strings", strip_repeated_strings),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

#: Shingle signatures, suffix arrays, learnt scores and packing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
