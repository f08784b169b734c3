"""From raw documents to packed sequences: language ID, near-dedup, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; its result is written as
Parquet and read again. All but the last return the columns of ``documents``; other columns, whatever their names, are
dropped by the first. Any column may be null; empty tables pass through every stage; long texts are held one at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltgraph.llm import language, minhash, mixing, packing, personal
from quiltgraph.llm.common import forget, stored, table

#: Least posterior of the language found; texts without a letter are rejected whatever their score.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found stay, as they are. Null and empty texts, and texts without a letter, go; repeated
    rows are judged each for itself; ties between languages do not reject."""
    model = language.learn(docs.where(~language.held_out(F.col("doc_id"))))
    return language.accepted(docs, model, LEAST_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays: the row of least id (null last; ties: the first by language,
    source and n_chars). Repeated rows are duplicates; rows of one id and other texts are not; texts without words stay."""
    return minhash.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the texts; every document stays, repeated rows too. Null stays null; n_chars follows a
    changed text, else it is kept."""
    return personal.masked(docs, personal.train(docs, docs.count()))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix reads them, in training order. Null and empty texts take no words, so they are not read; a null
    source is a source of its own. Ties of the draw are settled by id, size, text and the other columns."""
    return mixing.mixed(docs, docs.count())


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in sequences of 4096 tokens. A null or empty text is its end token; repeated rows
    are packed each for itself; ties in length go by id, piece and checksum."""
    return packing.pack(packing.pieces_of(docs), docs.count(), **packing.FEWEST)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("personal_data", personal_data), ("mix_sources", mix_sources), ("pack_sequences", pack_sequences)]

#: The stages run trained models, hashing and a tokenizer; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir))
        forget(before)
    return STAGES[-1][1](spark, docs, sf_dir)
