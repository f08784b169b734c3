"""The subpackage's queries, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltgraph.llm import chunking, language, minhash, mixing, negatives, neighbours, oracles, output, packing, personal, sharding, substring, toxicity, vector_codes
from quiltgraph.llm.common import table


def op1_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup(table(spark, sf_dir, "documents"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return personal.find(docs, personal.train(docs, docs.count()))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return chunking.fingerprints(docs, docs.count())


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(packing.pieces_of(docs), docs.count(), **packing.FEWEST)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sharding.assign(docs, sharding.production_tree(), docs.count())


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, docs.count())


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, F.col("vec_id") % 100 == 0)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.learn(docs.where(~language.held_out(F.col("doc_id"))))
    out = language.predict(docs, model)
    return out.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return output.packed_rows(table(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), label, F.col("vec_id") % 100 == 0)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.codes(table(spark, sf_dir, "embeddings"))


def neighbours_in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each query of op8, and whether a search over at least eight parts finds nine in ten of all true neighbours."""
    vectors = table(spark, sf_dir, "embeddings")
    asks = F.col("vec_id") % 100 == 0
    n = vectors.count()
    found = neighbours.search(vectors, asks, part_rows=min(neighbours.PART_ROWS, max(1, n // 8)))
    exact = neighbours.search(vectors, asks, part_rows=max(1, n))
    both = exact.select("query_id", "vec_id").join(found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
    each = both.groupBy("query_id").agg(F.count("hit").alias("hits"), F.count("*").alias("n"))
    recall = each.agg(F.sum("hits") / F.sum("n")).first()[0] or 0.0
    return each.select("query_id", F.lit(recall >= 0.9).alias("enough"))


def personal_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op3 that SQL can say."""
    return op3_personal_data(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone")


def fingerprint_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op4 that SQL can say."""
    return op4_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


def queries() -> dict:
    own = (op1_substring, op2_near_duplicates, op3_personal_data, op4_fingerprints, op5_packing, op6_sharding, op7_mixing, op8_neighbours, op9_language, op10_token_output, op11_toxicity, op12_hard_negatives, op13_vector_codes)
    return {f.__name__: f for f in (*own, neighbours_in_parts, personal_base_counts, fingerprint_texts)}


def oracle_sql() -> dict[str, str]:
    found = {"op1_substring": oracles.op1_sql, "op2_near_duplicates": oracles.op2_sql, "op6_sharding": oracles.op6_sql, "op7_mixing": oracles.op7_sql, "op8_neighbours": oracles.op8_sql, "op12_hard_negatives": oracles.op12_sql, "op13_vector_codes": oracles.op13_sql}
    return {k: f() for k, f in (found | {"personal_base_counts": oracles.base_counts_sql, "fingerprint_texts": oracles.edited_sql, "neighbours_in_parts": oracles.recall_sql}).items()}
