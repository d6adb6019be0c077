"""The corpus pipeline: quality, near-duplicates, benchmark passages, personal data, tokens.

Each stage reads all rows that the one before it kept; all but the last return the columns of documents.

Defined cases, for all stages: an empty table gives no rows; a null text is an empty one for every decision and stays null in
the stages that return texts; a null doc_id is a document as any other; repeated rows get equal decisions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.llm import bpe, decontaminate, pii, quality, simhash
from lexforge.llm.common import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts, at 0.5 too. Without labels of both kinds every document scores 0.5 and stays."""
    net = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.classify(docs, net, score="__score").where(F.col("__score") >= 0.5).drop("__score")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: that of the smallest doc_id, of its unlike texts the one of the smallest hash.

    Empty, null and blank texts are one group. Documents without a doc_id name no group and stay.
    """
    return simhash.one_of_each_group(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage, all of them if the benchmark is empty; those that hold one go whole."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data; n_chars follows the new text and stays null where it was."""
    made = pii.surrogates(docs, pii.DEMO_KEY, listed=False)
    return made.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(dict(docs.dtypes)["n_chars"])))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, with digests of the ids and of the decoded text; empty and null texts have no tokens."""
    return bpe.encode_texts(docs.select("doc_id", "text", "lang", "source")).select("doc_id", "lang", "source", "n_tokens", "token_ids", "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("simhash", keep_one_of_each_group),
    ("decontamination", drop_benchmark),
    ("pii", replace_private),
    ("bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs


#: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None
