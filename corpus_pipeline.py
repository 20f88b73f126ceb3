"""A corpus pipeline of five stages; each reads what the one before it wrote.

Language ID keeps documents whose language is recognised; line dedup takes recurring lines out of texts; near-dedup
keeps one document of each group of five-word similarity 0.8 or more; decontamination takes out documents with
benchmark passages; BPE gives the token ids of what is left.

Every stage takes tables without rows, and extra columns of any name, which all but the last hand on. Repeated rows
are rows of their own, until near-dedup: there rows with one key stay or go together. What a stage does with nulls
stands with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tesserae.functions.storage import cut
from tesserae.llm import bpe, decontaminate, langid, line_templates, shingle_dedup
from tesserae.llm.registry import table, tokenizer_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model, trained on these documents' own labels, accepts.

    Null and empty texts, and those without a letter, are rejected; documents without a key or a label are judged as
    others are. Without any label nothing is accepted.
    """
    return langid.keep_identified(docs, langid.fit(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that recur in five documents; ``n_chars`` follows the text.

    Long lines that only two documents share stay: copies of documents are the next stage's, which needs their lines.
    Null texts become empty; a document without a key is never the one that keeps a recurring line.
    """
    also = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    found = line_templates.drop_recurring_lines(docs, min_docs_long=5, also=also)
    if "n_chars" in also:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id.

    Null and empty texts are equal to each other; documents without a key stay, as nothing names them.
    """
    return shingle_dedup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark passage occurs; null and empty texts, and documents without a key, stay."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (packed little-endian uint32) of every document, and digests of them and of what they decode to.

    Null and empty texts have no tokens; documents without a key keep their row.
    """
    found = bpe.encode(docs, tokenizer_path())
    return found.select(
        "doc_id",
        "token_ids",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language ID", language),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("BPE", tokens),
]

#: The model, the fingerprints and the tokens are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
