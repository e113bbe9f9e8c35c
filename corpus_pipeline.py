"""A corpus from raw documents to packed sequences, as stages over the documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecall.llm import decontaminate, lines, ngram_join, packing, toxicity
from tidecall.llm.common import Scratch, row_key, table, unused
from tidecall.llm.queries import TOKENIZER, toxicity_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; the model learns from the labels outside fold 1."""
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_line_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs; ``n_chars`` follows the text.

    A document of which nothing but white space is left goes.
    """
    found = lines.dedup_lines(docs)
    changed = F.col("n_removed") > 0
    kept = found.where(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    n_chars = F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return kept.select(*[n_chars.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Five-word shingles and a similarity of 0.8. Of rows with one id the text with the smaller
    digest is the smaller, and one of rows that agree in id and text stays. Documents without
    words are in no group and stay.
    """
    row = unused(docs, "row")
    named = docs.withColumn(row, F.struct("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key")))
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    groups = ngram_join.similar_documents(
        named.where(has_words), shingle_words=5, percent=80, id_col=row
    )
    firsts = groups.where("doc_id = component_id").select(F.col("doc_id").alias(row)).distinct()
    kept = named.where(has_words).join(firsts, row, "left_semi").dropDuplicates([row])
    return kept.select(*docs.columns).unionByName(docs.where(~has_words))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, in sequences of 4096 tokens."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_line_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("packing", pack_sequences),
]

#: SQL has no words for a trained classifier, SimHash or the tokenizer; tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one written before the next."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
