"""A training-data pipeline over `documents`: STAGES in order, each written as Parquet and read again by the next.

All stages but the last keep the columns of their documents, whatever others there are and whatever their names; a table
without rows gives one without rows. A null doc_id is kept as it is, and repeated rows are rows of their own, where a stage
doesn't say otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldglass.llm import langid, mixing, packing, quality, simhash
from fieldglass.llm.common import drop, fresh, stage_only
from fieldglass.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in which no language is found: those of null or empty text or without any letter, and all, if no document
    has a language to learn from. A null lang is no label."""
    known = docs.select("text", "lang").where("lang is not null")
    (found,) = fresh(docs, "found")
    kept = docs.withColumn(found, langid.identify(F.col("text"), langid.train(known)))
    return kept.where(F.col(f"{found}.lang") != langid.UNKNOWN).drop(found)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents of low quality and toxic ones. Null sources and languages are sites of their own; without labels the
    document classifier knows nothing and all stay."""
    found = quality.classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    (name,) = fresh(docs, "quality")
    return found.where(F.col(f"{name}.keep")).drop(name)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates, that of the smallest doc_id: linked are texts whose sets of five-word
    shingles have a similarity of 0.8 or more. Of rows that share that id one stays, by the text's hash; a class without an id
    keeps one row. Texts without words are alike."""
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixes sources by the weights 3, 1, 2, repeating, to 150 % of all words: a document stands as often as it is taken,
    where its shard's local shuffle puts it. Null is a source of its own; texts without words come as often as their source's
    passes take them."""
    mixed = mixing.mix(docs, lambda names: [(3, 1, 2)[i % 3] for i in range(len(names))])
    return mixed.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the mix into sequences of 4096 tokens: one row a piece, with its place. A null text is an empty one, which has only the
    end. Copies are packed each; ties go by doc_id, piece and place."""
    return packing.pack(docs, tokenizer_path(), kept_words=100_000)  # workers hold what earlier stages left, too


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages, applied to documents one after the other. Each is written, and what it was made from
    deleted, before the next begins."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, function in STAGES[:-1]:
        before, docs = docs, stage_only(lambda f=function, d=docs: f(spark, d, sf_dir))
        drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The stages use models trained on the data; tests hold each against a brute-force version.
ORACLE_SQL = None
