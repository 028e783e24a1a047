"""A training corpus from raw documents: each stage is written as Parquet and read by the next."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm import common, mixing, neardup, packing, pii, quality


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    machine = quality.learned(docs, common.table(spark, sf_dir, "labels"))
    docs, back = common.set_aside(docs, ("quality_score",))
    return back(quality.scored(docs, machine).filter("quality_score >= 0.5").select(*docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates.

    Documents without id stay. Rows that share the id that is kept stay once for each text.
    """
    kept = neardup.near_duplicates(docs).filter("kept and doc_id is not null").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).unionByName(docs.filter("doc_id is null"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Identifiers and the terms that reveal them are generalised or removed."""
    docs, back = common.set_aside(docs, ("pii_base", "pii_spans"))
    out = pii.sanitised(docs).withColumn("text", pii.masked(F.col("text"), F.col("pii_spans")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("pii_spans") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return back(out.select(*docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    import public_tokenizers

    pieces = common.saved(packing.tokenised(docs, public_tokenizers.path("byte_bpe_50k.json")), "packing-pieces")
    return packing.packed(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("quality", keep_quality), ("neardup", drop_near_duplicates), ("pii", mask_personal_data), ("mix", mix_sources), ("pack", pack)]

#: Classifiers, tokenisers and hashes are beyond SQL; a brute-force version tests the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return functools.reduce(lambda d, stage: common.saved(stage[1](spark, d, sf_dir), f"stage-{stage[0]}"), STAGES[:-1], docs).transform(lambda d: STAGES[-1][1](spark, d, sf_dir))
