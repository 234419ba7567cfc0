"""A training corpus from raw documents, stage by stage.

Every stage takes what its predecessor kept and returns it with the columns of documents, less the
rows or lines that it decides against; the last packs what remains.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import decontaminate, language, line_dedup, near_copies, packing
from tickloom.llm.batches import keep, set_aside
from tickloom.llm.queries import table, tokenizer_file

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A text that agrees with no language's profile to this share is in none of them. Texts in a
#: learned language score above 0.4.
MIN_LANGUAGE_SCORE = 0.2


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that their own labelled texts teach; those without a letter go too.

    Where no document has a language to learn from, those without a letter go alone.
    """
    profiles = language.learn(docs, F.col("doc_id").isNotNull())
    mine, back = set_aside(docs, {"lang_pred", "score"})
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE) if profiles.languages else F.col("text").rlike(r"\p{L}")
    return back(language.identify(mine, profiles).where(known))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, less the lines that many documents hold; n_chars follows the text."""
    mine, back = set_aside(docs, {"n_lines", "n_dropped"})
    kept = line_dedup.dedup_lines(mine)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return back(kept)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: SimHash classes and, beyond their radius, MinHash
    bands; every link is confirmed on five-word shingles, Jaccard 0.8."""
    return near_copies.drop_near_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), end_id=0)


STAGES: list[tuple[str, Stage]] = [
    ("language", identified),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: Language, fingerprints and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
