"""From raw documents to packed training sequences: five stages, each over all that the one before has kept.

A stage takes (spark, docs, sf_dir) and gives a DataFrame that is stored as Parquet and read again as the docs of the
next. All but the last keep the columns of documents.

Edge cases, in every stage: a null id is a row of its own kind and judged by its text; rows that share an id are judged each
by its own text, and equal rows alike. A null or empty text is too short for the first stage; if it gets to a later one it
is no duplicate, holds no benchmark window and no secret, and packs as its end token alone. Texts are taken as a whole,
however long. Extra columns are carried along unread, whatever their names. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.llm import decontaminate, neardup, packing, quality, secrets
from sluice.session import scratch_folder, through_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the tokeniser's bands reject go; null and empty texts among them."""
    return quality.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates (five-word shingles, similarity 0.8) the one with the smallest id stays; texts that
    share an id are judged each by itself. Of rows with the same id and text one stays; rows without an id all stay."""
    return neardup.keep(docs, one_per_id=False)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth of their words in benchmark windows go; a text without words has none."""
    return decontaminate.keep(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with a mask in place of each secret and n_chars of the new text; a null text stays null."""
    return secrets.mask(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2,048 tokens: place and ids of each. Every row is a document, repeated ones too."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("decontamination", decontaminated),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: Token counts and hashes of word shingles are not SQL; a brute-force version checks the stages instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = through_table(docs, scratch_folder(spark, f"stage-{k}"))
    return docs
