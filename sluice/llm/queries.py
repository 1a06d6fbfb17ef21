"""The registered queries of the operators and of the pipeline, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from sluice.llm import (
    chat, collocations, decontaminate, lines, neardup, packing, periodic, quality, secrets, shards, tokenfiles, toxicity, urls,
)

Query = Callable[[SparkSession, str], DataFrame]


def _over(contract: Callable[..., DataFrame], *tables: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return contract(*(spark.read.parquet(f"{folder}/{t}.parquet") for t in tables))

    return query


def queries() -> dict[str, Query]:
    return {
        "op1_toxicity": _over(toxicity.contract, "documents", "labels"),
        "op2_quality": _over(quality.contract, "documents"),
        "op3_packing": _over(packing.contract, "documents"),
        "op4_decontaminate": _over(decontaminate.contract, "documents", "benchmark"),
        "op5_token_files": _over(tokenfiles.contract, "documents"),
        "op6_url_filter": _over(urls.contract, "pages"),
        "op7_chat": _over(chat.contract, "conversations"),
        "op8_near_duplicates": _over(neardup.contract, "documents"),
        "op9_shards": _over(shards.contract, "documents"),
        "op10_secrets": _over(secrets.contract, "documents"),
        "op11_line_dedup": _over(lines.contract, "documents"),
        "op12_collocations": _over(collocations.contract, "documents"),
        "op13_periodic_runs": _over(periodic.contract, "documents"),
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_decontaminate": decontaminate.ORACLE,
        "op6_url_filter": urls.ORACLE,
        "op7_chat": chat.ORACLE,
        "op8_near_duplicates": neardup.ORACLE,
        "op10_secrets": secrets.ORACLE,
        "op11_line_dedup": lines.ORACLE,
        "op12_collocations": collocations.ORACLE,
    }
