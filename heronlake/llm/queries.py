"""The corpus queries of the driver contract: opN_<name> over whole tables."""

from __future__ import annotations

import importlib.util
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file; HERONLAKE_TOKENIZERS names another folder than the installed package's."""
    folder = os.environ.get("HERONLAKE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    if importlib.util.find_spec("public_tokenizers"):
        import public_tokenizers

        return public_tokenizers.path(name)
    return os.path.join("/opt/tokenizers", name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heronlake.llm import sentencepiece_wfst

    return sentencepiece_wfst.encode(_table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heronlake.llm import packing

    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heronlake.llm import quality

    return quality.measure(_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heronlake.llm import langid

    return langid.identify(_table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heronlake.llm import licenses

    return licenses.label_documents(_table(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heronlake.llm import html_extract

    return html_extract.extract_pages(_table(spark, sf_dir, "pages"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heronlake.llm import simhash

    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heronlake.llm import urlfilter

    return urlfilter.judge(_table(spark, sf_dir, "pages"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heronlake.llm import multiindex

    return multiindex.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from heronlake.llm import warc

    return warc.round_trip(_table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    own = (
        op1_sentencepiece, op2_best_fit_packing, op3_quality_rules, op4_language_id, op5_license_scan,
        op6_html_extraction, op7_simhash, op8_url_filter, op9_embedding_near_dedup, op10_warc,
    )
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline
    from heronlake.llm import quality, urlfilter, warc

    return {"op3_quality_rules": quality.MEASURE_SQL, "op8_url_filter": urlfilter.JUDGE_SQL, "op10_warc": warc.ROUND_TRIP_SQL} | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
