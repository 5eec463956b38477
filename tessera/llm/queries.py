"""Registered queries of the corpus operators; the oracle statements are DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontam, fingerprints, langid, licenses, neardup, packing, ppm, quality, runs, sharding, spelling, substring, toxicity
from tessera.llm.common import documents


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(documents(spark, sf_dir))


def op2_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_documents(documents(spark, sf_dir))


def op3_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir))


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_path())


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(documents(spark, sf_dir))


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_documents(documents(spark, sf_dir))


def op10_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(documents(spark, sf_dir))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_words(documents(spark, sf_dir))


QUERIES = {
    "op1_substring": op1_substring,
    "op2_ppm": op2_ppm,
    "op3_shard": op3_shard,
    "op4_pack": op4_pack,
    "op5_toxicity": op5_toxicity,
    "op6_licenses": op6_licenses,
    "op7_quality": op7_quality,
    "op8_neardup": op8_neardup,
    "op9_langid": op9_langid,
    "op10_decontam": op10_decontam,
    "op11_fingerprints": op11_fingerprints,
    "op12_runs": op12_runs,
    "op13_spelling": op13_spelling,
}
ORACLE: dict[str, str] = {"op6_licenses": licenses.oracle()}
