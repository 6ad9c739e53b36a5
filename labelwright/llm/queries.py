"""The registered queries of this subpackage; each holds its operator against whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from labelwright.llm import oracles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op5_line_frequency": oracles.LINE_FREQUENCY,
    "op10_decontaminate": oracles.DECONTAMINATE,
    "op12_collocations": oracles.COLLOCATIONS,
}


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelwright.llm import decontaminate

    return decontaminate.hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from labelwright.llm import pieces

    return pieces.token_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op5_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelwright.llm import line_quality

    return line_quality.line_quality(_table(spark, sf_dir, "documents"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelwright.llm import language_id

    return language_id.identify(_table(spark, sf_dir, "documents"))


@query
def op4_site_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelwright.llm import site_template

    return site_template.main_text(_table(spark, sf_dir, "pages"))


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelwright.llm import randomness

    return randomness.secrets(_table(spark, sf_dir, "documents"))


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelwright.llm import suffix_dedup

    found = suffix_dedup.without_repeats(_table(spark, sf_dir, "documents"))
    # What is left, as text; a character that a cut goes through is replaced.
    return found.withColumn("text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept")


@query
def op7_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelwright.llm import sanitise

    return sanitise.personal_data(_table(spark, sf_dir, "documents"))


@query
def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelwright.llm import order_minhash

    return order_minhash.near_duplicates(_table(spark, sf_dir, "documents"))


@query
def op8_line_edit_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelwright.llm import line_edit_join

    return line_edit_join.near_equal_lines(_table(spark, sf_dir, "documents"), shorter=True)


@query
def op11_byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelwright.llm import byte_network

    return byte_network.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelwright.llm import collocations

    return collocations.collocations(_table(spark, sf_dir, "documents"))


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelwright.llm import spelling

    return spelling.variants(_table(spark, sf_dir, "documents"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
