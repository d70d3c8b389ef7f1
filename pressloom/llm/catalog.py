"""The registered queries of the pipeline operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pressloom.llm import chunked_bpe, decontaminate, length_histogram, licenses, main_text, packing, personal_data, quality_classifier, quality_rules, ranked_search, simhash, vector_codes, warc
from pressloom.llm.common import table


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


def op4_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunked_bpe.report(table(spark, sf_dir, "documents"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.report(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram.report(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.report(table(spark, sf_dir, "pages"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.report(table(spark, sf_dir, "embeddings"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_derivatives": op1_warc_derivatives,
    "op2_license_scan": op2_license_scan,
    "op3_simhash": op3_simhash,
    "op4_chunked_bpe": op4_chunked_bpe,
    "op5_personal_data": op5_personal_data,
    "op6_quality_rules": op6_quality_rules,
    "op7_length_histogram": op7_length_histogram,
    "op8_decontaminate": op8_decontaminate,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_main_text": op10_main_text,
    "op11_vector_codes": op11_vector_codes,
    "op12_ranked_search": op12_ranked_search,
    "op13_best_fit_packing": op13_best_fit_packing,
}

SQL: dict[str, str] = {
    "op2_license_scan": licenses.sql(),
    "op8_decontaminate": decontaminate.SQL,
    "op11_vector_codes": vector_codes.SQL,
    "op12_ranked_search": ranked_search.SQL,
}
