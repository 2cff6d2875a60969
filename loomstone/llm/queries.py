"""The registered queries of this package and, where SQL can express one, its DuckDB form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomstone.llm import (
    bpe_lexicon,
    edit_join,
    filter_audit,
    html_crf,
    kneser_ney,
    pii_crf,
    piece_backtracking,
    positional_index,
    robust_outliers,
    sentence_spans,
    simhash_vptree,
    source_divergence,
    url_filter,
)
from loomstone.llm.common import docs_of


def op1_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return robust_outliers.op1(spark, sf_dir)


def op2_bpe_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_lexicon.op2(spark, sf_dir)


def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.op3(spark, sf_dir)


def op4_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.op4(spark, sf_dir)


def op5_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf.op5(spark, sf_dir)


def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.op6(spark, sf_dir)


def op7_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_vptree.op7(spark, sf_dir)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(docs_of(spark, sf_dir, "pages"))


def op9_edit_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_join.op9(spark, sf_dir)


def op10_positional_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positional_index.op10(spark, sf_dir)


def op11_piece_backtracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_backtracking.op11(spark, sf_dir)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.op12(spark, sf_dir)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.op13(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_robust_outliers, op2_bpe_lexicon, op3_kneser_ney, op4_html_crf, op5_pii_crf, op6_sentence_spans, op7_simhash_vptree, op8_url_filter, op9_edit_join,
        op10_positional_decontamination, op11_piece_backtracking, op12_filter_audit, op13_source_divergence,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op8_url_filter": url_filter.ORACLE_SQL, "op10_positional_decontamination": positional_index.ORACLE_SQL, "op12_filter_audit": filter_audit.ORACLE_SQL, "op13_source_divergence": source_divergence.ORACLE_SQL}
