"""One query for each operator, over its whole table, and the oracle SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paddock.llm import (
    bpe, dac, decontaminate, html_text, minhash, nearest, periods, pii, secrets, simhash, toxicity, url_filter, whitening,
)
from paddock.llm.common import table

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


@_query("op5_bpe_round_trip")
def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


@_query("op9_token_ids")
def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dac.written_and_read(table(spark, sf_dir, "documents"))


@_query("op1_personal_data")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


@_query("op2_url_filter", url_filter.SQL)
def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


@_query("op3_simhash")
def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@_query("op4_secrets")
def secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(table(spark, sf_dir, "documents"))


@_query("op6_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op7_nearest", nearest.SQL)
def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(table(spark, sf_dir, "embeddings"))


@_query("op8_main_text")
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@_query("op10_contaminated")
def contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op13_whitening")
def whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@_query("op12_periodic_runs")
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.summary(periods.find(periods.planted(table(spark, sf_dir, "documents"))))


@_query("op11_fingerprints")
def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprints(table(spark, sf_dir, "documents"))
