"""The queries of this subpackage: name -> (function of session and folder, SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomwork.llm import classifier, embeddings, langid, minhash, mixing, packing, pii, rules, sharding, warc
from loomwork.llm.settings import MIX, PII_KEY


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op5_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf, "documents"))


def op8_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return langid.identify(_table(spark, sf, "documents"))


def op2_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(_table(spark, sf, "documents"))


def op4_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(_table(spark, sf, "documents"), **MIX, epoch="epoch")


def op6_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.pseudonymise(_table(spark, sf, "documents"), PII_KEY)


def op1_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return rules.repetition(_table(spark, sf, "documents"))


def op3_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return classifier.classify(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op7_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard(_table(spark, sf, "documents"))


def op9_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return embeddings.near_embeddings(_table(spark, sf, "embeddings"))


def op10_warc(spark: SparkSession, sf: str) -> DataFrame:
    """The archive of all pages and, for every tenth, a spoilt twin of its record, so that every status occurs."""
    return warc.pages_of(warc.archived(_table(spark, sf, "pages"), damaged=True)).select("page_id", "url", "status", "html")


_OWN = (op1_quality_rules, op2_packing, op3_quality_classifier, op4_mixing, op5_minhash, op6_pii, op7_sharding, op8_language_id, op9_embedding_dedup, op10_warc)
QUERIES = {f.__name__: f for f in _OWN}
SQL: dict[str, str] = {
    "op1_quality_rules": rules.repetition_sql(),
    "op4_mixing": mixing.mix_sql(**MIX),
    "op10_warc": warc.pages_sql(),
}
