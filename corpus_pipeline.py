"""The corpus pipeline: documents to packed training bins, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the next reads it as written Parquet.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.llm import langid, minhash, mixing, packing, pii
from loomwork.llm.settings import MIX, PII_KEY
from loomwork.session import ship
from loomwork.workspace import Workspace


def _stage(f: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    @functools.wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return f(ship(spark), docs, sf_dir)

    return run


@_stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those that are rejected go, among them null, empty and letterless texts. Languages are learned from the
    column ``lang``: where no label has five texts nothing is known and every document goes. Repeated rows are judged alike."""
    return langid.keep_identified(docs)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the least by id (null ids last), then by hash of the text; of repeated rows one. Texts
    without words are no duplicates of each other."""
    return minhash.drop_near_duplicates(docs)


@_stage
def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced; ``n_chars`` follows the text, where there is such a column. Every row stays; null and empty texts as they are."""
    out = pii.replaced(docs, PII_KEY).drop("__lw_n")
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


@_stage
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources have them: not at all, once or up to the greatest number of epochs. A null
    source is a source; repeated rows are drawn alike."""
    return mixing.mix(docs, **MIX)


@_stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of documents, by id, start and length. Every row is an item; texts without words are in no bin."""
    return packing.pack(docs)


STAGES = [
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("PII", surrogates),
    ("mixing", mixture),
    ("best-fit packing", packed),
]

#: Hashed sketches, learned centroids and packing have no SQL; tests/llm compares the pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        held, docs = docs, ws.save(stage(spark, docs, sf_dir))
        if i:
            ws.drop(held)
    return docs
