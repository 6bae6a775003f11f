"""The stages of news curation, each a function of DataFrames; files are the hand-off, as Spark recomputes what is lost."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions.codes import code_union, decode_ordered
from loomwork.functions.predicates import flag, in_region
from loomwork.functions.segment import tile_texts
from loomwork.functions.text import boilerplate_lines, cleaned
from loomwork.operators.dedup import cascade
from loomwork.operators.model_map import ASSESSMENT, EXTRACTION, Limits, map_resumable, map_rows
from loomwork.operators.relational import date_parts, epoch_columns
from loomwork.operators.semantic import semantic_dedup
from loomwork.operators.summary import head, sample_n, summarise
from loomwork.sources.files import complete, write_partitioned


def preprocess(articles: DataFrame, sample: int | None = None) -> DataFrame:
    """Times and codes in order, boilerplate lines dropped, text cleaned: column body_cleaned. The lines are an aggregate of the corpus, all
    of the share, and no more than (mean lines of a document) / share; they are collected before the clean-up of each document."""
    df = sample_n(articles, sample, "an") if sample else articles
    df = date_parts(epoch_columns(df, ["publication_datetime", "ingestion_datetime", "modification_date"]), "publication_datetime")
    df = df.withColumn("company_codes", code_union(*[c for c in df.columns if c == "company_codes" or c.startswith("company_codes_")]))
    lines = [r.line for r in boilerplate_lines(df, "body", top=None).collect()]
    return cleaned(df, "body", "body_cleaned", lines)


def segment(df: DataFrame, **params) -> DataFrame:
    return tile_texts(df, "body_cleaned", "an", **params)


def unique_segments(segments: DataFrame, **params) -> DataFrame:
    return segments.join(cascade(segments, "segment_id", "segment", **params), "segment_id", "left_semi")


def unique_meanings(segments: DataFrame, vectors: DataFrame, threshold: float = 0.95, **params) -> DataFrame:
    """``vectors``: segment_id, embedding."""
    keep = semantic_dedup(segments.join(vectors, "segment_id"), "segment_id", "segment", "embedding", threshold, **params)
    return segments.join(keep.select("segment_id"), "segment_id", "left_semi")


def to_classify(segments: DataFrame, kept: DataFrame, names: DataFrame) -> DataFrame:
    """Kept segments of the region, with company names."""
    df = segments.join(kept.select("segment_id"), "segment_id", "left_semi").filter(in_region("region_codes"))
    return decode_ordered(df, "company_codes", names, "company_names", "segment_id")


def classify(rows: DataFrame, make_client: Callable, limits: Limits = Limits(), path: str | None = None, limit_rows: int | None = None, key: str = "segment_id") -> DataFrame:
    """Rows with the assessment of a model, in a left join by key: rows that failed have nulls."""
    rows = head(rows, limit_rows, key) if limit_rows else rows
    run = (lambda: map_resumable(rows, path, make_client, ASSESSMENT, key, limits=limits)) if path else (lambda: map_rows(rows, make_client, ASSESSMENT, key, limits=limits))
    return rows.join(run().drop("error"), key, "left")


SETS = {"potential_disposal": (4, None), "disposal": (4, None), "disposal_company": (4, None), "disposal_country": (4, None), "rationale": (4, None), "source_name": (4, None), "title": (4, None), "article_quote": (4, None), "segment": (4, 2500)}


def finalise(classified: DataFrame, make_client: Callable, limits: Limits = Limits(), limit_rows: int | None = None, key: str = "segment_id") -> DataFrame:
    """One row a target: relevant hits go through the second model pass and are summarised."""
    hits = classified.filter(flag("is_about") & flag("is_relevant"))
    hits = head(hits, limit_rows, key) if limit_rows else hits
    found = map_rows(hits, make_client, EXTRACTION, key, limits=limits).filter(flag("relevant")).drop("status", "attempts", "error")
    full = hits.select(*[c for c in (key, "source_name", "title", "segment", "stage", "modification_date") if c in hits.columns]).join(found, key)
    return summarise(full, "target", key, modes=["group", "group_hq", "vertical", "disposal_sector", "stage"], sets=SETS, mins=["modification_date"], means=["interest_score"])


def run_stages(spark: SparkSession, stages: list[tuple[str, Callable[[], DataFrame]]], folder: str, by: dict[str, tuple[str, ...]] | None = None) -> dict[str, str]:
    """Write each stage's table under ``folder`` unless it is there and complete; returns the paths."""
    out = {}
    for name, make in stages:
        path = f"{folder}/{name}"
        if not complete(spark, path):
            if by and name in by:
                write_partitioned(make(), path, by[name])
            else:
                make().write.mode("overwrite").parquet(path)
        out[name] = path
    return out
