"""File sources and sinks with declared schemas."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Raw articles: times are epoch milliseconds.
ARTICLES = (
    "source_name string, title string, snippet string, body string, section string, source_code string, an string, action string, word_count long, "
    "industry_codes string, company_codes string, subject_codes string, region_codes string, publication_datetime long, ingestion_datetime long, modification_date long, language_code string"
)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ",") -> DataFrame:
    """CSV with a header; quoted fields may hold line breaks and doubled quotes, a byte-order mark is dropped. Without a
    schema all columns are strings."""
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("sep", sep)
    if schema is not None:
        return reader.schema(schema).csv(path)
    df = reader.csv(path)
    return df.toDF(*[c.lstrip("﻿").strip('"') for c in df.columns])


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None, **partition) -> DataFrame:
    """Columns and partition values reach the scan."""
    df = spark.read.parquet(path)
    for k, v in partition.items():
        df = df.filter(F.col(k) == v)
    return df.select(*columns) if columns else df


def read_avro(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Avro files as one table; needs Spark's avro module on the class path."""
    try:
        return spark.read.format("avro").load(path)
    except AnalysisException as e:
        raise RuntimeError("start the session with the package org.apache.spark:spark-avro") from e


def avro_to_csv(spark: SparkSession, path: str, out: str) -> bool:
    """False if there is nothing to convert."""
    df = read_avro(spark, path)
    if df.isEmpty():
        return False
    write_csv(df, out)
    return True


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_partitioned(df: DataFrame, path: str, by: tuple[str, ...] = ("year", "month"), rows_per_file: int = 100_000) -> None:
    """Partitioned zstd Parquet; only the partitions that ``df`` has are replaced, so a rerun is idempotent. Rows of one partition are
    brought together by AQE's rebalance, which also splits a hot one."""
    df.hint("rebalance", *[F.col(c) for c in by]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).partitionBy(*by).parquet(path)
    # a dynamic overwrite leaves no mark of its own
    spark = df.sparkSession
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True).close()


def write_parquet(df: DataFrame, path: str, single: bool = False) -> None:
    """``single`` writes one file, for small results only."""
    (df.coalesce(1) if single else df).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def safe_read_csv(spark: SparkSession, path: str, **options) -> DataFrame | None:
    """None instead of an error."""
    try:
        return read_csv(spark, path, **options)
    except AnalysisException:
        return None


def safe_write_csv(df: DataFrame, path: str, single: bool = False) -> bool:
    try:
        write_csv(df, path, single)
    except Exception:
        return False
    return True


def complete(spark: SparkSession, path: str) -> bool:
    """A stage's output is there and was finished."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def reindexed(df: DataFrame, order: list[str], out: str = "tile_id") -> DataFrame:
    """A running id over a partitioned dataset in the order of its partitions and rows."""
    from loomwork.operators.dedup import dense_ids

    return dense_ids(df, order, out)


def row_count(spark: SparkSession, path: str) -> int:
    """From Parquet footers."""
    return spark.read.parquet(path).count()


def latest_file(folder: str, pattern: str = "*") -> Path | None:
    """The file changed last, on a local disk of the driver."""
    return max((p for p in Path(folder).glob(pattern) if p.is_file()), key=lambda p: (p.stat().st_mtime, p.name), default=None)


def file_age(path: str) -> dt.timedelta:
    return dt.datetime.now() - dt.datetime.fromtimestamp(Path(path).stat().st_mtime)


def stamped(name: str, now: dt.datetime | None = None) -> str:
    """``name`` with date and time before its suffix."""
    p = Path(name)
    return str(p.with_name(f"{p.stem}_{(now or dt.datetime.now()):%Y-%m-%d_%H-%M-%S}{p.suffix}"))


def ensure_folder(path: str) -> Path:
    p = Path(path)
    p.mkdir(parents=True, exist_ok=True)
    return p
