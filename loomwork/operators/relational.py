"""Projections, joins and batches with the checks that Spark's own methods leave out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.operators.dedup import dense_ids


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly these columns in this order; a missing one is an error."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*columns)


def drop_columns(df: DataFrame, columns: list[str], suffix: str | None = None) -> DataFrame:
    """Without these columns and all that end in ``suffix``; a missing one is an error."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    return df.drop(*columns, *[c for c in df.columns if suffix and c.endswith(suffix)])


def drop_except(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in set(columns)])


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def epoch_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Epoch milliseconds as timestamps; columns that are no numbers, or not there, stay as they are."""
    kinds = dict(df.dtypes)
    ok = [c for c in columns if kinds.get(c) in ("bigint", "int", "double")]
    return df.withColumns({c: F.timestamp_millis(F.col(c).cast("long")) for c in ok})


def date_parts(df: DataFrame, column: str, out: str = "pub_date") -> DataFrame:
    return df.withColumns({out: F.col(column), "year": F.year(column), "month": F.month(column)})


def fill_from(df: DataFrame, column: str, other: str) -> DataFrame:
    """Nulls taken from another column."""
    return df.withColumn(column, F.coalesce(column, other))


def fill(df: DataFrame, columns: list[str], value: str = "") -> DataFrame:
    return df.fillna(value, columns)


def left_results(df: DataFrame, results: DataFrame, key: str, suffixes: tuple[str, str] = ("", "_new")) -> DataFrame:
    """All rows of ``df`` with the results of their key; columns that both have get the suffixes."""
    both = [c for c in df.columns if c in results.columns and c != key]
    left = df.withColumnsRenamed({c: c + suffixes[0] for c in both})
    return left.join(results.withColumnsRenamed({c: c + suffixes[1] for c in both}), key, "left")


def inner_results(df: DataFrame, results: DataFrame, key: str, suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    both = [c for c in df.columns if c in results.columns and c != key]
    return df.withColumnsRenamed({c: c + suffixes[0] for c in both}).join(results.withColumnsRenamed({c: c + suffixes[1] for c in both}), key)


def positional(df: DataFrame, results: DataFrame, order: list[str], results_order: list[str]) -> DataFrame:
    """All rows of ``df`` with the result of the same position: rows have none in Spark, so each table names the columns that order it."""
    if not order or not results_order:
        raise ValueError("a join by position needs the columns that order both tables")
    left, right = dense_ids(df, order, "__pos"), dense_ids(results, results_order, "__pos")
    both = [c for c in results.columns if c in df.columns]
    return left.join(right.drop(*both), "__pos", "left").drop("__pos")


def in_both(df: DataFrame, other: DataFrame, key: str, keep: bool = True) -> DataFrame:
    return df.join(other.select(key), key, "left_semi" if keep else "left_anti")


def batches(df: DataFrame, row_id: str, size: int) -> DataFrame:
    """The number of the batch of ``size`` consecutive dense ids."""
    return df.withColumn("batch", F.floor(F.col(row_id) / size))


def records(df: DataFrame, columns: dict[str, str], constants: dict[str, str] | None = None, out: str = "record") -> DataFrame:
    """A struct column of renamed columns and constants: the input of a model call."""
    fields = [F.col(a).alias(b) for a, b in columns.items()] + [F.lit(v).alias(k) for k, v in (constants or {}).items()]
    return df.withColumn(out, F.struct(*fields))


def explain_count(df: DataFrame, condition, order: str, n: int = 5) -> tuple[DataFrame, DataFrame]:
    """Count of the rows that match, and the first n of them: what a query would return, before it is run."""
    got = df.filter(condition)
    return got.agg(F.count("*").alias("n")), got.orderBy(order).limit(n)
