"""Comma-joined code lists: union, and decoding by a dimension table or a small map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def code_union(*columns: str) -> Column:
    """Sorted distinct codes of several comma-joined columns, joined again; null columns add nothing."""
    return F.array_join(F.array_sort(F.array_distinct(F.filter(F.split(F.concat_ws(",", *[F.col(c) for c in columns]), ","), lambda x: x != ""))), ",")


def dimension(names: DataFrame, code: str, name: str) -> DataFrame:
    """code (lower case), name: the least name of each code, as a code may be listed twice."""
    return names.select(F.lower(code).alias("code"), F.col(name).alias("name")).filter("code is not null").groupBy("code").agg(F.min("name").alias("name"))


def first_listed(names: DataFrame, code: str, order: str) -> DataFrame:
    """The first row of each code in the order of ``order``."""
    return names.groupBy(code).agg(F.min_by(F.struct(*names.columns), order).alias("r")).select("r.*")


def decode_ordered(df: DataFrame, codes: str, names: DataFrame, out: str, row_id: str, upper: bool = False) -> DataFrame:
    """Names for a comma-joined list in its order and with its repetitions; the lookup is as the code is written (or
    in upper case), and a code without a name stands for itself. A null list stays null. ``row_id`` is unique.

    Only ids and codes are exploded and shuffled; the planner broadcasts the dimension while it is small."""
    key = F.upper("c") if upper else F.col("c")
    parts = df.select(row_id, F.posexplode(F.split(F.col(codes), ",")).alias("pos", "c")).withColumn("k", key)
    named = parts.join(names.select(F.col("code").alias("k"), "name"), "k", "left")
    lists = named.groupBy(row_id).agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("name", "c").alias("n")))).alias("l"))
    return df.join(lists.select(row_id, F.array_join(F.col("l.n"), ",").alias(out)), row_id, "left")


def decode_sorted(df: DataFrame, codes: str, names: DataFrame, out: str, row_id: str) -> DataFrame:
    """Names for the distinct codes of a list in the order of the codes, stripped and in lower case; a null list gives ''."""
    parts = df.select(row_id, F.explode(F.split(F.col(codes), ",")).alias("c")).select(row_id, F.lower(F.trim("c")).alias("code")).filter("code <> ''").distinct()
    named = parts.join(names.select("code", "name"), "code", "left")
    lists = named.groupBy(row_id).agg(F.array_sort(F.collect_list(F.struct("code", F.coalesce("name", "code").alias("n")))).alias("l"))
    joined = df.join(lists.select(row_id, F.array_join(F.col("l.n"), ",").alias(out)), row_id, "left")
    return joined.withColumn(out, F.coalesce(out, F.lit("")))


def decode_scalar(df: DataFrame, code: str, names: DataFrame, out: str) -> DataFrame:
    """The name of one code, looked up in lower case; the code itself where it has none."""
    joined = df.withColumn("__k", F.lower(code)).join(names.select(F.col("code").alias("__k"), F.col("name").alias("__n")), "__k", "left")
    return joined.withColumn(out, F.coalesce("__n", code)).drop("__k", "__n")


def first_containing(terms: DataFrame, term: str, names: DataFrame, code: str, description: str, order: str) -> DataFrame:
    """term, code: the first code (by ``order``) whose description contains the term. Both tables are dimensions."""
    pairs = terms.select(F.col(term).alias("term")).distinct().join(names, F.col(description).contains(F.col("term")))
    return pairs.groupBy("term").agg(F.min_by(code, order).alias("code"))
