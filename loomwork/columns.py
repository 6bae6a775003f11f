"""Columns by their exact names: a dot or a backtick in a name is part of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def cols(df: DataFrame) -> list[Column]:
    """All columns of ``df``, as they are."""
    return [col(c) for c in df.columns]


def kind(df: DataFrame, name: str):
    """The type of a column."""
    return df.schema[name].dataType
