"""Composable filters: keywords, ordered proximity, code sets, dates and flags, as ``Column`` expressions.

Predicates combine with ``all_of``, ``any_of`` and ``~``, so precedence never depends on concatenated strings.
"""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_of(*conditions: Column) -> Column:
    return functools.reduce(operator.and_, conditions, F.lit(True))


def any_of(*conditions: Column) -> Column:
    return functools.reduce(operator.or_, conditions, F.lit(False))


def java_quote(term: str) -> str:
    """A regular expression that matches the term itself."""
    return re.sub(r"([\\^$.|?*+()\[\]{}\-&#~])", r"\\\1", term)


def has_keyword(column: str, terms: Iterable[str], ignore_case: bool = False) -> Column:
    """Any of the terms occurs. One alternation is tried in one pass, however many terms there are."""
    terms = list(terms)
    if not terms:
        return F.lit(False)
    if len(terms) == 1 and not ignore_case:
        return F.coalesce(F.col(column).contains(terms[0]), F.lit(False))
    pattern = ("(?iu)" if ignore_case else "") + "(?:" + "|".join(map(java_quote, terms)) + ")"
    return F.coalesce(F.col(column).rlike(pattern), F.lit(False))


def _before(column: str, first: list[str], second: list[str]) -> Column:
    """Where the earliest end of a first term is, a second term starts there or later: linear in the text, whatever it repeats."""
    if not first or not second:
        return F.lit(False)
    at = [F.instr(F.col(column), t) for t in first]
    ends = [F.when(x > 0, x + len(t)) for x, t in zip(at, first)]
    start = F.least(*ends) if len(ends) > 1 else ends[0]
    return F.coalesce(any_of(*[F.call_function("locate", F.lit(t), F.col(column), start) > 0 for t in second]), F.lit(False))


def has_near(column: str, first: Iterable[str], second: Iterable[str], both_ways: bool = True) -> Column:
    """A term of one list occurs before a term of the other (anywhere after it), in either order if ``both_ways``."""
    a, b = list(first), list(second)
    return _before(column, a, b) | _before(column, b, a) if both_ways else _before(column, a, b)


def code_set(column: str) -> Column:
    """The codes of a comma-joined string: outer commas stripped; null becomes an empty list."""
    return F.coalesce(F.split(F.regexp_replace(F.col(column), "^,+|,+$", ""), ","), F.array().cast("array<string>"))


def has_code(column: str, codes: Iterable[str]) -> Column:
    """Any code of the comma-joined column is one of ``codes`` (a null or empty column has none)."""
    wanted = F.array(*[F.lit(c) for c in codes]) if codes else F.array().cast("array<string>")
    return F.coalesce(F.arrays_overlap(code_set(column), wanted), F.lit(False))


def is_in(column: str, values: Iterable) -> Column:
    return F.coalesce(F.col(column).isin(list(values)), F.lit(False))


def on_list(df: DataFrame, column: str, members: DataFrame, member: str, keep: bool = True) -> DataFrame:
    """Rows whose value is (or is not) on a named list kept as a table."""
    one = members.select(F.col(member).alias(column)).distinct()
    return df.join(one, column, "left_semi" if keep else "left_anti")


def between(column: str, low=None, high=None) -> Column:
    """low <= value <= high, either end open; null is outside."""
    parts = ([F.col(column) >= F.lit(low)] if low is not None else []) + ([F.col(column) <= F.lit(high)] if high is not None else [])
    return F.coalesce(all_of(*parts), F.lit(False)) if parts else F.col(column).isNotNull()


def flag(column: str) -> Column:
    """A nullable flag as a plain one: null is false."""
    return F.coalesce(F.col(column).cast("boolean"), F.lit(False))


def tolerant_flag(column: str) -> Column:
    """True, "true", "True" and 1 are true; everything else, null included, is false."""
    return F.when(F.lower(F.col(column).cast("string")).isin("true", "1"), True).otherwise(False)


#: Lower-case codes of the countries, capitals and regions of the European market filter.
EUROPE = tuple(
    "amstr aust belg berlin bern brus copen czrep den derry dublin eeurz estnia eurz fin fra gfr helsnk icel ire "
    "italy lario latv lith lux luxci madrd malta neth norw oslo paris pol prague reyk riga rome stock swed switz "
    "tallin uk valle vien vilniu wasw weurz".split()
)


def in_region(column: str, allowed: Iterable[str] = EUROPE) -> Column:
    return has_code(column, list(allowed))
