"""Row selection by field conditions and ordered head of a table."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivermark.functions.text import any_token, phrase


def matching_fields(
    df: DataFrame,
    equal: Mapping[str, Any] | None = None,
    match: Mapping[str, str] | None = None,
    phrases: Mapping[str, str] | None = None,
    above: Mapping[str, Any] | None = None,
    at_least: Mapping[str, Any] | None = None,
    between: Mapping[str, tuple[Any, Any]] | None = None,
) -> DataFrame:
    """Rows that meet all given field conditions.

    ``equal`` compares whole values, ``match`` asks for any word of the text,
    ``phrases`` for its words in sequence, ``above`` is exclusive, ``between``
    includes both ends.
    """
    conditions: list[Column] = [F.col(c) == v for c, v in (equal or {}).items()]
    conditions += [any_token(c, v) for c, v in (match or {}).items()]
    conditions += [phrase(c, v) for c, v in (phrases or {}).items()]
    conditions += [F.col(c) > v for c, v in (above or {}).items()]
    conditions += [F.col(c) >= v for c, v in (at_least or {}).items()]
    conditions += [F.col(c).between(*v) for c, v in (between or {}).items()]
    for condition in conditions:
        df = df.where(condition)
    return df


def newest(df: DataFrame, n: int | None, by: str, tie: str = "id") -> DataFrame:
    """The ``n`` newest rows, all of them in order when ``n`` is None.

    Rows without the time come first, as a descending order puts them in the
    relational store.
    """
    ranked = df.orderBy(F.desc_nulls_first(by), tie)
    return ranked if n is None else ranked.limit(n)


def hits(df: DataFrame, n: int = 5, **conditions: Any) -> DataFrame:
    """The newest ``n`` rows that meet the conditions."""
    return newest(matching_fields(df, **conditions), n, "timestamp")
