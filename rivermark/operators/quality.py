"""Data-quality rules: name the broken ones per row, split, count.

Rules follow the stored tables' constraints: a check passes on null, a
required field does not.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivermark import schemas
from rivermark.operators import keyed


class Rule(NamedTuple):
    name: str
    broken: Column


def required(*columns: str) -> list[Rule]:
    return [Rule(f"required_{c}", F.col(c).isNull()) for c in columns]


def in_range(column: str, low: float, high: float) -> Rule:
    inside = F.col(column).between(low, high)
    return Rule(f"range_{column}", F.coalesce(~inside, F.lit(False)))


def in_domain(column: str, values: list[str]) -> Rule:
    return Rule(f"domain_{column}", F.coalesce(~F.col(column).isin(values), F.lit(False)))


def max_lengths(limits: Mapping[str, int]) -> list[Rule]:
    return [
        Rule(f"length_{c}", F.coalesce(F.length(c) > n, F.lit(False))) for c, n in limits.items()
    ]


def in_form(column: str, pattern: str) -> Rule:
    """A text that the whole pattern has to fit."""
    return Rule(f"form_{column}", F.coalesce(~F.col(column).rlike(f"^(?:{pattern})$"), F.lit(False)))


def json_text(column: str) -> Rule:
    return Rule(f"json_{column}", F.col(column).isNotNull() & F.try_parse_json(column).isNull())


def stored_forms(kind: str) -> list[Rule]:
    """What the relational tables demand of texts that are typed there: UUIDs, addresses, JSON."""
    return {
        "leads": [in_form("id", schemas.UUID_FORM), json_text("localizacao")],
        "sessions": [
            in_form("id", schemas.UUID_FORM),
            in_form("lead_id", schemas.UUID_FORM),
            in_form("ip_address", schemas.ADDRESS_FORM),
        ],
    }[kind]


def event_rules() -> list[Rule]:
    return required(*schemas.EVENT_REQUIRED) + max_lengths(schemas.EVENT_LENGTHS)


def lead_rules() -> list[Rule]:
    return [
        *required(*schemas.LEAD_REQUIRED),
        in_range("score_qualificacao", *schemas.SCORE_RANGE),
        in_domain("status_lead", schemas.STATUS_DOMAIN),
        *max_lengths(schemas.LEAD_LENGTHS),
    ]


def session_rules() -> list[Rule]:
    return [
        *required(*schemas.SESSION_REQUIRED),
        in_domain("nivel_interesse", schemas.INTEREST_DOMAIN),
        *max_lengths(schemas.SESSION_LENGTHS),
    ]


def checked(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``violations``, the names of the rules each row breaks."""
    names = F.array(*[F.when(r.broken, F.lit(r.name)) for r in rules])
    return df.withColumn("violations", F.array_compact(names))


def clean(checked_rows: DataFrame) -> DataFrame:
    return checked_rows.where(F.size("violations") == 0).drop("violations")


def quarantined(checked_rows: DataFrame) -> DataFrame:
    return checked_rows.where(F.size("violations") > 0)


def violation_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows per broken rule, all rules in one pass without a row shuffle."""
    counts = df.agg(*[F.count_if(r.broken).alias(r.name) for r in rules])
    return counts.unpivot([], [r.name for r in rules], "regra", "linhas")


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def with_time_defaults(df: DataFrame, columns: list[str], moment: str) -> DataFrame:
    """Absent times take the value of the ``moment`` column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.col(moment)) for c in columns})


def without_parent(
    children: DataFrame, parents: DataFrame, column: str, parent_key: str = "id"
) -> DataFrame:
    """Child rows that name a parent which does not exist; null names none.

    Parents are unique by key, so a parent with very many children is split.
    """
    stated = children.where(F.col(column).isNotNull())
    return keyed.missing(stated, parents.select(F.col(parent_key).alias(column)), [column], unique=True)


def surviving(
    children: DataFrame, deleted: DataFrame, column: str, parent_key: str = "id"
) -> DataFrame:
    """Child rows left after their deleted parents took theirs along.

    Children that name no parent pass by the join; otherwise all of them would
    meet in one task.
    """
    gone = deleted.select(F.col(parent_key).alias(column))
    stated = children.where(F.col(column).isNotNull())
    left = keyed.missing(stated, gone, [column], unique=True)
    return left.unionByName(children.where(F.col(column).isNull()))
