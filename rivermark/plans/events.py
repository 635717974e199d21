"""Reports over event rows. Each is a function of frames, batch or view alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivermark.functions.numbers import mean, total
from rivermark.functions.text import json_field
from rivermark.functions.times import AsOf, interval, recent
from rivermark.operators import groups, search

RECENT_COLUMNS = ["id", "usuario", "evento", "valor", "categoria"]


def _ordered(df: DataFrame, ordered: bool, *order: str | Column) -> DataFrame:
    return df.orderBy(*order) if ordered else df


def last_day_summary(
    events: DataFrame, as_of: AsOf = None, hours: int = 24, scale: int | None = None, ordered: bool = True
) -> DataFrame:
    """Statistics per category and event of the last 24 hours, largest first."""
    stats = groups.summary(
        recent(events, "timestamp", as_of, hours=hours), "categoria", "evento", scale=scale
    )
    return _ordered(stats, ordered, F.desc("total_eventos"), "categoria", "evento")


def hourly_by_category(
    events: DataFrame, as_of: AsOf = None, days: int = 7, scale: int | None = None, ordered: bool = True
) -> DataFrame:
    """Count and mean per hour and category of the last 7 days, newest first."""
    hour = F.date_trunc("hour", "timestamp").cast(events.schema["timestamp"].dataType)
    stats = (
        recent(events, "timestamp", as_of, days=days)
        .groupBy(hour.alias("hora"), "categoria")
        .agg(F.count("*").alias("total_eventos"), mean("valor", scale).alias("valor_medio"))
    )
    return _ordered(stats, ordered, F.desc("hora"), "categoria")


def by_category(events: DataFrame, ordered: bool = True) -> DataFrame:
    return _ordered(groups.counts(events, "categoria"), ordered, F.desc("total"), "categoria")


def recent_by_category(events: DataFrame, as_of: AsOf = None, hours: int = 24) -> DataFrame:
    return groups.counts(recent(events, "timestamp", as_of, hours=hours), "categoria")


def top_users(events: DataFrame, n: int = 10, scale: int | None = None) -> DataFrame:
    """Users with the greatest summed value; users without any value come first."""
    per_user = events.groupBy("usuario").agg(
        total("valor", scale).alias("total_valor"), F.count("*").alias("eventos")
    )
    return per_user.orderBy(F.desc_nulls_first("total_valor"), "usuario").limit(n)


def newest_events(
    events: DataFrame, n: int = 5, category: str | None = None, by: str = "timestamp"
) -> DataFrame:
    chosen = events if category is None else events.where(F.col("categoria") == category)
    return search.newest(chosen, n, by)


def last_event_of(stored: DataFrame, user: str) -> DataFrame:
    """The event of a user that was processed last."""
    rows = stored.where(F.col("usuario") == user)
    return search.newest(rows, 1, "processado_em").select(*RECENT_COLUMNS)


def valued_events(events: DataFrame, category: str, at_least: float, ordered: bool = True) -> DataFrame:
    """Events of one category from a value on, newest first."""
    rows = events.where((F.col("categoria") == category) & (F.col("valor") >= at_least)).select(
        "usuario", "evento", F.col("valor").alias("score"), "timestamp"
    )
    return _ordered(rows, ordered, F.desc("timestamp"), "usuario")


def by_metadata(events: DataFrame, field: str, scale: int | None = None) -> DataFrame:
    """Count and mean per value of a JSON field."""
    value = json_field("metadata", field).alias("status")
    return events.groupBy(value).agg(
        F.count("*").alias("total"), mean("valor", scale).alias("score_medio")
    )


def metadata_terms(events: DataFrame, field: str, n: int | None = 10) -> DataFrame:
    return groups.terms(events, json_field("metadata", field), n)


def daily_histogram(events: DataFrame, fill: bool = False) -> DataFrame:
    per_day = groups.by_time(events, "day")
    return groups.with_empty_days(per_day) if fill else per_day


def category_by_hour(events: DataFrame) -> DataFrame:
    """Long form of the category and hour matrix."""
    return groups.by_time(events, "hour", "categoria")


def count_on_day(events: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Number of events on the day of ``as_of``."""
    kind = events.schema["timestamp"].dataType

    def midnight(days_later: int) -> Column:
        def shifted(moment: Column) -> Column:
            return (F.date_trunc("day", moment) + interval(days=days_later)).cast(kind)

        if isinstance(as_of, DataFrame):
            return as_of.select(shifted(F.col(as_of.columns[0])).alias("midnight")).scalar()
        return shifted(F.current_timestamp() if as_of is None else F.lit(as_of))

    time = F.col("timestamp")
    day = events.where((time >= midnight(0)) & (time < midnight(1)))
    return day.agg(F.count("*").alias("total"))
