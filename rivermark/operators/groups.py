"""Grouped counts and summaries shared by the event and lead views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivermark.functions.numbers import mean, percent, total


def counts(df: DataFrame, *keys: str | Column, name: str = "total") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def summary(df: DataFrame, *keys: str, scale: int | None = None) -> DataFrame:
    """Count, mean, sum, first and last time per key."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("total_eventos"),
        mean("valor", scale).alias("valor_medio"),
        total("valor", scale).alias("valor_total"),
        F.min("timestamp").alias("primeira_ocorrencia"),
        F.max("timestamp").alias("ultima_ocorrencia"),
    )


def by_time(
    df: DataFrame, unit: str, *keys: str, name: str = "periodo", time: str = "timestamp"
) -> DataFrame:
    """Count per truncated time and keys."""
    return counts(df, F.date_trunc(unit, time).alias(name), *keys)


def with_empty_days(per_day: DataFrame, name: str = "periodo") -> DataFrame:
    """A daily histogram with a zero row for each day between first and last.

    Each day is followed by the empty days up to the next one, so the histogram
    is computed once. The window runs over one row per day.
    """
    day = F.expr("INTERVAL 1 DAY")
    following = F.coalesce(F.lead(name).over(Window.orderBy(name)) - day, F.col(name))
    spans = per_day.select(F.col(name).alias("_day"), "total", F.sequence(name, following, day).alias("_days"))
    filled = spans.select("_day", "total", F.explode("_days").alias(name))
    return filled.select(name, F.when(F.col(name) == F.col("_day"), F.col("total")).otherwise(F.lit(0)).alias("total"))


def breakdown(df: DataFrame, column: str, absent: str = "unknown") -> DataFrame:
    """Rows per value, null under its own label."""
    return counts(df, F.coalesce(column, F.lit(absent)).alias(column))


def terms(df: DataFrame, value: Column, n: int | None = 10) -> DataFrame:
    """The ``n`` most frequent values, rows without the value left out."""
    found = counts(df.select(value.alias("termo")).where(F.col("termo").isNotNull()), "termo")
    ranked = found.orderBy(F.desc("total"), "termo")
    return ranked if n is None else ranked.limit(n)


def share(df: DataFrame, condition: Column) -> DataFrame:
    """One row: rows that meet the condition, that do not, all, percentage."""
    met = F.count_if(condition)
    return df.agg(
        met.alias("com"),
        F.count_if(~condition).alias("sem"),
        F.count("*").alias("total"),
        percent(met, F.count("*")).alias("percentual"),
    )


def value_list(df: DataFrame, key: str, column: str, name: str) -> DataFrame:
    """The distinct values of a column per key, in order, as one text."""
    listed = f"listagg(DISTINCT {column}, ', ') WITHIN GROUP (ORDER BY {column})"
    return df.groupBy(key).agg(F.expr(listed).alias(name))


def matrix(df: DataFrame, row: str, unit: str, columns: list[str] | None = None) -> DataFrame:
    """Counts by time (rows) and the values of ``row`` (columns).

    Give the values when they are known: the pivot then needs no extra pass.
    """
    period = df.select(F.date_trunc(unit, "timestamp").alias("periodo"), row)
    return period.groupBy("periodo").pivot(row, columns).count()
