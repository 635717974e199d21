"""Event counts, means and sums in sliding time windows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivermark import schemas
from rivermark.functions.numbers import addend, mean, total


def _window_columns(stats: DataFrame) -> DataFrame:
    return stats.select(
        F.col("janela.start").alias("janela_inicio"),
        F.col("janela.end").alias("janela_fim"),
        "categoria",
        "evento",
        "total_eventos",
        "valor_medio",
        "valor_total",
    )


def sliding_stats(
    events: DataFrame,
    width: str = schemas.WINDOW,
    slide: str = schemas.SLIDE,
    scale: int | None = None,
) -> DataFrame:
    """Windowed statistics in one grouping.

    On a stream put ``withWatermark`` before it: a window then leaves once the
    watermark passes its end, and rows later than the watermark are dropped.
    """
    window: Column = F.window("timestamp", width, slide).alias("janela")
    stats = events.groupBy(window, "categoria", "evento").agg(
        F.count("*").alias("total_eventos"),
        mean("valor", scale).alias("valor_medio"),
        total("valor", scale).alias("valor_total"),
    )
    return _window_columns(stats)


def pane_width(spark: SparkSession, width: str, slide: str) -> str:
    """The longest pane both the window and its step are made of.

    Spark itself reads the intervals, so every unit of a window is known here.
    """
    zero = "TIMESTAMP '1970-01-01 00:00:00Z'"
    ends = ", ".join(f"unix_micros({zero} + INTERVAL '{t}')" for t in (width, slide))
    return f"{math.gcd(*spark.sql(f'SELECT {ends}').first())} microseconds"


def sliding_stats_by_panes(
    events: DataFrame,
    width: str = schemas.WINDOW,
    slide: str = schemas.SLIDE,
    scale: int | None = None,
) -> DataFrame:
    """The same statistics without expanding every event.

    Events are first reduced to panes no window edge cuts through; only the
    panes are copied into the windows that cover them. With the 5 minute
    window and 1 minute step the large grouping updates one group per event
    instead of five, and the second shuffle holds one row per pane at most.

    On a stream with a watermark, append mode: a pane waits in state until the watermark passes its end, and is copied
    only then; a window that the watermark passed leaves with its last pane. So the state holds panes and the windows
    across the watermark, and not every open window of every event.
    """
    pane = F.window("timestamp", pane_width(events.sparkSession, width, slide))
    if not events.isStreaming:
        pane = pane.start
    pane = pane.alias("pane")
    panes = events.groupBy(pane, "categoria", "evento").agg(
        F.count("*").alias("n"),
        F.count("valor").alias("n_valor"),
        F.sum(addend("valor", scale)).alias("soma"),
    )
    stats = panes.groupBy(
        F.window("pane", width, slide).alias("janela"), "categoria", "evento"
    ).agg(
        F.sum("n").alias("total_eventos"),
        F.try_divide(F.sum("soma").cast("double"), F.sum("n_valor")).alias("valor_medio"),
        F.sum("soma").cast("double").alias("valor_total"),
    )
    return _window_columns(stats)
