"""Incremental transfer of table rows into the message stream or a sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rivermark.functions.times import recent
from rivermark.operators import keyed, payload

# Mark of an empty sink.
BEFORE_ALL = "0001-01-03 00:00:00"


def mark_of(sent: DataFrame, time: str) -> DataFrame:
    """One row: the newest time sent, or a time before all."""
    start = F.lit(BEFORE_ALL).cast(sent.schema[time].dataType)
    return sent.agg(F.coalesce(F.max(time), start).alias("mark"))


def store_mark(rows: DataFrame, time: str, folder: str, before: DataFrame | None = None) -> None:
    """Writes the mark after ``rows`` were sent, for the next run to start from.

    Only the rows of this run and the mark ``before`` it are read. Marks are
    appended and the greatest counts, so a repeated run does no harm.
    """
    mark = mark_of(rows, time)
    if before is not None:
        mark = mark.unionByName(before).agg(F.max("mark").alias("mark"))
    mark.write.mode("append").parquet(folder)


def stored_mark(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder).agg(F.max("mark").alias("mark"))


def pending(
    source: DataFrame,
    sent: DataFrame,
    time: str,
    keys: list[str],
    overlap_hours: int = 24,
    mark: DataFrame | None = None,
) -> DataFrame:
    """Source rows not sent yet, found from the newest time already sent.

    Re-reading ``overlap_hours`` before that mark catches rows that arrived
    late; keys sent before are left out, so overlaps do not repeat rows. Both
    sides are filtered by the mark. With a stored ``mark`` the cost follows the
    new rows; without one it is computed from everything that was sent. An empty
    sink takes everything.
    """
    if mark is None:
        mark = mark_of(sent, time)
    fresh = recent(source, time, mark, hours=overlap_hours)
    known = recent(sent, time, mark, hours=overlap_hours)
    return keyed.missing(fresh, known, keys)


def messages(rows: DataFrame, tag: str, processed_at: Column | None = None) -> DataFrame:
    """Rows as tagged JSON messages, ready for a publisher."""
    return payload.to_messages(payload.tagged(rows, tag, processed_at))


def send(rows: DataFrame, tag: str, publish: Callable[[DataFrame], None]) -> int:
    """Publishes rows as tagged messages and returns how many were sent."""
    sent = Observation("sync")
    publish(messages(rows, tag).observe(sent, F.count(F.lit(1)).alias("sent")))
    return sent.get["sent"]
