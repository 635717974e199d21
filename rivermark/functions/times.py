"""Time expressions: cut-offs, differences, buckets, ISO text."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text form of times on the wire, microseconds kept.
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

AsOf = datetime | DataFrame | None


def interval(hours: int = 0, days: int = 0, minutes: int = 0) -> Column:
    return F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(minutes), F.lit(0))


def cutoff(df: DataFrame, column: str, as_of: AsOf = None, **span: int) -> Column:
    """``as_of`` minus the span, in the type of ``column``.

    ``as_of`` is the clock by default, a datetime, or a frame of one row and
    one column. The frame becomes a scalar subquery that already contains the
    subtraction: a bare ``column >= (subquery)`` is what Spark can turn into a
    Parquet filter once the subquery has run.
    """
    kind = df.schema[column].dataType
    if isinstance(as_of, DataFrame):
        moment = F.col(as_of.columns[0])
        return as_of.select((moment.cast(kind) - interval(**span)).alias("cutoff")).scalar()
    if as_of is not None:
        moment = F.lit(as_of)
    elif isinstance(kind, T.TimestampNTZType):
        moment = F.localtimestamp()
    else:
        moment = F.current_timestamp()
    return moment.cast(kind) - interval(**span)


def recent(df: DataFrame, column: str, as_of: AsOf = None, **span: int) -> DataFrame:
    """Rows whose ``column`` lies in the last ``span`` before ``as_of``."""
    return df.where(F.col(column) >= cutoff(df, column, as_of, **span))


def latest_time(df: DataFrame, column: str) -> DataFrame:
    """One-row frame with the newest time, usable as ``as_of``."""
    return df.agg(F.max(column).alias("as_of"))


def fractional_days(end: Column, start: Column) -> Column:
    """Days from start to end with their fraction (datediff would truncate)."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(1e6) / F.lit(86400)


def iso_text(column: str | Column) -> Column:
    return F.date_format(column, ISO_MICROS)


def parse_iso(column: str | Column, zone: str | None = None) -> Column:
    """ISO-8601 text to timestamp, null when it does not parse.

    ``zone`` names the producer's zone for text without an offset. Text that
    states its own after a time ("Z", "+03", "+0300" or "+03:00") is left as
    it is. The session's zone does not matter then.
    """
    text = F.col(column) if isinstance(column, str) else column
    parsed = F.try_to_timestamp(text)
    if zone is None:
        return parsed
    stated = text.rlike(r":\d{2}(\.\d*)?\s*(Z|[+-]\d{2}(:?\d{2})?)$")
    written = parsed.cast("timestamp_ntz")  # the fields of the text, whatever the session's zone is
    there = F.convert_timezone(F.lit(zone), F.current_timezone(), written).cast("timestamp")
    return F.when(stated, parsed).otherwise(there)
