"""JSON messages: decode, detect the kind, parse, tag, and write back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivermark import schemas
from rivermark.functions.times import ISO_MICROS, parse_iso

# Null fields are written out, times keep their microseconds.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": ISO_MICROS,
    "timestampNTZFormat": ISO_MICROS,
}


def decode(messages: DataFrame, value: str = "value") -> DataFrame:
    """Message bytes as text in ``json_data``."""
    return messages.select(F.col(value).cast("string").alias("json_data"))


def detect(texts: DataFrame, raw: str = "json_data") -> DataFrame:
    """Adds ``tipo_evento``, the kind a message states, null when it states none.

    Reads one field only, so routing can filter before the full parse.
    """
    return texts.select("*", _fields(raw, "tipo_evento string"))


def parse(
    texts: DataFrame,
    schema: str,
    raw: str = "json_data",
    keep_raw: bool = False,
    zone: str | None = None,
) -> DataFrame:
    """Fields of the JSON text as columns; unknown keys are ignored.

    ``zone`` is the producers' zone, for times without an offset; by default
    they are read in the session's zone.
    """
    kept = [raw] if keep_raw else []
    return texts.select(_fields(raw, schema, zone), *kept)


def _fields(raw: str, schema: str, zone: str | None = None) -> Column:
    """The record's fields as columns, one row per text.

    As a generator and not ``select("record.*")``: a filter on a parsed field
    would be pushed below that projection with a copy of from_json for every
    field it reads, and the text parsed as often.
    """
    options = {} if zone is None else {"timeZone": zone}
    return F.inline(F.array(F.from_json(raw, schema, options)))


def settled(df: DataFrame) -> DataFrame:
    """The same rows, each computed once: a later filter on a computed column is not pushed
    below the computation with a copy of it."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def unparsed(columns: list[str]) -> Column:
    """True for a record without any field: malformed, empty or foreign text."""
    return F.coalesce(*[F.col(c).cast("string") for c in columns]).isNull()


def typed_times(df: DataFrame, columns: list[str], zone: str | None = None) -> DataFrame:
    return df.withColumns({c: parse_iso(c, zone) for c in columns})


def processed(df: DataFrame) -> DataFrame:
    """Adds the processing time; within a micro-batch it is the batch time."""
    return df.withColumn("processado_em", F.current_timestamp())


def events(messages: DataFrame, value: str = "value", zone: str | None = None) -> DataFrame:
    """Messages to event rows with processing time."""
    return processed(parse(decode(messages, value), schemas.EVENT, zone=zone))


def tagged(df: DataFrame, tag: str, processed_at: Column | None = None) -> DataFrame:
    """All columns plus the kind and the processing time, ready to publish."""
    moment = F.current_timestamp() if processed_at is None else processed_at
    return df.withColumns({"tipo_evento": F.lit(tag), "processado_em": moment})


def to_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Each row as JSON bytes in ``value``, with a message key when given."""
    value = F.to_json(F.struct("*"), JSON_OPTIONS).cast("binary").alias("value")
    if key is None:
        return df.select(value)
    return df.select(F.col(key).cast("string").cast("binary").alias("key"), value)


def manual_events(df: DataFrame) -> DataFrame:
    """Hand-entered events: what is missing gets the manual defaults.

    The id is random, so store the rows before they are used twice.
    """
    have = set(df.columns)

    def given(name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if name in have else F.lit(None).cast(kind)

    defaults = schemas.MANUAL_EVENT_DEFAULTS
    return df.select(
        F.coalesce(given("id", "string"), F.uuid()).alias("id"),
        F.coalesce(given("usuario", "string"), F.lit(defaults["usuario"])).alias("usuario"),
        given("evento", "string").alias("evento"),
        given("valor", "double").alias("valor"),
        F.coalesce(given("timestamp", "timestamp"), F.current_timestamp()).alias("timestamp"),
        F.coalesce(given("categoria", "string"), F.lit(defaults["categoria"])).alias("categoria"),
    )
