"""Splits one mixed message stream into events, leads, sessions and leftovers."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivermark import schemas
from rivermark.operators import payload, quality

Sink = Callable[[DataFrame, str, int], None]


def _fields(schema: str) -> dict[str, str]:
    """Names and types of a DDL text whose types hold no comma."""
    return dict(part.split(maxsplit=1) for part in schema.split(","))


EVENT_FIELDS = list(_fields(schemas.EVENT))
LEAD_FIELDS = list(_fields(schemas.LEAD))
SESSION_FIELDS = list(_fields(schemas.SESSION))

# Every kind's fields in one schema. They share only the id, which is text in
# all, so one parse serves whichever kind the message turns out to be.
# The text of a record with a value that is not of its field's type is kept in
# BAD_VALUE; the other fields are read all the same.
BAD_VALUE = "_corrupt_record"
TYPES = _fields(schemas.EVENT) | _fields(schemas.LEAD) | _fields(schemas.SESSION)
ANY_KIND = ", ".join(
    f"{name} {kind}" for name, kind in (TYPES | {"tipo_evento": "string", BAD_VALUE: "string"}).items()
)


class Branch(NamedTuple):
    """How one kind of record is completed and checked."""

    fields: list[str]
    times: list[str]
    defaults: Mapping[str, object]
    time_defaults: list[str]
    rules: list[quality.Rule]


def branches() -> dict[str, Branch]:
    return {
        "events": Branch(EVENT_FIELDS, [], {}, [], quality.event_rules()),
        "leads": Branch(
            LEAD_FIELDS,
            schemas.LEAD_TIMES,
            schemas.LEAD_DEFAULTS,
            schemas.LEAD_TIME_DEFAULTS,
            quality.lead_rules(),
        ),
        "sessions": Branch(
            SESSION_FIELDS,
            schemas.SESSION_TIMES,
            schemas.SESSION_DEFAULTS,
            schemas.SESSION_TIME_DEFAULTS,
            quality.session_rules(),
        ),
    }


def routed(texts: DataFrame, zone: str | None = None) -> DataFrame:
    """Parsed messages with their ``route``; untagged messages are events.

    ``zone`` is the producers' zone, for event times without an offset.
    """
    kind = F.col("tipo_evento")
    route = (
        F.when(kind.isNull(), "events")
        .when(kind == schemas.LEAD_TAG, "leads")
        .when(kind == schemas.SESSION_TAG, "sessions")
        .otherwise("unknown")
    )
    return payload.parse(texts, ANY_KIND, keep_raw=True, zone=zone).withColumn("route", route)


def type_rules(fields: list[str]) -> list[quality.Rule]:
    """A stated value that its field cannot hold; an absent one or a JSON null is none.

    The text is looked into again for records that Spark could not read in full only.
    """
    typed = [c for c in fields if TYPES[c] != "string"]
    stated = {c: F.get_json_object("json_data", f"$.{c}").isNotNull() for c in typed}
    return [
        quality.Rule(f"type_{c}", F.when(F.col(BAD_VALUE).isNotNull() & F.col(c).isNull(), stated[c]).otherwise(False))
        for c in typed
    ]


def checked(marked: DataFrame, name: str, zone: str | None = None) -> DataFrame:
    """Typed rows of one route with their text and broken rules.

    ``zone`` is the producers' zone for lead and session times without an
    offset.
    """
    branch = branches()[name]
    rows = marked.where(F.col("route") == name).select("json_data", BAD_VALUE, *branch.fields)
    rows = rows.withColumn("no_record", payload.unparsed(branch.fields))
    # A time that is stated but does not parse is a broken row, not an absent time.
    bad_times = [
        quality.Rule(f"time_{c}", F.col(c).isNotNull() & payload.parse_iso(c, zone).isNull())
        for c in branch.times
    ]
    bad_types = [quality.Rule(r.name, ~F.col("no_record") & r.broken) for r in type_rules(branch.fields)]
    # Known before the defaults: they are for absent values, not for bad ones.
    rules = [quality.Rule("unparseable", F.col("no_record")), *bad_times, *bad_types]
    rows = quality.checked(rows, rules).drop(BAD_VALUE)
    rows = payload.processed(payload.typed_times(rows, branch.times, zone))
    if branch.defaults:
        rows = quality.with_defaults(rows, branch.defaults)
        rows = quality.with_time_defaults(rows, branch.time_defaults, "processado_em")
    early = rows.withColumnRenamed("violations", "early")
    late = quality.checked(early, branch.rules)
    broken = F.when(F.col("no_record"), F.col("early")).otherwise(F.concat("early", "violations"))
    return payload.settled(late.withColumn("violations", broken).drop("early", "no_record"))


def accepted(rows: DataFrame) -> DataFrame:
    return quality.clean(rows).drop("json_data")


def rejected(rows: DataFrame) -> DataFrame:
    return quality.quarantined(rows).select("json_data", "violations")


def outputs(
    marked: DataFrame, zone: str | None = None, routes: Collection[str] | None = None
) -> dict[str, DataFrame]:
    """Every message in exactly one frame: a route's rows, unknown, quarantine.

    With ``routes`` only those are given, with their own quarantine; the
    messages of the others belong to another job.
    """
    rows = {name: checked(marked, name, zone) for name in branches() if routes is None or name in routes}
    frames = {name: accepted(frame) for name, frame in rows.items()}
    frames["unknown"] = marked.where(F.col("route") == "unknown").select("json_data", "tipo_evento")
    frames["quarantine"] = reduce(DataFrame.unionByName, [rejected(f) for f in rows.values()])
    return frames


def split(
    texts: DataFrame, zone: str | None = None, routes: Collection[str] | None = None
) -> dict[str, DataFrame]:
    return outputs(routed(texts, zone), zone, routes)


class SinkError(RuntimeError):
    """Raised after all sinks were tried when some could not be written."""


def write_all(
    frames: Mapping[str, DataFrame],
    sinks: Mapping[str, Sink],
    query_id: str,
    batch_id: int,
    discarded: Collection[str] = (),
) -> None:
    """Gives each sink its frame.

    A frame without a sink is an error unless ``discarded`` names it, and so is
    a sink without a frame: no rows go missing by a misspelt name.

    A failing sink does not keep the others from being written, but the batch
    fails as a whole and is replayed, so its rows are not lost. Sinks must be
    idempotent by query and batch, or by key.
    """
    unmatched = (set(frames) - set(discarded)) ^ set(sinks)
    if unmatched:
        raise ValueError(f"frames and sinks do not match: {', '.join(sorted(unmatched))}")
    failed: dict[str, Exception] = {}
    for name, sink in sinks.items():
        try:
            sink(frames[name], query_id, batch_id)
        except Exception as error:
            failed[name] = error
    if failed:
        names = ", ".join(sorted(failed))
        raise SinkError(f"batch {batch_id}: not written: {names}") from next(iter(failed.values()))


def write_routes(
    texts: DataFrame,
    sinks: Mapping[str, Sink],
    query_id: str,
    batch_id: int,
    zone: str | None = None,
    routes: Collection[str] | None = None,
    discarded: Collection[str] = (),
) -> None:
    """Writes one batch of mixed messages to the sinks of its routes.

    The parsed batch is kept while its sinks run: all tables and the
    quarantine come from one read and one parse.
    """
    marked = routed(texts, zone).persist()
    try:
        write_all(outputs(marked, zone, routes), sinks, query_id, batch_id, discarded)
    finally:
        marked.unpersist()
