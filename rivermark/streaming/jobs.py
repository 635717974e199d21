"""The streaming queries: raw rows and documents, windows, the router."""

from __future__ import annotations

import time
from collections.abc import Callable, Collection, Mapping

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rivermark import schemas
from rivermark.operators import payload, windows
from rivermark.sinks import files, folders
from rivermark.streaming.router import (
    Sink,
    accepted,
    checked,
    rejected,
    routed,
    write_all,
    write_routes,
)

QUERY_ID = "sql.streaming.queryId"


def file_sink(root: str) -> Sink:
    """Stores each batch below ``root``, replacing its earlier attempt; a batch without rows leaves no folder."""

    def write(rows: DataFrame, query_id: str, batch_id: int) -> None:
        files.write_batch(rows, root, query_id, batch_id)
        files.drop_empty(rows.sparkSession, root, query_id, batch_id, rows.schema)

    return write


class StopRequested(Exception):
    """A batch was not begun because a stop was asked for; the next start runs it."""


def ask_to_stop(spark: SparkSession, folder: str) -> None:
    """Leaves the marker that running jobs look for before each batch."""
    spark.range(1).coalesce(1).write.mode("overwrite").parquet(folder)


def stop_asked(spark: SparkSession, folder: str | None) -> bool:
    return folder is not None and folders.complete(spark, folder)


def stopped_on_purpose(error: Exception) -> bool:
    return StopRequested.__name__ in str(error)


def start(
    stream: DataFrame,
    name: str,
    write: Callable[[DataFrame, str, int], None],
    checkpoints: str,
    trigger: Mapping[str, object] | None = None,
    mode: str = "append",
    stop_marker: str | None = None,
) -> StreamingQuery:
    """Starts a named query with its own checkpoint folder.

    When the folder ``stop_marker`` exists the running batch ends, and the next one is refused before it writes anything.

    The query's id lives in the checkpoint: a restart keeps it and replays the
    open batch under the same number, a new checkpoint never reuses either.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        if stop_asked(rows.sparkSession, stop_marker):
            raise StopRequested(f"{name}: stopped before batch {batch_id}")
        query_id = rows.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        write(rows, query_id, batch_id)

    writer = stream.writeStream.queryName(name).outputMode(mode).foreachBatch(batch)
    writer = writer.option("checkpointLocation", f"{checkpoints}/{name}")
    return writer.trigger(**(trigger or {"processingTime": "1 minute"})).start()


def stored_event_rows(messages: DataFrame, zone: str | None = None) -> DataFrame:
    """Untagged messages as typed rows with their broken rules."""
    return checked(routed(payload.decode(messages), zone), "events")


def start_raw_and_documents(
    messages: DataFrame,
    sinks: Mapping[str, Sink],
    checkpoints: str,
    trigger=None,
    zone: str | None = None,
    stop_marker: str | None = None,
) -> StreamingQuery:
    """Raw table and document index from one read and one parse.

    Sinks: ``raw``, ``documents`` and, to keep what cannot be stored,
    ``quarantine``. Those that are not given are left out on purpose.
    """
    frames_of = {"raw": accepted, "documents": accepted, "quarantine": rejected}

    def write(batch: DataFrame, query_id: str, batch_id: int) -> None:
        rows = batch.persist()
        frames = {name: make(rows) for name, make in frames_of.items() if name in sinks}
        try:
            write_all(frames, sinks, query_id, batch_id)
        finally:
            rows.unpersist()

    return start(stored_event_rows(messages, zone), "eventos_raw", write, checkpoints, trigger, stop_marker=stop_marker)


def windowed(
    events: DataFrame, lateness: str = schemas.LATENESS, scale: int | None = None
) -> DataFrame:
    """Sliding statistics of an event stream.

    A window is emitted once, when the newest event time passed its end by
    the lateness; rows later than that are dropped and counted in the
    progress. The last windows stay open until newer events arrive.
    """
    return windows.sliding_stats_by_panes(events.withWatermark("timestamp", lateness), scale=scale)


def start_windows(
    messages: DataFrame,
    sink: Sink,
    checkpoints: str,
    trigger=None,
    scale: int | None = None,
    zone: str | None = None,
    stop_marker: str | None = None,
) -> StreamingQuery:
    rows = accepted(stored_event_rows(messages, zone))
    stats = payload.processed(windowed(rows.drop("processado_em"), scale=scale))
    return start(stats, "eventos_agregados", sink, checkpoints, trigger, stop_marker=stop_marker)


def start_router(
    messages: DataFrame,
    sinks: Mapping[str, Sink],
    checkpoints: str,
    trigger=None,
    zone: str | None = None,
    routes: Collection[str] | None = None,
    discarded: Collection[str] = (),
    stop_marker: str | None = None,
) -> StreamingQuery:
    """The ``routes`` (all by default) from one stream; sinks by route name, see router.split."""

    def write(texts: DataFrame, query_id: str, batch_id: int) -> None:
        write_routes(texts, sinks, query_id, batch_id, zone, routes, discarded)

    return start(payload.decode(messages), "roteador", write, checkpoints, trigger, stop_marker=stop_marker)


def replay(stream_start: Callable[..., StreamingQuery], *args, **kwargs) -> StreamingQuery:
    """Runs a query over everything available and waits for its end."""
    query = stream_start(*args, trigger={"availableNow": True}, **kwargs)
    query.awaitTermination()
    return query


def ended(query: StreamingQuery) -> bool:
    """Waits for a query's end; False if it stopped because it was asked to."""
    try:
        query.awaitTermination()
    except StreamingQueryException as error:
        if not stopped_on_purpose(error):
            raise
        return False
    return True


def run_until_one_stops(
    spark: SparkSession, stop_marker: str | None = None, every: float = 5, between: Callable[[], None] = lambda: None
) -> None:
    """Waits for all queries; when one ends or fails, stops the others.

    A failure is raised here whichever query it comes from. With ``stop_marker`` it looks for the marker ``every`` few seconds:
    queries between two batches are stopped, the others when their batch has ended. ``between`` is called as often and may raise.
    """
    try:
        while not stop_asked(spark, stop_marker):
            between()
            try:
                if spark.streams.awaitAnyTermination(every):
                    return
            except StreamingQueryException as error:
                if not stopped_on_purpose(error):
                    raise
                break
        while any(q.status["isTriggerActive"] for q in spark.streams.active):
            time.sleep(min(every, 0.5))
    finally:
        for query in spark.streams.active:
            query.stop()
