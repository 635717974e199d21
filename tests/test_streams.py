from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from rivermark import schemas
from rivermark.operators import payload, windows
from rivermark.sinks import files
from rivermark.sources import shapes
from rivermark.sources.streams import file_stream, message_stream
from rivermark.streaming import jobs, router
from rivermark.streaming.progress import late_rows, progress_log, progress_rows

EVENTS = "/root/testdata/sf0.001"
MESSAGE = "value binary"
NOW = {"availableNow": True}


@pytest.fixture(scope="module")
def events(spark):
    return shapes.event_columns(shapes.table(spark, EVENTS, "events")).orderBy("timestamp").cache()


def drop_file(df, folder, number, age):
    """One message file; older files get an older modification time."""
    import os
    from pathlib import Path

    payload.to_messages(df).coalesce(1).write.parquet(f"{folder}-parts/{number}")
    Path(folder).mkdir(exist_ok=True)
    part = next(Path(f"{folder}-parts/{number}").glob("*.parquet"))
    target = f"{folder}/{number}.parquet"
    os.link(part, target)
    moment = datetime(2024, 1, 1).timestamp() + age
    os.utime(target, (moment, moment))


def quarters(events):
    """The events in four parts in time order."""
    marks = events.agg(F.min("timestamp"), F.max("timestamp")).first()
    step = (marks[1] - marks[0]) / 4
    bounds = [marks[0] + step * i for i in range(4)] + [marks[1] + timedelta(seconds=1)]
    return [
        events.where((F.col("timestamp") >= low) & (F.col("timestamp") < high))
        for low, high in zip(bounds, bounds[1:])
    ]


def stream_of(spark, folder):
    return file_stream(spark, folder, MESSAGE, files_per_batch=1)


def run_windows(spark, folder, out, checkpoints):
    return jobs.replay(
        jobs.start_windows, stream_of(spark, folder), jobs.file_sink(out), checkpoints, scale=2
    )


WINDOW_SCHEMA = (
    "janela_inicio timestamp, janela_fim timestamp, categoria string, evento string, "
    "total_eventos bigint, valor_medio double, valor_total double, processado_em timestamp"
)


def stored_windows(spark, out):
    return files.table_rows(spark, out, WINDOW_SCHEMA).drop("processado_em")


def closed(events):
    zoned = events.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    limit = zoned.agg((F.max("timestamp") - F.expr("INTERVAL 10 MINUTES")).alias("limit")).scalar()
    return windows.sliding_stats_by_panes(zoned, scale=2).where(F.col("janela_fim") <= limit)


def test_stream_equals_batch_for_closed_windows(spark, events, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i, part in enumerate(quarters(events)):
        drop_file(part, folder, i, i)
    query = run_windows(spark, folder, out, str(tmp_path / "cp"))
    assert query.exception() is None
    assert sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators) == 0
    assert rows_of(stored_windows(spark, out)) == rows_of(closed(events))
    keys = stored_windows(spark, out).groupBy(*schemas.WINDOW_KEY).count()
    assert keys.where("count > 1").isEmpty()


def test_restart_resumes_and_emits_each_window_once(spark, events, tmp_path):
    folder, out, cp = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    parts = quarters(events)
    for i in (0, 1):
        drop_file(parts[i], folder, i, i)
    first = run_windows(spark, folder, out, cp)
    for i in (2, 3):
        drop_file(parts[i], folder, i, i)
    second = run_windows(spark, folder, out, cp)
    assert first.id == second.id
    assert sum(p.numInputRows for p in second.recentProgress) == parts[2].count() + parts[3].count()
    assert rows_of(stored_windows(spark, out)) == rows_of(closed(events))


def test_late_rows_are_dropped_and_counted(spark, events, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    parts = quarters(events)
    for age, i in enumerate((3, 2, 1, 0)):
        drop_file(parts[i], folder, i, age)
    with progress_log(spark, str(tmp_path / "log")) as log:
        query = run_windows(spark, folder, out, str(tmp_path / "cp"))
        log.wait(query)
    late = sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    got, want = set(rows_of(stored_windows(spark, out))), set(rows_of(closed(events)))
    assert got and got < want
    by_name = {p.batchId: p for p in query.recentProgress}
    table = progress_rows(spark, str(tmp_path / "log"))
    assert late > 0 and rows_of(late_rows(table)) == [(query.name or "eventos_agregados", late)]
    assert {r.lote for r in table.collect()} == set(by_name)


def test_progress_of_more_batches_than_a_query_remembers(spark, tmp_path):
    folder = tmp_path / "in"
    for n in range(110):
        drop_file(spark.range(n % 3 + 1).selectExpr("CAST(id AS STRING) AS id"), str(folder), n, n)
    with progress_log(spark, str(tmp_path / "log")) as log:
        query = jobs.replay(
            jobs.start, stream_of(spark, str(folder)), "muitos", lambda rows, q, b: rows.count(), str(tmp_path / "cp")
        )
        log.wait(query)
    table = progress_rows(spark, str(tmp_path / "log"))
    assert len(query.recentProgress) <= 100 < table.count()
    assert table.agg(F.sum("linhas")).first()[0] == sum(n % 3 + 1 for n in range(110))


def test_raw_and_documents_come_from_one_read(spark, events, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path)
    for i, part in enumerate(quarters(events)):
        drop_file(part, folder, i, i)
    bad = spark.createDataFrame([("no json",), (None,)], "value string").select(F.col("value").cast("binary"))
    bad.coalesce(1).write.parquet(f"{folder}-parts/bad")
    import os
    from pathlib import Path

    os.link(next(Path(f"{folder}-parts/bad").glob("*.parquet")), f"{folder}/bad.parquet")
    sinks = {n: jobs.file_sink(f"{root}/{n}") for n in ("raw", "documents", "quarantine")}
    query = jobs.replay(jobs.start_raw_and_documents, stream_of(spark, folder), sinks, f"{root}/cp")
    schema = f"{schemas.EVENT}, processado_em timestamp"
    raw = files.table_rows(spark, f"{root}/raw", schema)
    documents = files.table_rows(spark, f"{root}/documents", schema)
    assert rows_of(raw) == rows_of(documents) and raw.count() == events.count()
    lost = files.table_rows(spark, f"{root}/quarantine", "json_data string, violations array<string>")
    assert {r.json_data for r in lost.collect()} == {"no json", None}
    assert sum(p.numInputRows for p in query.recentProgress) == events.count() + 2


def test_failed_batch_is_replayed_without_loss_or_repeat(spark, events, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path)
    for i, part in enumerate(quarters(events)):
        drop_file(part, folder, i, i)
    raw = jobs.file_sink(f"{root}/raw")
    failures = [2]

    def documents(rows, query_id, batch_id):
        if batch_id == 2 and failures:
            failures.pop()
            raise OSError("document store away")
        files.write_batch(rows, f"{root}/documents", query_id, batch_id)

    sinks = {"documents": documents, "raw": raw}
    with pytest.raises(Exception, match="not written: documents"):
        jobs.replay(jobs.start_raw_and_documents, stream_of(spark, folder), sinks, f"{root}/cp")
    jobs.replay(jobs.start_raw_and_documents, stream_of(spark, folder), sinks, f"{root}/cp")
    schema = f"{schemas.EVENT}, processado_em timestamp"
    for name in ("raw", "documents"):
        table = files.table_rows(spark, f"{root}/{name}", schema)
        assert table.count() == events.count() == table.select("id").distinct().count()


def test_router_restarts_without_repeats(spark, events, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path)
    parts = quarters(events)
    sinks = {n: jobs.file_sink(f"{root}/{n}") for n in ("events", "unknown", "quarantine")}
    for i, part in enumerate(parts):
        drop_file(part, folder, i, i)
        jobs.replay(jobs.start_router, stream_of(spark, folder), sinks, f"{root}/cp", discarded=["leads", "sessions"])
    stored = files.table_rows(spark, f"{root}/events", f"{schemas.EVENT}, processado_em timestamp")
    assert stored.count() == events.count() == stored.select("id").distinct().count()
    again = files.read_batches(spark, f"{root}/events", schemas.EVENT)
    assert again.select("consulta").distinct().count() == 1


def test_a_failing_query_stops_the_others(spark, events, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path)
    drop_file(events, folder, 0, 0)
    stream = stream_of(spark, folder)

    def broken(rows, query_id, batch_id):
        raise OSError("away")

    jobs.start_raw_and_documents(stream, {"raw": jobs.file_sink(f"{root}/raw")}, f"{root}/cp")
    jobs.start_windows(stream, broken, f"{root}/cp", trigger={"processingTime": "1 second"})
    spark.streams.resetTerminated()
    with pytest.raises(Exception, match="away"):
        jobs.run_until_one_stops(spark)
    assert spark.streams.active == []
    spark.streams.resetTerminated()


def test_source_is_a_parameter(spark):
    stream = message_stream(spark, "rate", {"rowsPerSecond": "1"})
    assert stream.isStreaming and "value" in stream.columns


def test_watermark_needs_a_zoned_time(spark):
    zoned = spark.readStream.format("rate").load().select(
        F.col("timestamp"), F.lit("a").alias("categoria"), F.lit("x").alias("evento"), F.lit(1.0).alias("valor")
    )
    assert jobs.windowed(zoned).isStreaming
    assert router.EVENT_FIELDS == ["id", "usuario", "evento", "valor", "timestamp", "categoria"]
