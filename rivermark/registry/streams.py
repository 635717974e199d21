"""Streaming runs over the tables' files, read back from their sinks.

Each run takes everything available and ends; its checkpoint and its output
lie in new folders of the cluster's shared checkpoint folder.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivermark import schemas
from rivermark.operators import keyed, payload
from rivermark.registry.base import (
    AMOUNT_SCALE,
    EVENTOS,
    JANELAS,
    LEADS,
    SESSIONS,
    Data,
    StreamData,
    query,
    texts,
)
from rivermark.registry.messages import (
    LEAD_PARTS,
    PARSED_SESSIONS,
    SESSION_PARTS,
    TAGGED_LEADS,
    event_messages,
    mixed_messages,
)
from rivermark.registry.scans import EVENT_COLUMNS, EVENT_SQL
from rivermark.session import shared_folder
from rivermark.sinks import files, folders, versions
from rivermark.sources.streams import file_stream
from rivermark.streaming import jobs, router
from rivermark.streaming.progress import fold_progress, late_rows, progress_log, progress_rows

ROUTES = ["events", "leads", "sessions", "unknown", "quarantine"]


FILES_PER_BATCH = 200  # bounds what one batch keeps in memory; the rest comes in further batches


def _run_events(d: Data, sinks: list[str]) -> tuple[str, object, DataFrame]:
    """Raw rows and documents of one run; the folder, the query, the raw rows' shape."""
    root = shared_folder(d.spark, "event-run")
    messages = event_messages(StreamData(d.spark, d.folder, FILES_PER_BATCH)).select("value")
    targets = {name: jobs.file_sink(f"{root}/{name}") for name in sinks}
    run = jobs.replay(jobs.start_raw_and_documents, messages, targets, f"{root}/checkpoints")
    shape = router.accepted(jobs.stored_event_rows(messages))
    return root, run, shape


def _run_router(d: Data, routes: list[str], runs: int = 1) -> dict[str, DataFrame]:
    """Tables of the given routes after running the same checkpoint ``runs`` times."""
    root = shared_folder(d.spark, "router-run")
    messages = mixed_messages(StreamData(d.spark, d.folder, FILES_PER_BATCH))
    targets = {name: jobs.file_sink(f"{root}/{name}") for name in routes}
    others = [name for name in ROUTES if name not in routes]
    for _ in range(runs):
        jobs.replay(jobs.start_router, messages, targets, f"{root}/checkpoints", discarded=others)
    shapes = router.split(payload.decode(messages))
    return {
        name: files.table_rows(d.spark, f"{root}/{name}", shapes[name].schema) for name in routes
    }


@query("s01_stream_ingest", f"SELECT {EVENT_SQL} FROM eventos", EVENTOS)
def stream_ingest(d: Data):
    root, _, shape = _run_events(d, ["raw"])
    return files.table_rows(d.spark, f"{root}/raw", shape.schema).select(*EVENT_COLUMNS)


@query("s02_stream_from_start", f"{PARSED_SESSIONS} FROM sessions", SESSIONS)
def stream_from_start(d: Data):
    rows = _run_router(d, ["sessions"])["sessions"]
    return texts(rows.select(*SESSION_PARTS), "pages_visited")


@query("k03_routed_leads", f"{TAGGED_LEADS} FROM leads", LEADS)
def routed_leads(d: Data):
    return texts(_run_router(d, ["leads"])["leads"].select(*LEAD_PARTS), "interesse")


@query(
    "t02_stream_windows",
    """SELECT * FROM janelas
    WHERE janela_fim <= (SELECT max(timestamp) FROM eventos) - INTERVAL 10 MINUTE""",
    EVENTOS,
    JANELAS,
)
def stream_windows(d: Data):
    """Windows the watermark has closed."""
    root = shared_folder(d.spark, "window-run")
    messages = event_messages(StreamData(d.spark, d.folder)).select("value")
    sink = jobs.file_sink(f"{root}/windows")
    jobs.replay(jobs.start_windows, messages, sink, f"{root}/checkpoints", scale=AMOUNT_SCALE)
    rows = payload.processed(jobs.windowed(jobs.stored_event_rows(messages), scale=AMOUNT_SCALE))
    return files.table_rows(d.spark, f"{root}/windows", rows.schema).drop("processado_em")


@query(
    "t06_two_sinks",
    """SELECT destino, (SELECT count(*) FROM events) AS linhas, 0::BIGINT AS chaves_ausentes
    FROM (VALUES ('raw'), ('documents')) t(destino)""",
)
def two_sinks(d: Data):
    root, _, shape = _run_events(d, ["raw", "documents"])
    raw, documents = (files.table_rows(d.spark, f"{root}/{n}", shape.schema) for n in ("raw", "documents"))
    return keyed.reconcile(raw, documents, schemas.EVENT_KEY, ("raw", "documents"))


@query(
    "t08_routed_counts",
    """SELECT 'events' AS rota, count(*) AS linhas FROM events
    UNION ALL SELECT 'leads', count(*) FROM customer
    UNION ALL SELECT 'sessions', count(*) FROM orders
    UNION ALL SELECT 'unknown', count(*) FROM conversations
    UNION ALL SELECT 'quarantine', count(*) FROM conversations""",
)
def routed_counts(d: Data):
    tables = _run_router(d, ROUTES)
    counts = [t.agg(F.lit(n).alias("rota"), F.count("*").alias("linhas")) for n, t in tables.items()]
    return reduce(DataFrame.unionByName, counts)


@query(
    "t13_repeated_run",
    "SELECT id, count(*) AS vezes FROM eventos GROUP BY id",
    EVENTOS,
)
def repeated_run(d: Data):
    """A second run of the same checkpoint adds nothing."""
    rows = _run_router(d, ["events"], runs=2)["events"]
    return rows.groupBy("id").agg(F.count("*").alias("vezes"))


LEADS_AGAIN = """updated_at + CASE origem WHEN 'site' THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END"""


@query(
    "k08_upsert_sink",
    f"""SELECT id, email, CASE origem WHEN 'site' THEN 'convertido' ELSE status_lead END AS status_lead,
              origem, created_at, {LEADS_AGAIN} AS updated_at FROM leads""",
    LEADS,
)
def upsert_sink(d: Data):
    """All leads, then newer versions of some and older versions of others."""
    root = shared_folder(d.spark, "upsert-sink")
    columns = ["id", "email", "status_lead", "origem", "created_at", "updated_at"]
    leads = StreamData(d.spark, d.folder, FILES_PER_BATCH).leads.select(*columns)
    day = F.expr("INTERVAL 1 DAY")
    again = leads.where("origem in ('site', 'chatbot')").withColumns(
        {
            "status_lead": F.when(F.col("origem") == "site", "convertido").otherwise("perdido"),
            "updated_at": F.when(F.col("origem") == "site", F.col("updated_at") + day).otherwise(F.col("updated_at") - day),
        }
    )
    sink = versions.upsert_sink(f"{root}/leads", schemas.ID_KEY, ["updated_at"], "created_at")
    jobs.replay(jobs.start, leads, "leads", sink, f"{root}/checkpoints")
    jobs.replay(jobs.start, again, "leads_de_novo", sink, f"{root}/checkpoints")
    return versions.table_rows(d.spark, f"{root}/leads", leads.schema)


@query(
    "t04_late_events",
    """SELECT janela_inicio, categoria, evento, total_eventos, true AS atrasadas FROM janelas
    WHERE janela_fim <= (SELECT max(timestamp) FROM eventos) - INTERVAL 10 MINUTE""",
    EVENTOS,
    JANELAS,
)
def late_events(d: Data):
    """All events, then all of them again: windows stay as they are, what comes too late is counted."""
    root, log_folder = shared_folder(d.spark, "late-run"), shared_folder(d.spark, "progress")
    event_messages(d).select("value").write.parquet(f"{root}/messages")
    messages = d.spark.readStream.schema("value binary").parquet(f"{root}/messages")
    sink = jobs.file_sink(f"{root}/windows")
    with progress_log(d.spark, log_folder) as log:
        for again in (False, True):
            if again:
                event_messages(d).select("value").write.mode("append").parquet(f"{root}/messages")
            run = jobs.replay(jobs.start_windows, messages, sink, f"{root}/checkpoints", scale=AMOUNT_SCALE)
            log.wait(run)
    late = late_rows(progress_rows(d.spark, log_folder).where(F.col("id") == str(run.id)))
    rows = payload.processed(jobs.windowed(jobs.stored_event_rows(messages), scale=AMOUNT_SCALE))
    stored = files.table_rows(d.spark, f"{root}/windows", rows.schema)
    found = late.agg((F.sum("linhas_atrasadas") > 0).alias("atrasadas")).scalar()
    return stored.select("janela_inicio", "categoria", "evento", "total_eventos", found.alias("atrasadas"))


@query(
    "t11_progress",
    "SELECT 'eventos_raw' AS consulta, count(*) AS linhas FROM events",
)
def progress(d: Data):
    folder = shared_folder(d.spark, "progress")
    with progress_log(d.spark, folder) as log:
        _, run, _ = _run_events(d, ["raw"])
        log.wait(run)
    rows = progress_rows(d.spark, folder).where(F.col("id") == str(run.id))
    return rows.groupBy("consulta").agg(F.sum("linhas").alias("linhas"))


@query(
    "t03_windows_once",
    """SELECT janela_inicio, categoria, evento, 1::BIGINT AS vezes FROM janelas
    WHERE janela_fim <= (SELECT max(timestamp) FROM eventos) - INTERVAL 10 MINUTE""",
    EVENTOS,
    JANELAS,
)
def windows_once(d: Data):
    """Each window behind the watermark leaves once, also when its events come in two runs."""
    root = shared_folder(d.spark, "windows-once")
    last = d.events.agg(F.max("timestamp")).first()[0]
    middle = F.lit(last - timedelta(days=10))
    sink = jobs.file_sink(f"{root}/windows")
    for half in (F.col("timestamp") < middle, F.col("timestamp") >= middle):
        payload.to_messages(d.events.where(half)).write.mode("append").parquet(f"{root}/messages")
        messages = d.spark.readStream.schema("value binary").parquet(f"{root}/messages")
        jobs.replay(jobs.start_windows, messages, sink, f"{root}/checkpoints", scale=AMOUNT_SCALE)
    rows = payload.processed(jobs.windowed(jobs.stored_event_rows(messages), scale=AMOUNT_SCALE))
    stored = files.table_rows(d.spark, f"{root}/windows", rows.schema)
    return stored.groupBy(*schemas.WINDOW_KEY).agg(F.count("*").alias("vezes"))


@query("t07_restart", "SELECT id, count(*) AS vezes FROM eventos GROUP BY id", EVENTOS)
def restart(d: Data):
    """The raw table after a stop between two deliveries; the checkpoint knows the first."""
    root = shared_folder(d.spark, "restart")
    raw = {"raw": jobs.file_sink(f"{root}/raw")}
    for part in ("evento = 'click'", "evento != 'click'"):
        payload.to_messages(d.events.where(part)).write.mode("append").parquet(f"{root}/messages")
        messages = d.spark.readStream.schema("value binary").parquet(f"{root}/messages")
        jobs.replay(jobs.start_raw_and_documents, messages, raw, f"{root}/checkpoints")
    shape = router.accepted(jobs.stored_event_rows(messages))
    return files.table_rows(d.spark, f"{root}/raw", shape.schema).groupBy("id").agg(F.count("*").alias("vezes"))


@query("t10_stopped_and_resumed", "SELECT id, count(*) AS vezes FROM eventos GROUP BY id", EVENTOS)
def stopped_and_resumed(d: Data):
    """A stop is asked for while a batch runs: it ends, the next is not begun, and the next start takes the rest."""
    root = shared_folder(d.spark, "stopped")
    payload.to_messages(d.events.repartition(4, "id")).write.parquet(f"{root}/messages")
    messages = file_stream(d.spark, f"{root}/messages", "value binary", files_per_batch=1)
    store, marker = jobs.file_sink(f"{root}/raw"), f"{root}/parar"

    def stopping(rows: DataFrame, query_id: str, batch_id: int) -> None:
        if batch_id == 1:
            jobs.ask_to_stop(d.spark, marker)
        store(rows, query_id, batch_id)

    ends = []
    for sink in (stopping, store):
        run = jobs.start_raw_and_documents(
            messages, {"raw": sink}, f"{root}/checkpoints", {"availableNow": True}, stop_marker=marker
        )
        ends.append(jobs.ended(run))
        folders.remove(d.spark, marker)
    shape = router.accepted(jobs.stored_event_rows(messages))
    rows = files.table_rows(d.spark, f"{root}/raw", shape.schema).where(F.lit(ends == [False, True]))
    return rows.groupBy("id").agg(F.count("*").alias("vezes"))


@query(
    "t11_progress_folded",
    "SELECT 'eventos_raw' AS consulta, count(*) AS linhas FROM events",
)
def progress_folded(d: Data):
    """The same from a log that was folded while the query was stopped and again at its end."""
    folder = shared_folder(d.spark, "progress-folded")
    root = shared_folder(d.spark, "folded-run")
    payload.to_messages(d.events.repartition(6, "id")).write.parquet(f"{root}/messages")
    messages = file_stream(d.spark, f"{root}/messages", "value binary", files_per_batch=1)
    sinks = {"raw": jobs.file_sink(f"{root}/raw")}
    for _ in range(2):
        with progress_log(d.spark, folder) as log:
            run = jobs.replay(jobs.start_raw_and_documents, messages, sinks, f"{root}/checkpoints")
            log.wait(run)
        fold_progress(d.spark, folder)
    rows = progress_rows(d.spark, folder).where(F.col("id") == str(run.id))
    return rows.groupBy("consulta").agg(F.sum("linhas").alias("linhas"))
