"""Starts the streaming jobs: ``PYTHONPATH=. spark-submit rivermark/run.py events ...``.

Events and windows go to Parquet folders below ``--store``, or with ``--jdbc`` to
a database, where a stored key is never inserted again. Leads and sessions
change, so they are updated by key: in day folders below ``--store``, or with
``--connect`` in a database. Documents go to ``--documents`` when it is given.
Source and connector jars come from the cluster (``--packages``).

The events job owns the events, the router leads and sessions; each has its
quarantine, and all jobs keep their progress below ``--store``.
"""

from __future__ import annotations

import argparse
from importlib import import_module

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from rivermark import schemas
from rivermark.session import spark_session
from rivermark.sinks import connectors, database, versions
from rivermark.sources.streams import broker_options, message_stream
from rivermark.streaming import constraints, jobs
from rivermark.streaming.lookup import Lookup
from rivermark.streaming.progress import fold_progress, progress_log
from rivermark.streaming.router import Sink

# Tables that only grow: name, key, and the key's time for narrowing the lookup.
EVENT_TABLE = ("eventos_raw", schemas.EVENT_KEY, "timestamp")
WINDOW_TABLE = ("eventos_agregados", schemas.WINDOW_KEY, "janela_inicio")
# Tables whose rows change, by route: name, what says which version is newer, and the day's time.
CHANGING_TABLES = {
    "leads": ("leads", ["updated_at"], "created_at"),
    "sessions": ("chat_sessions", ["processado_em"], "started_at"),
}


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="rivermark")
    parser.add_argument("job", choices=["events", "router"])
    parser.add_argument("--servers", required=True, help="broker addresses")
    parser.add_argument("--topic", default="eventos")
    parser.add_argument("--starting", choices=["latest", "earliest"])
    parser.add_argument("--checkpoints", required=True, help="folder all executors reach")
    parser.add_argument("--store", required=True, help="folder for tables and quarantine")
    parser.add_argument("--jdbc", help="database URL; events and windows are written there")
    parser.add_argument("--jdbc-option", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--connect", metavar="MODULE:FUNCTION", help="opens a DB-API connection in a task")
    parser.add_argument("--documents", metavar="HOST:PORT", help="document store")
    parser.add_argument("--zone", help="zone of times without an offset")
    parser.add_argument("--per-batch", type=int, help="most messages of one batch")
    parser.add_argument("--fail-on-data-loss", action="store_true", help="stop when the broker has deleted messages unread")
    parser.add_argument("--stop", metavar="FOLDER", help="end after the running batch when this folder exists")
    parser.add_argument("--once", action="store_true", help="take what is there and end")
    given = parser.parse_args(argv)
    if given.job == "router" and given.jdbc:
        parser.error("leads and sessions are updated by key: give --connect and not --jdbc")
    return given


def table_sink(spark: SparkSession, given: argparse.Namespace, table: tuple) -> Sink:
    name, keys, time = table
    if given.jdbc is None:
        return jobs.file_sink(f"{given.store}/{name}")
    options = dict(pair.split("=", 1) for pair in given.jdbc_option)
    return database.jdbc_sink(spark, given.jdbc, name, options, keys, time)


def lead_indexes(spark: SparkSession, store: str) -> tuple[Lookup, Lookup]:
    """Who has an e-mail, and which leads are stored; built from the leads if they are older than their indexes."""
    emails, ids = Lookup(spark, f"{store}/indices/email"), Lookup(spark, f"{store}/indices/lead")
    leads = f"{store}/{CHANGING_TABLES['leads'][0]}"
    if versions.index(spark, leads):
        rows = versions.table_rows(spark, leads, "id string, email string")
        emails.build(rows.selectExpr("email AS valor", "id AS dono"))
        ids.build(rows.selectExpr("id AS valor", "id AS dono"))
    return emails, ids


def changing_sink(spark: SparkSession, given: argparse.Namespace, route: str) -> Sink:
    """Below ``--store`` the rules between rows are kept too; a database has its own constraints."""
    name, order, day = CHANGING_TABLES[route]
    if given.connect is None:
        inner = versions.upsert_sink(f"{given.store}/{name}", schemas.ID_KEY, order, day)
        records = f"{given.store}/decisoes/{name}"
        emails, ids = lead_indexes(spark, given.store)
        if route == "sessions":
            return constraints.parent_sink(inner, records, ids.owners, "lead_id")
        refused = jobs.file_sink(f"{given.store}/quarentena/email")
        leads, part = f"{given.store}/{name}", versions.part_of(day)
        stored = lambda rows: versions.part_rows(spark, leads, rows.schema, versions.touched(rows, part))
        return constraints.unique_sink(inner, refused, records, emails, stored, "email", order, keys=ids)
    module, function = given.connect.split(":")
    return database.upsert_sink(getattr(import_module(module), function), name, schemas.ID_KEY, order)


def document_sink(given: argparse.Namespace) -> Sink:
    host, port = given.documents.rsplit(":", 1)
    options = connectors.document_options(host, int(port), "eventos")
    return lambda rows, query_id, batch_id: connectors.write_documents(rows, options)


def start(spark: SparkSession, given: argparse.Namespace) -> list[StreamingQuery]:
    starting = given.starting or {"events": "latest", "router": "earliest"}[given.job]
    source = broker_options(given.servers, given.topic, starting, given.per_batch, given.fail_on_data_loss)
    messages = message_stream(spark, "kafka", source)
    trigger = {"availableNow": True} if given.once else None
    quarantine = jobs.file_sink(f"{given.store}/quarentena/{given.job}")
    if given.job == "router":
        sinks = {route: changing_sink(spark, given, route) for route in CHANGING_TABLES}
        sinks |= {"unknown": jobs.file_sink(f"{given.store}/desconhecidos"), "quarantine": quarantine}
        return [jobs.start_router(messages, sinks, given.checkpoints, trigger, given.zone, list(CHANGING_TABLES), stop_marker=given.stop)]
    sinks = {"raw": table_sink(spark, given, EVENT_TABLE), "quarantine": quarantine}
    if given.documents:
        sinks["documents"] = document_sink(given)
    raw = jobs.start_raw_and_documents(messages, sinks, given.checkpoints, trigger, given.zone, given.stop)
    windows = table_sink(spark, given, WINDOW_TABLE)
    return [raw, jobs.start_windows(messages, windows, given.checkpoints, trigger, zone=given.zone, stop_marker=given.stop)]


def main() -> None:
    given = arguments()
    spark = spark_session("rivermark")
    with progress_log(spark, f"{given.store}/progresso") as log:
        queries = start(spark, given)
        if not given.once:
            jobs.run_until_one_stops(spark, given.stop, between=log.raise_failed)
        for query in queries:
            jobs.ended(query)  # raises the query's failure, also of one that has ended by now
            log.wait(query)
    fold_progress(spark, f"{given.store}/progresso")


if __name__ == "__main__":
    main()
