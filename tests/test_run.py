"""The jobs as the command line starts them, with files in place of the broker."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from rivermark import run, schemas
from rivermark.operators import payload
from rivermark.sinks import database, files, versions
from rivermark.streaming import sync

EVENT = "id string, timestamp timestamp, valor double"


def events(spark, *rows):
    values = ", ".join(f"('{i}', TIMESTAMP '2024-01-01 {t}', {v}D)" for i, t, v in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(id, timestamp, valor)")


def test_keyed_sink_inserts_each_key_once(spark, tmp_path):
    path = str(tmp_path / "t")
    events(spark, ("a", "10:00:00", 1)).write.parquet(path)
    sink = database.keyed_sink(
        lambda: spark.read.schema(EVENT).parquet(path),
        lambda rows: rows.write.mode("append").parquet(path),
        schemas.EVENT_KEY,
        time="timestamp",
    )
    batch = events(spark, ("a", "10:00:00", 9), ("b", "10:05:00", 2), ("b", "10:05:00", 2), ("a", "11:00:00", 3))
    for _ in range(2):
        sink(batch, "q", 0)
    sink(batch.limit(0), "q", 1)
    stored = spark.read.schema(EVENT).parquet(path)
    assert rows_of(stored.select("id", "valor")) == [("a", 1.0), ("a", 3.0), ("b", 2.0)]


def test_stored_rows_are_narrowed_by_value_filters(spark, tmp_path):
    path = str(tmp_path / "t")
    events(spark, ("a", "10:00:00", 1)).write.parquet(path)
    narrowed = database.within_batch_times(
        spark.read.parquet(path), events(spark, ("b", "09:00:00", 1)), "timestamp"
    )
    pushed = next(line for line in plan_of(narrowed).splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(timestamp,2024-01-01" in pushed and "LessThanOrEqual(timestamp" in pushed


def test_send_counts_the_published_messages(spark, tmp_path):
    path = str(tmp_path / "m")
    rows = events(spark, ("a", "10:00:00", 1), ("b", "10:00:00", 1))
    publish = lambda m: m.write.mode("append").parquet(path)
    assert sync.send(rows, "lead", publish) == 2
    assert sync.send(rows.limit(0), "lead", publish) == 0
    kinds = payload.detect(payload.decode(spark.read.parquet(path)))
    assert [r.tipo_evento for r in kinds.collect()] == ["lead", "lead"]


def from_files(monkeypatch, spark, folder):
    def stream(session, fmt, options):
        assert fmt == "kafka" and options["subscribe"] == "eventos"
        return session.readStream.schema("value binary").parquet(folder)

    monkeypatch.setattr(run, "message_stream", stream)


LEAD = {"tipo_evento": "lead", "id": "l1", "nome": "Ana", "email": "a@x", "created_at": "2024-01-01T10:00:00"}


def test_both_jobs_share_a_store(spark, tmp_path, monkeypatch):
    """Each message is stored once; a lead keeps its newest version."""
    folder, store = str(tmp_path / "in"), str(tmp_path / "store")
    versions_of = [
        LEAD | {"status_lead": "novo", "updated_at": "2024-01-02T10:00:00"},
        LEAD | {"status_lead": "convertido", "updated_at": "2024-01-03T10:00:00"},
        LEAD | {"status_lead": "perdido", "updated_at": "2024-01-01T10:00:00"},
        {"tipo_evento": "chat_session", "id": "s1", "lead_id": "l1"},
        {"tipo_evento": "outro"},
    ]
    rows = events(spark, ("a", "10:00:00", 1), ("b", "10:30:00", 2)).selectExpr(
        "*", "'u' AS usuario", "'login' AS evento", "'ecommerce' AS categoria"
    )
    texts = [(json.dumps(m),) for m in versions_of] + [("no json",)]
    others = spark.createDataFrame(texts, "value string").select(F.col("value").cast("binary"))
    payload.to_messages(rows).unionByName(others).write.parquet(folder)
    from_files(monkeypatch, spark, folder)
    for job in ("events", "router", "events", "router"):
        arguments = [job, "--servers", "b:9092", "--checkpoints", str(tmp_path / "cp"), "--store", store, "--once"]
        queries = run.start(spark, run.arguments(arguments))
        assert len(queries) == {"events": 2, "router": 1}[job]
        for query in queries:
            query.awaitTermination()
    stored = files.table_rows(spark, f"{store}/eventos_raw", schemas.EVENT)
    assert rows_of(stored.select("id")) == [("a",), ("b",)]
    closed = files.table_rows(spark, f"{store}/eventos_agregados", "janela_inicio timestamp, total_eventos bigint")
    assert closed.count() == 5 and {r.total_eventos for r in closed.collect()} == {1}
    leads = versions.table_rows(spark, f"{store}/leads", "id string, status_lead string")
    assert rows_of(leads) == [("l1", "convertido")]
    assert versions.table_rows(spark, f"{store}/chat_sessions", "id string").count() == 1
    lost = {j: files.table_rows(spark, f"{store}/quarentena/{j}", "json_data string").count() for j in ("events", "router")}
    assert lost == {"events": 1, "router": 0}
    assert files.table_rows(spark, f"{store}/desconhecidos", "tipo_evento string").count() == 1


def test_a_failed_query_is_raised_by_its_job(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "in")
    spark.createDataFrame([(json.dumps(LEAD),)], "value string").select(F.col("value").cast("binary")).write.parquet(folder)
    from_files(monkeypatch, spark, folder)
    monkeypatch.setattr(run.versions, "upsert_sink", lambda *a: lambda *b: 1 / 0)
    given = run.arguments(["router", "--servers", "b", "--checkpoints", str(tmp_path / "cp"), "--store", str(tmp_path / "s"), "--once"])
    with pytest.raises(Exception, match="not written"):
        for query in run.start(spark, given):
            query.awaitTermination()


def test_the_router_updates_a_database_by_key_only(spark):
    base = ["router", "--servers", "b", "--checkpoints", "c", "--store", "s"]
    with pytest.raises(SystemExit):
        run.arguments([*base, "--jdbc", "jdbc:x"])
    given = run.arguments([*base, "--connect", "os:getcwd"])
    assert callable(run.changing_sink(spark, given, "leads"))


def test_database_sinks_are_chosen_by_argument(spark):
    base = ["events", "--servers", "b", "--checkpoints", "c", "--store", "s"]
    given = run.arguments([*base, "--jdbc", "jdbc:x", "--jdbc-option", "user=u", "--documents", "es:9200"])
    assert callable(run.table_sink(spark, given, run.WINDOW_TABLE))
    assert callable(run.document_sink(given))


def test_a_repeated_email_and_an_early_session_do_not_stop_the_router(spark, tmp_path, monkeypatch):
    folder, store = str(tmp_path / "in"), str(tmp_path / "store")
    from_files(monkeypatch, spark, folder)

    def deliver(*rows):
        texts = spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")
        texts.select(F.col("value").cast("binary")).write.mode("append").parquet(folder)
        arguments = ["router", "--servers", "b", "--checkpoints", str(tmp_path / "cp"), "--store", store, "--once"]
        for query in run.start(spark, run.arguments(arguments)):
            query.awaitTermination()

    def ids(name):
        return rows_of(versions.table_rows(spark, f"{store}/{name}", "id string"))

    session = {"tipo_evento": "chat_session", "id": "s1", "lead_id": "l9", "started_at": "2024-01-01T10:00:00"}
    deliver(LEAD, session, session | {"id": "s2", "lead_id": "l1"}, session | {"id": "s3", "lead_id": None})
    assert ids("leads") == [("l1",)] and ids("chat_sessions") == [("s2",), ("s3",)]
    deliver(LEAD | {"id": "l2"}, LEAD | {"id": "l9", "email": "b@x"})
    assert ids("leads") == [("l1",), ("l9",)] and ids("chat_sessions") == [("s1",), ("s2",), ("s3",)]
    refused = files.table_rows(spark, f"{store}/quarentena/email", "id string, violations array<string>")
    assert [(r.id, r.violations) for r in refused.collect()] == [("l2", ["unique_email"])]
