"""Messages: written from the tables, decoded, detected, parsed, tagged."""

from __future__ import annotations

from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivermark import schemas
from rivermark.functions.times import iso_text
from rivermark.operators import groups, payload
from rivermark.registry.base import EVENTOS, LEADS, SESSIONS, Data, query, texts
from rivermark.registry.scans import EVENT_COLUMNS, EVENT_SQL
from rivermark.session import shared_folder
from rivermark.streaming import router, sync

MESSAGE_SQL = """'{"id":"' || id || '","usuario":"' || usuario || '","evento":"' || evento || '","valor":'
    || CAST(valor AS VARCHAR) || ',"timestamp":"' || strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f')
    || '","categoria":"' || categoria || '"}'"""
TAGGED_LEADS = """SELECT id, nome, email, telefone, localizacao, array_to_string(interesse, ',') AS interesse,
    score_qualificacao, status_lead, origem, created_at, last_interaction_at"""
LEAD_PARTS = ["id", "nome", "email", "telefone", "localizacao", "interesse", "score_qualificacao",
              "status_lead", "origem", "created_at", "last_interaction_at"]
SESSION_PARTS = ["id", "lead_id", "total_messages", "duration_seconds", "pages_visited",
                 "nivel_interesse", "started_at", "ended_at", "is_active"]
PARSED_SESSIONS = """SELECT id, lead_id, total_messages, duration_seconds,
    array_to_string(pages_visited, ',') AS pages_visited, nivel_interesse, started_at, ended_at, is_active"""


def event_messages(d: Data) -> DataFrame:
    return payload.to_messages(d.events, key="id")


def lead_messages(d: Data) -> DataFrame:
    return sync.messages(d.leads, schemas.LEAD_TAG)


def session_messages(d: Data) -> DataFrame:
    return sync.messages(d.sessions, schemas.SESSION_TAG)


def mixed_messages(d: Data) -> DataFrame:
    """All kinds in one stream: events, leads, sessions, other kinds, plain text."""
    chat = d.chat.select("conv_id", "turn", F.lit("chat_message").alias("tipo_evento"))
    parts = [
        event_messages(d).select("value"),
        lead_messages(d),
        session_messages(d),
        payload.to_messages(chat),
        d.chat.select(F.col("text").cast("binary").alias("value")),
    ]
    return reduce(DataFrame.unionByName, parts)


@query("s03_payload_decode", f"SELECT {MESSAGE_SQL} AS json_data FROM eventos", EVENTOS)
def payload_decode(d: Data):
    return payload.decode(event_messages(d))


@query("k05_keyed_messages", f"SELECT id AS chave, {MESSAGE_SQL} AS texto FROM eventos", EVENTOS)
def keyed_messages(d: Data):
    return event_messages(d).select(
        F.col("key").cast("string").alias("chave"), F.col("value").cast("string").alias("texto")
    )


@query("p01_parsed_events", f"SELECT {EVENT_SQL} FROM eventos", EVENTOS)
def parsed_events(d: Data):
    return payload.parse(payload.decode(event_messages(d)), schemas.EVENT)


@query(
    "p03_detected_kinds",
    """SELECT NULL AS tipo_evento, (SELECT count(*) FROM events) + (SELECT count(*) FROM conversations) AS total
    UNION ALL SELECT 'lead', count(*) FROM customer
    UNION ALL SELECT 'chat_session', count(*) FROM orders
    UNION ALL SELECT 'chat_message', count(*) FROM conversations""",
)
def detected_kinds(d: Data):
    return groups.counts(payload.detect(payload.decode(mixed_messages(d))), "tipo_evento")


@query(
    "p04_routes",
    """SELECT 'events' AS route, (SELECT count(*) FROM events) + (SELECT count(*) FROM conversations) AS total
    UNION ALL SELECT 'leads', count(*) FROM customer
    UNION ALL SELECT 'sessions', count(*) FROM orders
    UNION ALL SELECT 'unknown', count(*) FROM conversations""",
)
def routes(d: Data):
    return groups.counts(router.routed(payload.decode(mixed_messages(d))), "route")


@query("p05_typed_leads", f"{TAGGED_LEADS} FROM leads", LEADS)
def typed_leads(d: Data):
    rows = router.split(payload.decode(mixed_messages(d)))["leads"]
    return texts(rows.select(*LEAD_PARTS), "interesse")


@query("p05_typed_sessions", f"{PARSED_SESSIONS} FROM sessions", SESSIONS)
def typed_sessions(d: Data):
    rows = router.split(payload.decode(mixed_messages(d)))["sessions"]
    return texts(rows.select(*SESSION_PARTS), "pages_visited")


@query(
    "p06_tagged_rows",
    """SELECT id, usuario, evento, valor, timestamp, categoria, 'lead' AS tipo_evento,
              timestamp + INTERVAL 1 SECOND AS processado_em FROM eventos""",
    EVENTOS,
)
def tagged_rows(d: Data):
    moment = F.col("timestamp") + F.expr("INTERVAL 1 SECOND")
    return payload.tagged(d.events, schemas.LEAD_TAG, moment)


@query(
    "k04_published_leads",
    """SELECT id, email, score_qualificacao, strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') AS created_at,
              'lead' AS tipo_evento FROM leads""",
    LEADS,
)
def published_leads(d: Data):
    schema = "id string, email string, score_qualificacao int, created_at string, tipo_evento string"
    return payload.parse(payload.decode(lead_messages(d)), schema)


@query(
    "k04_published_sessions",
    """SELECT id, lead_id, total_messages, is_active, 'chat_session' AS tipo_evento FROM sessions""",
    SESSIONS,
)
def published_sessions(d: Data):
    schema = "id string, lead_id string, total_messages int, is_active boolean, tipo_evento string"
    return payload.parse(payload.decode(session_messages(d)), schema)


@query(
    "k06_manual_events",
    """SELECT 'manual_user' AS usuario, evento, valor, timestamp, 'teste_manual' AS categoria
    FROM eventos""",
    EVENTOS,
)
def manual_events(d: Data):
    return payload.manual_events(d.events.select("evento", "valor", "timestamp")).drop("id")


@query(
    "f03_row_to_json",
    """SELECT '{"id":"' || id || '","quando":"' || strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f') || '","telefone":null}'
        AS texto FROM eventos""",
    EVENTOS,
)
def row_to_json(d: Data):
    rows = d.events.select(
        "id", iso_text("timestamp").alias("quando"), F.lit(None).cast("string").alias("telefone")
    )
    return payload.decode(payload.to_messages(rows)).withColumnRenamed("json_data", "texto")


@query("f02_json_to_struct", f"{PARSED_SESSIONS} FROM sessions", SESSIONS)
def json_to_struct(d: Data):
    rows = payload.parse(payload.decode(session_messages(d)), schemas.SESSION)
    times = {c: F.col(c).cast("timestamp_ntz") for c in schemas.SESSION_TIMES}
    return texts(rows.withColumns(times).select(*SESSION_PARTS), "pages_visited")


@query("p02_processing_time", "SELECT id, true AS depois FROM eventos", EVENTOS)
def processing_time(d: Data):
    """Every event gets a processing time that is not before this run's start."""
    start = datetime.now(UTC)
    rows = payload.events(event_messages(d))
    return rows.select("id", (F.col("processado_em") >= F.lit(start)).alias("depois"))


@query(
    "f17_unique_ids",
    "SELECT evento, count(*) AS linhas, count(*) AS ids, count(*) AS uuids FROM eventos GROUP BY evento",
    EVENTOS,
)
def unique_ids(d: Data):
    """Events entered without an id get one each, in the UUID form."""
    folder = shared_folder(d.spark, "manual")
    payload.manual_events(d.events.drop("id")).write.parquet(folder)
    stored = d.spark.read.parquet(folder)
    form = F.col("id").rlike(f"^{schemas.UUID_FORM}$")
    return stored.groupBy("evento").agg(
        F.count("*").alias("linhas"), F.countDistinct("id").alias("ids"), F.count_if(form).alias("uuids")
    )
