"""Scalar expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivermark.functions import text, times
from rivermark.functions.numbers import percent
from rivermark.registry.base import EVENTOS, LEADS, SESSIONS, Data, query


@query("f01_bytes_to_text", "SELECT conv_id, turn, text AS texto FROM conversations")
def bytes_to_text(d: Data):
    sent = d.chat.withColumn("value", F.col("text").cast("binary"))
    return sent.select("conv_id", "turn", F.col("value").cast("string").alias("texto"))


@query("f04_json_field", "SELECT id, json_extract_string(metadata, '$.k') AS k FROM eventos", EVENTOS)
def json_field(d: Data):
    return d.metadata.select("id", text.json_field("metadata", "k").alias("k"))


@query(
    "f05_numeric_cast",
    """SELECT id, CAST(CAST(json_extract_string(metadata, '$.k') AS DECIMAL(10, 2)) AS DOUBLE) AS k,
              TRY_CAST(evento AS DOUBLE) AS sujo FROM eventos""",
    EVENTOS,
)
def numeric_cast(d: Data):
    k = text.json_field("metadata", "k").cast("decimal(10,2)").cast("double")
    return d.metadata.select("id", k.alias("k"), F.col("evento").try_cast("double").alias("sujo"))


@query(
    "f07_time_bucket",
    """SELECT id, time_bucket(INTERVAL 1 MINUTE, timestamp) - k * INTERVAL 1 MINUTE AS janela_inicio
    FROM eventos, range(5) r(k)""",
    EVENTOS,
)
def time_bucket(d: Data):
    return d.events.select("id", F.window("timestamp", "5 minutes", "1 minute").start.alias("janela_inicio"))


@query(
    "f08_truncated_time",
    """SELECT id, date_trunc('hour', timestamp) AS hora, date_trunc('day', timestamp)::TIMESTAMP AS dia
    FROM eventos""",
    EVENTOS,
)
def truncated_time(d: Data):
    return d.events.select(
        "id",
        F.date_trunc("hour", "timestamp").alias("hora"),
        F.date_trunc("day", "timestamp").alias("dia"),
    )


@query(
    "f09_interval_subtraction",
    "SELECT id, timestamp - INTERVAL 24 HOUR AS antes, timestamp - INTERVAL 7 DAY AS semana FROM eventos",
    EVENTOS,
)
def interval_subtraction(d: Data):
    moment = F.col("timestamp")
    return d.events.select(
        "id",
        (moment - times.interval(hours=24)).alias("antes"),
        (moment - times.interval(days=7)).alias("semana"),
    )


@query(
    "f10_fractional_days",
    """SELECT id, (epoch_us(last_interaction_at) - epoch_us(created_at)) / 1e6::DOUBLE / 86400 AS dias
    FROM leads""",
    LEADS,
)
def fractional_days(d: Data):
    days = times.fractional_days(F.col("last_interaction_at"), F.col("created_at"))
    return d.leads.select("id", days.alias("dias"))


@query(
    "f11_iso_text",
    "SELECT id, strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS texto, timestamp AS lido FROM eventos",
    EVENTOS,
)
def iso_text(d: Data):
    written = d.events.select("id", times.iso_text("timestamp").alias("texto"))
    return written.withColumn("lido", times.parse_iso("texto"))


@query(
    "f12_case",
    """SELECT id, CASE nivel_interesse WHEN 'baixo' THEN 1 WHEN 'medio' THEN 2 ELSE 3 END AS nivel,
              CASE WHEN total_messages > 10 THEN 'longa' ELSE 'curta' END AS tamanho
    FROM sessions""",
    SESSIONS,
)
def case(d: Data):
    level = F.col("nivel_interesse")
    return d.sessions.select(
        "id",
        F.when(level == "baixo", 1).when(level == "medio", 2).otherwise(3).alias("nivel"),
        F.when(F.col("total_messages") > 10, "longa").otherwise("curta").alias("tamanho"),
    )


@query(
    "f13_rounded_share",
    """SELECT id, round(total_messages * 100.0::DOUBLE / nullif(duration_seconds, 0), 2) AS percentual
    FROM sessions""",
    SESSIONS,
)
def rounded_share(d: Data):
    share = percent(F.col("total_messages"), F.col("duration_seconds"))
    return d.sessions.select("id", share.alias("percentual"))


@query("f14_concat", "SELECT id, nome || ' <' || email || '>' AS contato, nome || telefone AS vazio FROM leads", LEADS)
def concat(d: Data):
    return d.leads.select(
        "id",
        F.concat("nome", F.lit(" <"), "email", F.lit(">")).alias("contato"),
        F.concat("nome", "telefone").alias("vazio"),
    )


@query("f15_array_to_text", "SELECT id, array_to_string(interesse, ', ') AS interesse FROM leads", LEADS)
def array_to_text(d: Data):
    return d.leads.select("id", text.joined("interesse").alias("interesse"))


@query("f16_default_value", "SELECT id, coalesce(telefone, 'sem telefone') AS telefone FROM leads", LEADS)
def default_value(d: Data):
    return d.leads.select("id", F.coalesce("telefone", F.lit("sem telefone")).alias("telefone"))


@query(
    "f18_text_parts",
    """SELECT id, substring(nome, 10) AS numero, replace(email, '@example.com', '') AS conta,
              contains(lower(nome_empresa), 'house') AS casa, left(nome, 8) AS inicio
    FROM leads""",
    LEADS,
)
def text_parts(d: Data):
    return d.leads.select(
        "id",
        text.without_prefix("nome", "Customer#").alias("numero"),
        F.regexp_replace("email", "@example[.]com$", "").alias("conta"),
        text.contains_text("nome_empresa", "House").alias("casa"),
        F.substring("nome", 1, 8).alias("inicio"),
    )
