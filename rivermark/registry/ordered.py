"""Ordered results and heads of tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivermark.operators import search
from rivermark.plans import audit, events, leads
from rivermark.registry.base import AMOUNT_SCALE, EVENTOS, LEADS, SESSIONS, SOMA, Data, query
from rivermark.registry.scans import EVENT_SQL, LEAD_COLUMNS, LEAD_SQL


@query(
    "o01_newest_of_category",
    f"""SELECT {EVENT_SQL} FROM eventos WHERE categoria = 'navegacao'
    ORDER BY timestamp DESC, id LIMIT 10""",
    EVENTOS,
)
def newest_of_category(d: Data):
    return events.newest_events(d.events, 10, "navegacao")


@query(
    "o01_newest_processed",
    f"SELECT {EVENT_SQL}, processado_em FROM eventos ORDER BY processado_em DESC, id LIMIT 5",
    EVENTOS,
)
def newest_processed(d: Data):
    return events.newest_events(d.stored, 5, by="processado_em")


@query(
    "o02_newest_leads",
    f"SELECT {LEAD_SQL} FROM leads ORDER BY created_at DESC, id LIMIT 100",
    LEADS,
)
def newest_leads(d: Data):
    return search.newest(d.leads, 100, "created_at").select(*LEAD_COLUMNS)


@query(
    "o03_top_users_by_sum",
    f"""SELECT usuario, {SOMA} AS total_valor FROM eventos GROUP BY usuario
    ORDER BY total_valor DESC, usuario LIMIT 10""",
    EVENTOS,
)
def top_users_by_sum(d: Data):
    return events.top_users(d.events, scale=AMOUNT_SCALE).select("usuario", "total_valor")


@query(
    "o04_qualified_in_order",
    """SELECT id, score_qualificacao, last_interaction_at FROM leads WHERE score_qualificacao >= 50
    ORDER BY score_qualificacao DESC, last_interaction_at DESC, id""",
    LEADS,
)
def qualified_in_order(d: Data):
    return leads.qualified_leads(d.leads).select("id", "score_qualificacao", "last_interaction_at")


@query(
    "o05_sessions_in_order",
    """SELECT id, lead_id, started_at FROM sessions WHERE is_active ORDER BY started_at DESC, id""",
    SESSIONS,
)
def sessions_in_order(d: Data):
    return search.newest(d.active, None, "started_at").select("id", "lead_id", "started_at")


@query(
    "o06_by_status_rank",
    """SELECT id, status_lead,
              CASE status_lead WHEN 'novo' THEN 1 WHEN 'qualificado' THEN 2 WHEN 'em_contato' THEN 3
                   WHEN 'convertido' THEN 4 WHEN 'perdido' THEN 5 ELSE 6 END AS ordem
    FROM leads ORDER BY ordem, id""",
    LEADS,
)
def by_status_rank(d: Data):
    return audit.by_status_rank(d.leads)


@query(
    "o07_inactive_first",
    "SELECT id, lead_id, is_active FROM sessions ORDER BY is_active, id",
    SESSIONS,
)
def inactive_first(d: Data):
    return audit.session_states(d.sessions).select("id", "lead_id", "is_active")


@query(
    "o08_search_head",
    f"SELECT {EVENT_SQL} FROM eventos WHERE valor > 100 ORDER BY timestamp DESC, id LIMIT 5",
    EVENTOS,
)
def search_head(d: Data):
    return search.hits(d.events, 5, above={"valor": F.lit(100)})
