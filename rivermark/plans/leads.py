"""Reports over leads and their chat sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivermark import schemas
from rivermark.functions.numbers import percent
from rivermark.functions.times import AsOf, cutoff, fractional_days, recent
from rivermark.operators import groups, keyed, search

SUMMARY_COLUMNS = [
    "id",
    "nome",
    "email",
    "telefone",
    "nome_empresa",
    "score_qualificacao",
    "status_lead",
    "interesse",
]


def recent_leads(
    leads: DataFrame,
    as_of: AsOf = None,
    hours: int = 24,
    status: str | None = None,
    limit: int | None = 100,
) -> DataFrame:
    """Leads created in the last hours, newest first."""
    rows = recent(leads, "created_at", as_of, hours=hours)
    if status:
        rows = rows.where(F.col("status_lead") == status)
    return search.newest(rows, limit, "created_at")


def recent_sessions(
    sessions: DataFrame,
    as_of: AsOf = None,
    hours: int = 24,
    min_messages: int = 0,
    limit: int | None = 50,
) -> DataFrame:
    """Sessions started in the last hours, newest first."""
    rows = recent(sessions, "started_at", as_of, hours=hours)
    if min_messages > 0:
        rows = rows.where(F.col("total_messages") >= min_messages)
    return search.newest(rows, limit, "started_at")


def sync_summary(found: DataFrame) -> DataFrame:
    """One row about the scanned leads; zero and null when there are none."""
    score = F.coalesce("score_qualificacao", F.lit(0))
    return found.agg(
        F.count("*").alias("total_found"),
        F.max(score).alias("highest_score"),
        F.avg(score).alias("average_score"),
    )


def status_breakdown(leads: DataFrame) -> DataFrame:
    return groups.breakdown(leads, "status_lead")


def sessions_per_lead(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("lead_id").agg(F.count_distinct("id").alias("total_sessoes"))


def leads_summary(leads: DataFrame, sessions: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Every lead with its number of sessions and days since the last contact.

    Sessions are counted per lead before the join, so a lead with very many
    sessions meets the join as one row and lead columns are shuffled once.
    """
    per_lead = sessions_per_lead(sessions)
    now = cutoff(leads, "last_interaction_at", as_of, hours=0)
    joined = leads.join(per_lead, leads.id == per_lead.lead_id, "left")
    return joined.select(
        *[leads[c] for c in SUMMARY_COLUMNS],
        F.coalesce("total_sessoes", F.lit(0)).alias("total_sessoes"),
        leads.created_at,
        leads.last_interaction_at,
        fractional_days(now, leads.last_interaction_at).alias("dias_desde_ultima_interacao"),
    )


def qualified_leads(
    leads: DataFrame, score: int = schemas.QUALIFIED_SCORE, ordered: bool = True
) -> DataFrame:
    """Leads from a score on, best first, then the latest contact."""
    rows = leads.where(F.col("score_qualificacao") >= score)
    if not ordered:
        return rows
    return rows.orderBy(F.desc("score_qualificacao"), F.desc_nulls_first("last_interaction_at"), "id")


def active_sessions(sessions: DataFrame, leads: DataFrame, ordered: bool = True) -> DataFrame:
    """Active sessions with name and email of their lead, newest first.

    Leads are unique by id, so the join never multiplies rows. A lead that
    holds a large share of the sessions, or many sessions without one, make a
    skewed partition on the session side, which adaptive execution splits.
    """
    contact = leads.select(
        F.col("id").alias("contact_id"),
        F.col("nome").alias("lead_nome"),
        F.col("email").alias("lead_email"),
    )
    active = sessions.where(F.col("is_active"))
    joined = active.join(contact, F.col("lead_id") == F.col("contact_id"), "left")
    rows = joined.select(*sessions.columns, "lead_nome", "lead_email")
    return rows.orderBy(F.desc_nulls_first("started_at"), "id") if ordered else rows


def dashboard(leads: DataFrame, sessions: DataFrame, as_of: AsOf = None, hours: int = 24) -> DataFrame:
    """One row: leads, qualified leads and their rate, active sessions, recent leads.

    One pass over each table; the session count joins as a scalar subquery.
    """
    active = sessions.agg(F.count_if("is_active").alias("n")).scalar()
    since = cutoff(leads, "created_at", as_of, hours=hours)
    counted = leads.select("score_qualificacao", (F.col("created_at") >= since).alias("recent")).agg(
        F.count("*").alias("total_leads"),
        F.count_if(F.col("score_qualificacao") >= schemas.QUALIFIED_SCORE).alias("qualified_leads"),
        F.count_if("recent").alias("recent_leads_24h"),
    )
    rate = percent(F.col("qualified_leads"), F.col("total_leads"))
    return counted.select(
        "total_leads",
        "qualified_leads",
        F.coalesce(rate, F.lit(0.0)).alias("qualification_rate"),
        active.alias("active_sessions"),
        "recent_leads_24h",
    )


def without_session(leads: DataFrame, sessions: DataFrame) -> DataFrame:
    """Leads no given session names."""
    return keyed.missing(leads, sessions.select(F.col("lead_id").alias("id")), ["id"])


def with_session(leads: DataFrame, sessions: DataFrame) -> DataFrame:
    return keyed.matching(leads, sessions.select(F.col("lead_id").alias("id")), ["id"])


def by_origin(leads: DataFrame) -> DataFrame:
    return groups.counts(leads, "origem")
