"""Coverage checks over leads and sessions: labels, shares, findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivermark import schemas
from rivermark.operators import groups
from rivermark.operators.quality import in_range, without_parent
from rivermark.plans.leads import without_session


def status_rank() -> Column:
    """Position of a lead's status in the sales course; unknown ones last."""
    rank = F.lit(len(schemas.STATUS_DOMAIN) + 1)
    for place, status in reversed(list(enumerate(schemas.STATUS_DOMAIN, start=1))):
        rank = F.when(F.col("status_lead") == status, place).otherwise(rank)
    return rank


def by_status_rank(leads: DataFrame) -> DataFrame:
    rows = leads.select("id", "status_lead", status_rank().alias("ordem"))
    return rows.orderBy("ordem", "id")


def session_states(sessions: DataFrame, ordered: bool = True) -> DataFrame:
    """Each session with a label for its state, inactive ones first."""
    state = F.when(F.col("is_active"), "ATIVA").otherwise("ENCERRADA")
    rows = sessions.select("id", "lead_id", "is_active", state.alias("estado"))
    return rows.orderBy("is_active", "id") if ordered else rows


def open_leads(leads: DataFrame, closed: list[str], origins: list[str]) -> DataFrame:
    """Leads not in a closed status that came from one of the origins."""
    return leads.where(~F.col("status_lead").isin(closed) & F.col("origem").isin(origins))


def unfinished_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.where(F.col("ended_at").isNull())


def flagged_leads(leads: DataFrame, sessions: DataFrame, severity: str, note: str) -> DataFrame:
    """Leads without a session, with constant severity, note and action text."""
    action = F.concat(F.lit("CONTATAR "), "nome", F.lit(" <"), "email", F.lit(">"))
    return without_session(leads, sessions).select(
        "id",
        F.lit(severity).alias("severidade"),
        F.lit(note).alias("observacao"),
        action.alias("acao"),
    )


def session_coverage(leads: DataFrame, sessions: DataFrame) -> DataFrame:
    """One row: leads with and without a session, all, percentage with one."""
    having = sessions.select(F.col("lead_id").alias("having")).distinct()
    marked = leads.select("id").join(having, F.col("id") == F.col("having"), "left")
    return groups.share(marked, F.col("having").isNotNull())


def events_listed(events: DataFrame) -> DataFrame:
    """The event names seen in each category, as one text."""
    return groups.value_list(events, "categoria", "evento", "eventos")


def _label(count: Column, level: str, what: str, fine: str) -> Column:
    found = F.concat(F.lit(f"{level}: "), count.cast("string"), F.lit(f" {what}"))
    return F.when(count > 0, found).otherwise(F.lit(f"OK: {fine}"))


def findings(leads: DataFrame, sessions: DataFrame) -> DataFrame:
    """One row with three counts and a label for each.

    The score check reads the leads once; the other two counts are scalar
    subqueries over anti joins, so no frames are crossed.
    """
    idle = without_session(leads.select("id"), sessions).agg(F.count("*").alias("n")).scalar()
    lost = (
        without_parent(sessions.select("id", "lead_id"), leads, "lead_id")
        .agg(F.count("*").alias("n"))
        .scalar()
    )
    broken = in_range("score_qualificacao", *schemas.SCORE_RANGE).broken
    counted = leads.agg(F.count_if(broken).alias("scores_invalidos")).select(
        idle.alias("leads_sem_sessao"), lost.alias("sessoes_orfas"), "scores_invalidos"
    )
    return counted.select(
        "*",
        _label(F.col("leads_sem_sessao"), "ATENCAO", "lead(s) sem sessao", "todo lead tem sessao").alias(
            "sessao_status"
        ),
        _label(F.col("sessoes_orfas"), "CRITICO", "sessao(oes) sem lead", "toda sessao tem lead").alias(
            "orfas_status"
        ),
        _label(F.col("scores_invalidos"), "CRITICO", "score(s) fora da faixa", "scores na faixa").alias(
            "score_status"
        ),
    )
