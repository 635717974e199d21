"""Views kept up to date from partial aggregates by day, so that they do not read the history.

A batch changes rows of few days. The partials of just these days are made anew from the stored rows of these days and
replace the old ones (``versions.replace_parts``): sessions that are updated or repeated count once, as in the view over all rows.
On reading, the partials of all days are merged: one row per day and lead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivermark import schemas
from rivermark.functions.numbers import percent
from rivermark.functions.times import AsOf, cutoff, fractional_days, recent
from rivermark.plans.leads import SUMMARY_COLUMNS
from rivermark.sinks import versions

SESSION_PARTS = "lead_id string, sessoes bigint, ativas bigint"
LEAD_PARTS = "leads bigint, qualificados bigint"
Sink = Callable[[DataFrame, str, int], None]


def session_partials(sessions: DataFrame, period: str = "yyyy-MM-dd") -> DataFrame:
    day = versions.part_of("started_at", period).alias("dia")
    return sessions.groupBy(day, "lead_id").agg(
        F.count_distinct("id").alias("sessoes"), F.count_if("is_active").alias("ativas")
    )


def lead_partials(leads: DataFrame, period: str = "yyyy-MM-dd") -> DataFrame:
    day = versions.part_of("created_at", period).alias("dia")
    qualified = F.count_if(F.col("score_qualificacao") >= schemas.QUALIFIED_SCORE)
    return leads.groupBy(day).agg(F.count("*").alias("leads"), qualified.alias("qualificados"))


def kept_partials(
    inner: Sink, table: str, root: str, day: str, partials: Callable[[DataFrame, str], DataFrame], period: str = "yyyy-MM-dd"
) -> Sink:
    """Writes a batch to the table by ``inner``, then the partials of the days it touched to ``root``.

    Both pass over a batch they have applied, so one that failed between them is completed when it runs again, and one whose
    partials are stored is not read.
    """

    def sink(rows: DataFrame, query_id: str, batch_id: int) -> None:
        spark = rows.sparkSession
        if versions.applied(spark, root, query_id, batch_id):
            return
        batch = rows.persist()
        try:
            days = versions.touched(batch, versions.part_of(day, period))
            inner(batch, query_id, batch_id)
        finally:
            batch.unpersist()
        stored = versions.part_rows(spark, table, rows.schema, days)
        versions.replace_parts(partials(stored, period), root, query_id, batch_id)

    return sink


def stored_partials(spark: SparkSession, root: str, schema: str) -> DataFrame:
    return versions.table_rows(spark, root, schema)


def leads_summary(leads: DataFrame, partials: DataFrame, as_of: AsOf = None) -> DataFrame:
    """``plans.leads.leads_summary`` from the partials of the sessions."""
    per_lead = partials.groupBy("lead_id").agg(F.sum("sessoes").alias("total_sessoes"))
    now = cutoff(leads, "last_interaction_at", as_of, hours=0)
    joined = leads.join(per_lead, leads.id == per_lead.lead_id, "left")
    return joined.select(
        *[leads[c] for c in SUMMARY_COLUMNS],
        F.coalesce("total_sessoes", F.lit(0)).alias("total_sessoes"),
        leads.created_at,
        leads.last_interaction_at,
        fractional_days(now, leads.last_interaction_at).alias("dias_desde_ultima_interacao"),
    )


def dashboard(
    lead_parts: DataFrame, session_parts: DataFrame, leads: DataFrame, as_of: AsOf = None, hours: int = 24
) -> DataFrame:
    """``plans.leads.dashboard`` from partials; of ``leads`` only the last hours' rows are counted."""
    active = session_parts.agg(F.coalesce(F.sum("ativas"), F.lit(0)).alias("n")).scalar()
    last = recent(leads, "created_at", as_of, hours=hours).agg(F.count("*").alias("n")).scalar()
    total = lead_parts.agg(
        F.coalesce(F.sum("leads"), F.lit(0)).alias("total_leads"),
        F.coalesce(F.sum("qualificados"), F.lit(0)).alias("qualified_leads"),
    )
    rate = percent(F.col("qualified_leads"), F.col("total_leads"))
    return total.select(
        "total_leads",
        "qualified_leads",
        F.coalesce(rate, F.lit(0.0)).alias("qualification_rate"),
        active.alias("active_sessions"),
        last.alias("recent_leads_24h"),
    )
