"""Joins of leads and sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivermark import schemas
from rivermark.operators import keyed
from rivermark.plans import incremental, leads
from rivermark.registry.base import EVENTOS, LEADS, SESSIONS, Data, query, texts
from rivermark.registry.grouped import DASHBOARD_SQL
from rivermark.session import shared_folder
from rivermark.sinks import versions


SUMMARY_SQL = """SELECT l.id, l.nome, l.email, l.telefone, l.nome_empresa, l.score_qualificacao, l.status_lead,
              array_to_string(l.interesse, ',') AS interesse, count(DISTINCT cs.id) AS total_sessoes,
              l.created_at, l.last_interaction_at,
              (epoch_us((SELECT max(last_interaction_at) FROM leads)) - epoch_us(l.last_interaction_at))
                  / 1e6::DOUBLE / 86400 AS dias_desde_ultima_interacao
    FROM leads l LEFT JOIN sessions cs ON cs.lead_id = l.id GROUP BY ALL"""


@query("j01_leads_summary", SUMMARY_SQL, LEADS, SESSIONS)
def leads_summary(d: Data):
    now = d.as_of(d.leads, "last_interaction_at")
    return texts(leads.leads_summary(d.leads, d.sessions, now), "interesse")


class KeptViews:
    """Leads and sessions written in three batches, of which two touch the same days, with the partials of both."""

    def __init__(self, d: Data):
        self.d, self.root = d, shared_folder(d.spark, "kept-views")
        sessions = d.sessions.withColumn("processado_em", F.col("started_at"))
        self.shapes = {"leads": d.leads.schema, "sessions": sessions.schema}
        kinds = {
            "leads": (d.leads, ["updated_at"], "created_at", incremental.lead_partials, "yyyy-MM"),
            "sessions": (sessions, ["processado_em"], "started_at", incremental.session_partials, "yyyy"),
        }
        for name, (rows, order, day, partials, period) in kinds.items():
            inner = versions.upsert_sink(f"{self.root}/{name}", schemas.ID_KEY, order, day, period)
            sink = incremental.kept_partials(inner, f"{self.root}/{name}", f"{self.root}/parciais/{name}", day, partials, period)
            part = F.pmod(F.xxhash64("id"), F.lit(4))
            for number, numbers in enumerate([(0, 1), (1, 2), (2, 3)]):  # some rows come twice
                for _ in range(2 - number % 2):  # and batches too
                    sink(rows.where(part.isin(*numbers)), "q", number)

    def partials(self, name: str, schema: str) -> DataFrame:
        return incremental.stored_partials(self.d.spark, f"{self.root}/parciais/{name}", schema)

    def leads(self) -> DataFrame:
        return versions.table_rows(self.d.spark, f"{self.root}/leads", self.shapes["leads"])


@query("j01_incremental", SUMMARY_SQL, LEADS, SESSIONS)
def leads_summary_kept(d: Data):
    views = KeptViews(d)
    now = d.as_of(d.leads, "last_interaction_at")
    rows = incremental.leads_summary(views.leads(), views.partials("sessions", incremental.SESSION_PARTS), now)
    return texts(rows, "interesse")


@query("a13_incremental", DASHBOARD_SQL, LEADS, SESSIONS)
def dashboard_kept(d: Data):
    views = KeptViews(d)
    parts = views.partials("leads", incremental.LEAD_PARTS), views.partials("sessions", incremental.SESSION_PARTS)
    return incremental.dashboard(*parts, views.leads(), d.as_of(d.leads, "created_at"))


@query(
    "j02_active_sessions",
    """SELECT cs.id, cs.lead_id, cs.total_messages, cs.duration_seconds,
              array_to_string(cs.pages_visited, ',') AS pages_visited, cs.nivel_interesse,
              cs.started_at, cs.ended_at, cs.is_active, l.nome AS lead_nome, l.email AS lead_email
    FROM sessions cs LEFT JOIN leads l ON l.id = cs.lead_id WHERE cs.is_active""",
    LEADS,
    SESSIONS,
)
def active_sessions(d: Data):
    unused = ["session_token", "user_agent", "ip_address", "perguntas_feitas", "intencao_detectada"]
    rows = leads.active_sessions(d.sessions, d.leads).drop(*unused)
    return texts(rows, "pages_visited")


@query(
    "j03_leads_without_session",
    """SELECT l.id, l.nome FROM leads l LEFT JOIN sessions s ON s.lead_id = l.id AND s.is_active
    WHERE s.id IS NULL GROUP BY l.id, l.nome""",
    LEADS,
    SESSIONS,
)
def leads_without_session(d: Data):
    return leads.without_session(d.leads, d.active).select("id", "nome")


@query(
    "j05_anti_join",
    "SELECT id, timestamp FROM eventos WHERE id NOT IN (SELECT id FROM eventos WHERE valor >= 25)",
    EVENTOS,
)
def anti_join(d: Data):
    return keyed.missing(d.events.select("id", "timestamp"), d.events.where("valor >= 25"), ["id"])


@query(
    "j06_semi_join",
    "SELECT id, nome FROM leads WHERE id IN (SELECT lead_id FROM sessions WHERE is_active)",
    LEADS,
    SESSIONS,
)
def semi_join(d: Data):
    return leads.with_session(d.leads, d.active).select("id", "nome")
