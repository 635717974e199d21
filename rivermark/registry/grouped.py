"""Windows, summaries, shares and histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivermark.operators import checksums, groups, keyed, windows
from rivermark.plans import audit, events, leads
from rivermark.registry.base import (
    AMOUNT_SCALE,
    EVENTOS,
    JANELAS,
    LEADS,
    MEDIA,
    SESSIONS,
    SOMA,
    Data,
    query,
)

LAST_DAY = "timestamp >= (SELECT max(timestamp) FROM eventos) - INTERVAL 24 HOUR"
LAST_WEEK = "timestamp >= (SELECT max(timestamp) FROM eventos) - INTERVAL 7 DAY"


@query("a01_sliding_window", "SELECT * FROM janelas", EVENTOS, JANELAS)
def sliding_window(d: Data):
    return windows.sliding_stats_by_panes(d.events, scale=AMOUNT_SCALE)


@query("a01_sliding_window_one_pass", "SELECT * FROM janelas", EVENTOS, JANELAS)
def sliding_window_one_pass(d: Data):
    return windows.sliding_stats(d.events, scale=AMOUNT_SCALE)


@query(
    "p07_window_columns",
    "SELECT janela_inicio, janela_fim, sum(total_eventos)::BIGINT AS total FROM janelas GROUP BY ALL",
    EVENTOS,
    JANELAS,
)
def window_columns(d: Data):
    stats = windows.sliding_stats_by_panes(d.events, scale=AMOUNT_SCALE)
    return stats.groupBy("janela_inicio", "janela_fim").agg(F.sum("total_eventos").alias("total"))


@query(
    "a02_last_day_summary",
    f"""SELECT categoria, evento, count(*) AS total_eventos, {MEDIA} AS valor_medio,
              {SOMA} AS valor_total, min(timestamp) AS primeira_ocorrencia,
              max(timestamp) AS ultima_ocorrencia
    FROM eventos WHERE {LAST_DAY} GROUP BY categoria, evento""",
    EVENTOS,
)
def last_day_summary(d: Data):
    return events.last_day_summary(d.events, d.as_of(d.events, "timestamp"), scale=AMOUNT_SCALE)


@query(
    "a03_hourly_by_category",
    f"""SELECT date_trunc('hour', timestamp) AS hora, categoria, count(*) AS total_eventos,
              {MEDIA} AS valor_medio
    FROM eventos WHERE {LAST_WEEK} GROUP BY ALL""",
    EVENTOS,
)
def hourly_by_category(d: Data):
    return events.hourly_by_category(d.events, d.as_of(d.events, "timestamp"), scale=AMOUNT_SCALE)


@query(
    "a04_sessions_per_lead",
    "SELECT lead_id, count(DISTINCT id) AS total_sessoes FROM sessions GROUP BY lead_id",
    SESSIONS,
)
def sessions_per_lead(d: Data):
    return leads.sessions_per_lead(d.sessions)


@query("a05_events_by_category", "SELECT categoria, count(*) AS total FROM eventos GROUP BY categoria", EVENTOS)
def events_by_category(d: Data):
    return events.by_category(d.events)


@query(
    "a06_recent_by_category",
    f"SELECT categoria, count(*) AS total FROM eventos WHERE {LAST_DAY} GROUP BY categoria",
    EVENTOS,
)
def recent_by_category(d: Data):
    return events.recent_by_category(d.events, d.as_of(d.events, "timestamp"))


@query(
    "a07_top_users",
    f"""SELECT usuario, {SOMA} AS total_valor, count(*) AS eventos FROM eventos
    GROUP BY usuario ORDER BY total_valor DESC, usuario LIMIT 10""",
    EVENTOS,
)
def top_users(d: Data):
    return events.top_users(d.events, scale=AMOUNT_SCALE)


@query(
    "a08_sync_summary",
    """SELECT count(*) AS total_found, max(coalesce(score_qualificacao, 0)) AS highest_score,
              avg(coalesce(score_qualificacao, 0)) AS average_score
    FROM (SELECT * FROM leads WHERE created_at >= (SELECT max(created_at) FROM leads) - INTERVAL 24 HOUR
          ORDER BY created_at DESC, id LIMIT 100)""",
    LEADS,
)
def sync_summary(d: Data):
    return leads.sync_summary(leads.recent_leads(d.leads, d.as_of(d.leads, "created_at")))


@query(
    "a09_status_breakdown",
    """SELECT coalesce(nullif(status_lead, 'perdido'), 'unknown') AS status_lead, count(*) AS total
    FROM leads GROUP BY ALL""",
    LEADS,
)
def status_breakdown(d: Data):
    known = d.leads.withColumn("status_lead", F.nullif("status_lead", F.lit("perdido")))
    return leads.status_breakdown(known)


COVERED = "id IN (SELECT lead_id FROM sessions WHERE is_active)"


@query(
    "a10_session_coverage",
    f"""SELECT count(*) FILTER ({COVERED}) AS com, count(*) FILTER (NOT ({COVERED})) AS sem,
              count(*) AS total,
              round(count(*) FILTER ({COVERED}) * 100.0::DOUBLE / count(*), 2) AS percentual
    FROM leads""",
    LEADS,
    SESSIONS,
)
def session_coverage(d: Data):
    return audit.session_coverage(d.leads, d.active)


@query(
    "a11_events_listed",
    """SELECT categoria, string_agg(DISTINCT evento, ', ' ORDER BY evento) AS eventos
    FROM eventos GROUP BY categoria""",
    EVENTOS,
)
def events_listed(d: Data):
    return audit.events_listed(d.events)


DASHBOARD_SQL = """SELECT count(*) AS total_leads, count(*) FILTER (score_qualificacao >= 50) AS qualified_leads,
              coalesce(round(count(*) FILTER (score_qualificacao >= 50) * 100.0::DOUBLE / count(*), 2), 0)
                  AS qualification_rate,
              (SELECT count(*) FROM sessions WHERE is_active) AS active_sessions,
              count(*) FILTER (created_at >= (SELECT max(created_at) FROM leads) - INTERVAL 24 HOUR)
                  AS recent_leads_24h
    FROM leads"""


@query("a13_dashboard", DASHBOARD_SQL, LEADS, SESSIONS)
def dashboard(d: Data):
    return leads.dashboard(d.leads, d.sessions, d.as_of(d.leads, "created_at"))


@query(
    "a14_by_metadata_field",
    f"""SELECT json_extract_string(metadata, '$.k') AS status, count(*) AS total, {MEDIA} AS score_medio
    FROM eventos GROUP BY ALL""",
    EVENTOS,
)
def by_metadata_field(d: Data):
    return events.by_metadata(d.metadata, "k", scale=AMOUNT_SCALE)


@query(
    "a15_metadata_terms",
    """SELECT json_extract_string(metadata, '$.k') AS termo, count(*) AS total
    FROM eventos GROUP BY ALL ORDER BY total DESC, termo LIMIT 10""",
    EVENTOS,
)
def metadata_terms(d: Data):
    return events.metadata_terms(d.metadata, "k")


@query(
    "a16_daily_histogram",
    """SELECT date_trunc('day', timestamp)::TIMESTAMP AS periodo, count(*) AS total
    FROM eventos WHERE categoria = 'ecommerce' AND valor >= 50 GROUP BY ALL""",
    EVENTOS,
)
def daily_histogram(d: Data):
    chosen = d.events.where((F.col("categoria") == "ecommerce") & (F.col("valor") >= 50))
    return events.daily_histogram(chosen)


@query(
    "a16_daily_histogram_with_empty_days",
    """SELECT dia AS periodo, count(started_at) AS total
    FROM (SELECT unnest(generate_series(date_trunc('day', min(started_at))::TIMESTAMP,
                 date_trunc('day', max(started_at))::TIMESTAMP, INTERVAL 1 DAY)) AS dia
          FROM sessions)
    LEFT JOIN sessions ON date_trunc('day', started_at) = dia
    GROUP BY ALL""",
    SESSIONS,
)
def daily_histogram_with_empty_days(d: Data):
    return groups.with_empty_days(groups.by_time(d.sessions, "day", time="started_at"))


@query(
    "a17_category_by_hour",
    "SELECT date_trunc('hour', timestamp) AS periodo, categoria, count(*) AS total FROM eventos GROUP BY ALL",
    EVENTOS,
)
def category_by_hour(d: Data):
    return events.category_by_hour(d.events)


CATEGORIES = ["autenticacao", "ecommerce", "interacao", "navegacao"]


@query(
    "a17_category_matrix",
    "SELECT date_trunc('day', timestamp)::TIMESTAMP AS periodo, "
    + ", ".join(f"nullif(count(*) FILTER (categoria = '{c}'), 0) AS {c}" for c in CATEGORIES)
    + " FROM eventos GROUP BY ALL",
    EVENTOS,
)
def category_matrix(d: Data):
    return groups.matrix(d.events, "categoria", "day", CATEGORIES)


@query(
    "a19_reconciliation",
    """SELECT 'tabela' AS destino, count(*) AS linhas,
              count(*) FILTER (false) AS chaves_ausentes FROM eventos
    UNION ALL
    SELECT 'documentos', count(*) FILTER (valor >= 5), count(*) FILTER (valor < 5) FROM eventos""",
    EVENTOS,
)
def reconciliation(d: Data):
    documents = d.events.where(F.col("valor") >= 5)
    return keyed.reconcile(d.events, documents, ["id"], ("tabela", "documentos"))


CHECKED = ["id", "usuario", "evento", "valor", "timestamp"]


@query(
    "a19_by_checksum",
    """SELECT id, CASE WHEN valor < 5 THEN 'ausente' ELSE 'diferente' END AS estado FROM eventos
    WHERE valor < 5 OR (evento = 'error' AND valor < 50)
    UNION ALL SELECT id || '-novo', 'excedente' FROM eventos WHERE evento = 'signup'""",
    EVENTOS,
)
def by_checksum(d: Data):
    """A copy with rows missing, changed and in excess; only buckets with other sums are compared by key."""
    rows = d.events.select(*CHECKED)
    wrong = (F.col("evento") == "error") & (F.col("valor") < 50)
    value = F.when(wrong, F.col("valor") + 1).otherwise(F.col("valor"))
    copy = rows.where("valor >= 5 OR valor IS NULL").withColumn("valor", value)
    extra = rows.where("evento = 'signup'").withColumn("id", F.concat("id", F.lit("-novo")))
    return checksums.differences(rows, copy.unionByName(extra), ["id"], CHECKED)


@query(
    "t12_changed_rows",
    "SELECT id, status_lead FROM leads WHERE origem = 'site' OR status_lead = 'novo'",
    LEADS,
)
def changed_rows(d: Data):
    """Leads the sink lacks, and those it holds in an older state; a scan by creation time would not find these."""
    leads = d.leads.select("id", "status_lead", "email")
    old = F.when(F.col("status_lead") == "novo", "antigo").otherwise(F.col("status_lead"))
    sent = d.leads.where("origem <> 'site'").select("id", old.alias("status_lead"), "email")
    return checksums.to_send(leads, sent, ["id"]).select("id", "status_lead")


FINDINGS_SQL = """SELECT *,
       CASE WHEN leads_sem_sessao > 0 THEN 'ATENCAO: ' || leads_sem_sessao || ' lead(s) sem sessao'
            ELSE 'OK: todo lead tem sessao' END AS sessao_status,
       CASE WHEN sessoes_orfas > 0 THEN 'CRITICO: ' || sessoes_orfas || ' sessao(oes) sem lead'
            ELSE 'OK: toda sessao tem lead' END AS orfas_status,
       CASE WHEN scores_invalidos > 0 THEN 'CRITICO: ' || scores_invalidos || ' score(s) fora da faixa'
            ELSE 'OK: scores na faixa' END AS score_status
    FROM (SELECT (SELECT count(*) FROM remaining WHERE id NOT IN (SELECT lead_id FROM sessions WHERE is_active))
                     AS leads_sem_sessao,
                 (SELECT count(*) FROM sessions WHERE is_active AND lead_id NOT IN (SELECT id FROM remaining))
                     AS sessoes_orfas,
                 (SELECT count(*) FROM remaining WHERE score_qualificacao NOT BETWEEN 0 AND 100)
                     AS scores_invalidos)"""
REMAINING = "remaining AS (SELECT * FROM leads WHERE status_lead <> 'perdido')"


@query("a20_finding_labels", FINDINGS_SQL, LEADS, SESSIONS, REMAINING)
def finding_labels(d: Data):
    return audit.findings(d.leads.where(F.col("status_lead") != "perdido"), d.active)


@query(
    "j04_one_row_counts",
    f"SELECT leads_sem_sessao, sessoes_orfas, scores_invalidos FROM ({FINDINGS_SQL})",
    LEADS,
    SESSIONS,
    REMAINING,
)
def one_row_counts(d: Data):
    found = audit.findings(d.leads.where(F.col("status_lead") != "perdido"), d.active)
    return found.select("leads_sem_sessao", "sessoes_orfas", "scores_invalidos")
