"""Reads: limited scans, counts, lookups, filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivermark import schemas
from rivermark.functions.times import recent
from rivermark.operators import groups, postings, search
from rivermark.plans import audit, events, leads
from rivermark.registry.base import EVENTOS, LEADS, SESSIONS, Data, query
from rivermark.session import shared_folder
from rivermark.sources.tables import stored_keys

LEAD_COLUMNS = ["id", "email", "score_qualificacao", "status_lead", "created_at"]
SESSION_COLUMNS = ["id", "lead_id", "total_messages", "started_at", "is_active"]
EVENT_COLUMNS = ["id", "usuario", "evento", "valor", "timestamp", "categoria"]
LEAD_SQL = ", ".join(LEAD_COLUMNS)
SESSION_SQL = ", ".join(SESSION_COLUMNS)
EVENT_SQL = ", ".join(EVENT_COLUMNS)


@query(
    "s04_recent_leads",
    f"""SELECT {LEAD_SQL} FROM leads
    WHERE created_at >= (SELECT max(created_at) FROM leads) - INTERVAL 24 HOUR
    ORDER BY created_at DESC, id LIMIT 100""",
    LEADS,
)
def recent_leads(d: Data):
    return leads.recent_leads(d.leads, d.as_of(d.leads, "created_at")).select(*LEAD_COLUMNS)


@query(
    "s04_recent_leads_by_status",
    f"""SELECT {LEAD_SQL} FROM leads
    WHERE created_at >= (SELECT max(created_at) FROM leads) - INTERVAL 72 HOUR
      AND status_lead = 'qualificado'
    ORDER BY created_at DESC, id LIMIT 20""",
    LEADS,
)
def recent_leads_by_status(d: Data):
    now = d.as_of(d.leads, "created_at")
    rows = leads.recent_leads(d.leads, now, hours=72, status="qualificado", limit=20)
    return rows.select(*LEAD_COLUMNS)


@query(
    "s05_recent_sessions",
    f"""SELECT {SESSION_SQL} FROM sessions
    WHERE started_at >= (SELECT max(started_at) FROM sessions) - INTERVAL 240 HOUR
      AND total_messages >= 5
    ORDER BY started_at DESC, id LIMIT 50""",
    SESSIONS,
)
def recent_sessions(d: Data):
    now = d.as_of(d.sessions, "started_at")
    rows = leads.recent_sessions(d.sessions, now, hours=240, min_messages=5)
    return rows.select(*SESSION_COLUMNS)


@query(
    "s06_exact_counts",
    """SELECT count(*) AS total, count(*) FILTER (score_qualificacao >= 50) AS qualificados,
              count(*) FILTER (status_lead = 'perdido') AS perdidos
    FROM leads""",
    LEADS,
)
def exact_counts(d: Data):
    return d.leads.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("score_qualificacao") >= schemas.QUALIFIED_SCORE).alias("qualificados"),
        F.count_if(F.col("status_lead") == "perdido").alias("perdidos"),
    )


@query("s07_newest_raw_events", f"SELECT {EVENT_SQL} FROM eventos ORDER BY timestamp DESC, id LIMIT 5", EVENTOS)
def newest_raw_events(d: Data):
    return events.newest_events(d.events)


@query("s08_stored_keys", "SELECT DISTINCT id, timestamp FROM eventos", EVENTOS)
def keys(d: Data):
    return stored_keys(d.events, schemas.EVENT_KEY)


@query(
    "s09_document_lookup",
    f"""SELECT {EVENT_SQL} FROM eventos WHERE categoria = 'ecommerce' AND valor > 200
    ORDER BY timestamp DESC, id LIMIT 5""",
    EVENTOS,
)
def document_lookup(d: Data):
    return search.hits(d.events, 5, equal={"categoria": "ecommerce"}, above={"valor": 200})


@query(
    "s10_labelled_scan",
    """SELECT id, lead_id, is_active, CASE WHEN is_active THEN 'ATIVA' ELSE 'ENCERRADA' END AS estado
    FROM sessions""",
    SESSIONS,
)
def labelled_scan(d: Data):
    return audit.session_states(d.sessions, ordered=False)


@query(
    "s11_last_event_of_user",
    """SELECT id, usuario, evento, valor, categoria FROM eventos WHERE usuario = 'usuario8'
    ORDER BY processado_em DESC, id LIMIT 1""",
    EVENTOS,
)
def last_event_of_user(d: Data):
    return events.last_event_of(d.stored, "usuario8")


@query(
    "p08_relative_time",
    """SELECT id, timestamp FROM eventos
    WHERE timestamp >= (SELECT max(timestamp) FROM eventos) - INTERVAL 7 DAY""",
    EVENTOS,
)
def relative_time(d: Data):
    return recent(d.events, "timestamp", d.as_of(d.events, "timestamp"), days=7).select("id", "timestamp")


@query("p09_equality_filter", f"SELECT {LEAD_SQL} FROM leads WHERE status_lead = 'novo'", LEADS)
def equality_filter(d: Data):
    return search.matching_fields(d.leads, equal={"status_lead": "novo"}).select(*LEAD_COLUMNS)


@query("p10_minimum_filter", f"SELECT {SESSION_SQL} FROM sessions WHERE total_messages >= 15", SESSIONS)
def minimum_filter(d: Data):
    return search.matching_fields(d.sessions, at_least={"total_messages": 15}).select(*SESSION_COLUMNS)


@query("p11_score_threshold", f"SELECT {LEAD_SQL} FROM leads WHERE score_qualificacao >= 50", LEADS)
def score_threshold(d: Data):
    return leads.qualified_leads(d.leads, ordered=False).select(*LEAD_COLUMNS)


@query("p12_boolean_filter", f"SELECT {SESSION_SQL} FROM sessions WHERE is_active", SESSIONS)
def boolean_filter(d: Data):
    return d.active.select(*SESSION_COLUMNS)


@query(
    "p13_lists",
    """SELECT id, status_lead, origem FROM leads
    WHERE status_lead NOT IN ('perdido', 'convertido') AND origem IN ('site', 'chatbot')""",
    LEADS,
)
def lists(d: Data):
    rows = audit.open_leads(d.leads, ["perdido", "convertido"], ["site", "chatbot"])
    return rows.select("id", "status_lead", "origem")


@query("p13_null_tests", "SELECT id, lead_id FROM sessions WHERE ended_at IS NULL", SESSIONS)
def null_tests(d: Data):
    return audit.unfinished_sessions(d.sessions).select("id", "lead_id")


@query(
    "p14_category_and_value",
    """SELECT usuario, evento, valor AS score, timestamp FROM eventos
    WHERE categoria = 'ecommerce' AND valor >= 50""",
    EVENTOS,
)
def category_and_value(d: Data):
    return events.valued_events(d.events, "ecommerce", 50)


@query("p15_user_equality", f"SELECT {EVENT_SQL} FROM eventos WHERE usuario = 'usuario46'", EVENTOS)
def user_equality(d: Data):
    return search.matching_fields(d.events, equal={"usuario": "usuario46"})


ANY_WORD_SQL = r"""SELECT doc_id, lang FROM documents
    WHERE list_has_any(string_split(regexp_replace(lower(text), '[^\p{L}\p{N}_]', ' ', 'g'), ' '), ['él', 'être', 'über'])"""


@query("p15_any_word", ANY_WORD_SQL)
def any_word(d: Data):
    rows = search.matching_fields(d.table("documents"), match={"text": "Él; ÊTRE über"})
    return rows.select("doc_id", "lang")


PHRASE_SQL = r"""SELECT doc_id, lang, source FROM documents
    WHERE regexp_matches(lower(text), '(^|[^\p{L}\p{N}_])für[^\p{L}\p{N}_]+die([^\p{L}\p{N}_]|$)')
       OR regexp_matches(lower(text), '(^|[^\p{L}\p{N}_])of[^\p{L}\p{N}_]+the([^\p{L}\p{N}_]|$)')"""


@query("p16_phrase", PHRASE_SQL)
def phrase(d: Data):
    """Documents that hold either phrase."""
    texts = d.table("documents")
    german = search.matching_fields(texts, phrases={"text": "Für die"})
    english = search.matching_fields(texts, phrases={"text": "of the"})
    rows = german.unionByName(english).select("doc_id", "lang", "source")
    return rows.distinct()


def text_index(d: Data) -> postings.Index:
    """An index of all documents, written in two batches of which one is repeated."""
    root, texts = shared_folder(d.spark, "postings"), d.table("documents")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    for number in (0, 1, 1):
        postings.write_index(texts.where(part == number), root, "q", number, "doc_id", "text")
    return postings.Index(d.spark, root, "doc_id", "bigint")


@query("p15_any_word_indexed", ANY_WORD_SQL)
def any_word_indexed(d: Data):
    keys = text_index(d).any_word("Él; ÊTRE über")
    return postings.found(d.table("documents"), keys, "doc_id").select("doc_id", "lang")


@query("p16_phrase_indexed", PHRASE_SQL)
def phrase_indexed(d: Data):
    index = text_index(d)
    keys = index.phrase("Für die").unionByName(index.phrase("of the")).distinct()
    return postings.found(d.table("documents"), keys, "doc_id").select("doc_id", "lang", "source")


@query(
    "p16_field_search",
    f"""SELECT {EVENT_SQL} FROM eventos
    WHERE evento = 'click' AND valor > 10 AND timestamp BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'
    ORDER BY timestamp DESC, id LIMIT 5""",
    EVENTOS,
)
def field_search(d: Data):
    span = (F.lit("2024-01-10").cast("timestamp_ntz"), F.lit("2024-01-20").cast("timestamp_ntz"))
    return search.hits(
        d.events, 5, equal={"evento": "click"}, above={"valor": 10}, between={"timestamp": span}
    )


@query(
    "p17_combined_conditions",
    f"""SELECT {EVENT_SQL} FROM eventos
    WHERE categoria = 'interacao' AND valor >= 50
      AND timestamp >= (SELECT max(timestamp) FROM eventos) - INTERVAL 7 DAY""",
    EVENTOS,
)
def combined_conditions(d: Data):
    rows = search.matching_fields(d.events, equal={"categoria": "interacao"}, at_least={"valor": 50})
    return recent(rows, "timestamp", d.as_of(d.events, "timestamp"), days=7)


@query(
    "p18_array_membership",
    "SELECT id, array_to_string(interesse, ',') AS interesse FROM leads WHERE list_contains(interesse, 'site')",
    LEADS,
)
def array_membership(d: Data):
    rows = d.leads.where(F.array_contains("interesse", "site"))
    return rows.select("id", F.array_join("interesse", ",").alias("interesse"))


@query(
    "p20_literal_columns",
    """SELECT id, 'ATENCAO' AS severidade, 'lead sem sessao ativa' AS observacao,
              'CONTATAR ' || nome || ' <' || email || '>' AS acao
    FROM leads WHERE id NOT IN (SELECT lead_id FROM sessions WHERE is_active)""",
    LEADS,
    SESSIONS,
)
def literal_columns(d: Data):
    return audit.flagged_leads(d.leads, d.active, "ATENCAO", "lead sem sessao ativa")


@query(
    "p21_qualified_columns",
    """SELECT cs.id, cs.lead_id, cs.started_at, l.nome AS lead_nome, l.email AS lead_email
    FROM sessions cs LEFT JOIN leads l ON l.id = cs.lead_id WHERE cs.is_active""",
    LEADS,
    SESSIONS,
)
def qualified_columns(d: Data):
    rows = leads.active_sessions(d.sessions.select("id", "lead_id", "started_at", "is_active"), d.leads, ordered=False)
    return rows.drop("is_active")


@query("a12_distinct_rows", "SELECT DISTINCT categoria, evento FROM eventos", EVENTOS)
def distinct_rows(d: Data):
    return d.events.select("categoria", "evento").distinct()


@query(
    "a18_events_today",
    """SELECT count(*) AS total FROM eventos
    WHERE timestamp >= date_trunc('day', (SELECT max(timestamp) FROM eventos))""",
    EVENTOS,
)
def events_today(d: Data):
    return events.count_on_day(d.events, d.as_of(d.events, "timestamp"))


@query("a18_leads_by_origin", "SELECT origem, count(*) AS total FROM leads GROUP BY origem", LEADS)
def leads_by_origin(d: Data):
    return groups.counts(d.leads, "origem")


@query("f06_now", f"SELECT {EVENT_SQL} FROM eventos WHERE timestamp >= now()::TIMESTAMP - INTERVAL 36500 DAY", EVENTOS)
def since_now(d: Data):
    """A cut-off by the clock: a century back, so all events."""
    return recent(d.events, "timestamp", days=36500)
