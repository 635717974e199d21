"""Record shapes, keys and constraints of the event, lead and session data.

The names, value lists, defaults and limits below are fixed values: they have
to equal the ones producers and stored tables use.
"""

from __future__ import annotations

# Wire schemas, as DDL text for from_json. Lead and session times stay text on
# the wire and are turned into timestamps by operators.payload.typed_times.
EVENT = """
    id string, usuario string, evento string, valor double,
    timestamp timestamp, categoria string
"""

LEAD = """
    id string, nome string, email string, telefone string, nome_empresa string,
    nome_projeto string, localizacao string, interesse array<string>,
    score_qualificacao int, status_lead string, origem string,
    utm_source string, utm_medium string, utm_campaign string,
    created_at string, updated_at string, last_interaction_at string
"""

SESSION = """
    id string, lead_id string, session_token string, user_agent string,
    ip_address string, total_messages int, duration_seconds int,
    pages_visited array<string>, perguntas_feitas array<string>,
    intencao_detectada string, nivel_interesse string,
    started_at string, ended_at string, is_active boolean
"""

LEAD_TIMES = ["created_at", "updated_at", "last_interaction_at"]
SESSION_TIMES = ["started_at", "ended_at"]

# Value of tipo_evento per routed record kind.
LEAD_TAG = "lead"
SESSION_TAG = "chat_session"

EVENT_KEY = ["id", "timestamp"]
WINDOW_KEY = ["janela_inicio", "categoria", "evento"]
ID_KEY = ["id"]

STATUS_DOMAIN = ["novo", "qualificado", "em_contato", "convertido", "perdido"]
INTEREST_DOMAIN = ["baixo", "medio", "alto"]
SCORE_RANGE = (0, 100)
QUALIFIED_SCORE = 50

LEAD_REQUIRED = ["id", "nome", "email"]
SESSION_REQUIRED = ["id"]
EVENT_REQUIRED = ["id", "timestamp"]

# Values taken when a field is absent; times default to the processing time.
LEAD_DEFAULTS = {
    "localizacao": "{}",
    "score_qualificacao": 0,
    "status_lead": "novo",
    "origem": "chatbot",
}
SESSION_DEFAULTS = {
    "total_messages": 0,
    "duration_seconds": 0,
    "nivel_interesse": "baixo",
    "is_active": True,
}
LEAD_TIME_DEFAULTS = ["created_at", "updated_at", "last_interaction_at"]
SESSION_TIME_DEFAULTS = ["started_at"]

EVENT_LENGTHS = {"id": 255, "usuario": 255, "evento": 255, "categoria": 255}
LEAD_LENGTHS = {
    "nome": 255,
    "email": 255,
    "telefone": 20,
    "nome_empresa": 255,
    "nome_projeto": 255,
    "status_lead": 50,
    "origem": 100,
    "utm_source": 100,
    "utm_medium": 100,
    "utm_campaign": 100,
}
SESSION_LENGTHS = {"session_token": 255, "intencao_detectada": 100, "nivel_interesse": 50}

# Forms of texts that the relational tables type.
UUID_FORM = r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
_BYTE = r"(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
ADDRESS_FORM = (
    rf"{_BYTE}(\.{_BYTE}){{3}}(/([0-9]|[12][0-9]|3[0-2]))?"
    r"|(?=.*:)([0-9a-fA-F]{0,4}:){2,7}[0-9a-fA-F]{0,4}(/[0-9]{1,3})?"
)

# Defaults of an event entered by hand.
MANUAL_EVENT_DEFAULTS = {"usuario": "manual_user", "categoria": "teste_manual"}

# Event windows.
WINDOW = "5 minutes"
SLIDE = "1 minute"
LATENESS = "10 minutes"
