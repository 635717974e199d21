"""Data-quality rules over the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivermark import schemas
from rivermark.operators import keyed, payload, quality
from rivermark.registry.base import EVENTOS, LEADS, SESSIONS, Data, query
from rivermark.session import rocksdb_state, shared_folder
from rivermark.sinks import files, versions
from rivermark.streaming import constraints, jobs, router, sync, waiting
from rivermark.streaming.lookup import Lookup
from rivermark.streaming.router import EVENT_FIELDS


def _mixed_texts(d: Data):
    """Event messages together with chat text, which is no message."""
    written = payload.decode(payload.to_messages(d.events))
    return written.unionByName(d.chat.select(F.col("text").alias("json_data")))


@query("q01_unparsed_messages", "SELECT text AS json_data FROM conversations")
def unparsed_messages(d: Data):
    rows = payload.parse(_mixed_texts(d), schemas.EVENT, keep_raw=True)
    return rows.where(payload.unparsed(EVENT_FIELDS)).select("json_data")


BAD_KIND = "error"


@query(
    "q01_bad_fields",
    f"""SELECT 'eventos' AS tabela, id, 'type_valor' AS regras FROM eventos WHERE evento = '{BAD_KIND}'
    UNION ALL SELECT 'sessions', id, 'type_total_messages,type_is_active' FROM sessions WHERE nivel_interesse = 'alto'""",
    EVENTOS,
    SESSIONS,
)
def bad_fields(d: Data):
    """Events of one kind with a text for a number, sessions of one level with two bad values: just these are refused."""
    value = F.when(F.col("evento") == BAD_KIND, "abc").otherwise(F.col("valor").cast("string"))
    high = F.col("nivel_interesse") == "alto"
    sessions = d.sessions.withColumns(
        {
            "total_messages": F.when(high, "99999999999").otherwise(F.col("total_messages").cast("string")),
            "is_active": F.when(high, "talvez").otherwise(F.col("is_active").cast("string")),
        }
    )
    messages = [
        # a quoted number is no number on the wire, so only the bad values are texts
        payload.to_messages(d.events.where(F.col("evento") != BAD_KIND)),
        payload.to_messages(d.events.where(F.col("evento") == BAD_KIND).withColumn("valor", value)),
        sync.messages(d.sessions.where(~high), schemas.SESSION_TAG),
        sync.messages(sessions.where(high), schemas.SESSION_TAG),
    ]
    texts = payload.decode(reduce(DataFrame.unionByName, messages))
    refused = router.split(texts)["quarantine"]
    found = F.from_json("json_data", "id string, tipo_evento string")
    table = F.when(found["tipo_evento"].isNull(), "eventos").otherwise("sessions")
    return refused.select(table.alias("tabela"), found["id"].alias("id"), F.array_join("violations", ",").alias("regras"))


@query(
    "q07_defaults_only_when_absent",
    """SELECT id, CASE WHEN origem = 'site' THEN 'novo' ELSE status_lead END AS status_lead,
              CASE WHEN origem = 'site' THEN 0 ELSE score_qualificacao END AS score_qualificacao
    FROM leads WHERE origem <> 'chatbot'""",
    LEADS,
)
def defaults_only_when_absent(d: Data):
    """Absent fields take defaults; a score that is no number is refused."""
    leads = d.leads
    parts = [
        sync.messages(leads.where("origem = 'indicacao'"), schemas.LEAD_TAG),
        sync.messages(leads.where("origem = 'site'").drop("status_lead", "score_qualificacao"), schemas.LEAD_TAG),
        sync.messages(leads.where("origem = 'chatbot'").withColumn("score_qualificacao", F.lit("abc")), schemas.LEAD_TAG),
    ]
    rows = router.split(payload.decode(reduce(DataFrame.unionByName, parts)))["leads"]
    return rows.select("id", "status_lead", "score_qualificacao")


@query(
    "q02_required_fields",
    """SELECT 'required_nome' AS regra, count(*) FILTER (nome IS NULL) AS linhas FROM leads
    UNION ALL SELECT 'required_email', count(*) FILTER (email IS NULL) FROM leads
    UNION ALL SELECT 'required_telefone', count(*) FILTER (telefone IS NULL) FROM leads""",
    LEADS,
)
def required_fields(d: Data):
    return quality.violation_counts(d.leads, quality.required("nome", "email", "telefone"))


@query(
    "q03_range",
    "SELECT id, valor, 'range_valor' AS regras FROM eventos WHERE valor NOT BETWEEN 0 AND 100",
    EVENTOS,
)
def value_range(d: Data):
    rows = quality.quarantined(quality.checked(d.events, [quality.in_range("valor", 0, 100)]))
    return rows.select("id", "valor", F.array_join("violations", ",").alias("regras"))


@query("q04_domain", "SELECT id, nivel_interesse FROM sessions WHERE nivel_interesse IN ('baixo', 'medio')", SESSIONS)
def domain(d: Data):
    rows = quality.checked(d.sessions, [quality.in_domain("nivel_interesse", ["baixo", "medio"])])
    return quality.clean(rows).select("id", "nivel_interesse")


REPEATED = "repetidos AS (SELECT * FROM eventos UNION ALL SELECT * FROM eventos WHERE evento = 'purchase')"


@query(
    "q05_repeated_keys",
    "SELECT id, timestamp, count(*) AS linhas FROM repetidos GROUP BY ALL HAVING count(*) > 1",
    EVENTOS,
    REPEATED,
)
def repeated_keys(d: Data):
    again = d.events.unionByName(d.events.where("evento = 'purchase'"))
    return keyed.duplicated(again, schemas.EVENT_KEY)


@query(
    "q05_one_per_user",
    """SELECT id, usuario, timestamp FROM eventos
    QUALIFY row_number() OVER (PARTITION BY usuario ORDER BY timestamp DESC, id DESC) = 1""",
    EVENTOS,
)
def one_per_user(d: Data):
    return keyed.latest(d.events.select("id", "usuario", "timestamp"), ["usuario"], ["timestamp"])


@query(
    "q05_email_routed",
    """SELECT 'leads' AS tabela, id, email FROM leads
    UNION ALL SELECT 'recusados', id || '-de-novo', email FROM leads WHERE origem <> 'chatbot'""",
    LEADS,
)
def email_routed(d: Data):
    """All leads, and some again under another id: within the batch and after it, the first id keeps the e-mail."""
    store = EmailStore(d, "email")
    sink = store.sink()
    leads = d.leads.select(*EmailStore.COLUMNS, "origem")
    again = leads.withColumn("id", F.concat("id", F.lit("-de-novo")))
    sink(leads.unionByName(again.where("origem = 'site'")).select(*store.COLUMNS), "q", 0)
    sink(again.where("origem = 'indicacao'").select(*store.COLUMNS), "q", 1)
    return store.tables()


class EmailStore:
    """Leads with the rule of one lead per e-mail, below a new folder."""

    COLUMNS = ["id", "email", "created_at", "updated_at"]

    def __init__(self, d: Data, name: str):
        self.d, self.root = d, shared_folder(d.spark, name)
        self.leads = versions.upsert_sink(f"{self.root}/leads", schemas.ID_KEY, ["updated_at"], "created_at", "yyyy")
        self.refused = jobs.file_sink(f"{self.root}/recusados")

    def sink(self, wrap=lambda name, sink: sink):
        spark, part = self.d.spark, versions.part_of("created_at", "yyyy")
        stored = lambda rows: versions.part_rows(
            spark, f"{self.root}/leads", rows.schema, versions.touched(rows, part)
        )
        return constraints.unique_sink(
            wrap("leads", self.leads), wrap("recusados", self.refused), f"{self.root}/decisoes",
            Lookup(spark, f"{self.root}/emails", buckets=8), stored, "email", ["updated_at"],
        )

    def tables(self) -> DataFrame:
        stored = versions.table_rows(self.d.spark, f"{self.root}/leads", "id string, email string")
        refused = files.table_rows(self.d.spark, f"{self.root}/recusados", "id string, email string")
        stored = stored.select(F.lit("leads").alias("tabela"), "id", "email")
        return stored.unionByName(refused.select(F.lit("recusados").alias("tabela"), "id", "email"))


def broken_once(broken: str):
    """Makes the named sink fail after its write."""

    def wrap(name, sink):
        def failing(*batch):
            sink(*batch)
            if name == broken:
                raise RuntimeError(f"{name} failed")

        return failing

    return wrap


def run_with_faults(sink_of, names: list[str], rows: DataFrame, query_id: str, batch_id: int) -> None:
    """One batch: a fault after each sink in turn, then a run to its end."""
    for name in names:
        try:
            sink_of(broken_once(name))(rows, query_id, batch_id)
        except RuntimeError as error:
            if str(error) != f"{name} failed":
                raise
    sink_of(lambda name, sink: sink)(rows, query_id, batch_id)


@query(
    "q05_email_replayed",
    """SELECT 'leads' AS tabela, id, CASE origem WHEN 'site' THEN 'novo-' || email ELSE email END AS email FROM leads
    UNION ALL SELECT 'recusados', id || '-cedo', email FROM leads WHERE origem = 'site'
    UNION ALL SELECT 'leads', id || '-depois', email FROM leads WHERE origem = 'site'""",
    LEADS,
)
def email_replayed(d: Data):
    """Leads that change their e-mail, and others that want the old one in the same batch and in the next; every
    batch fails after each of its writes and is run again."""
    store = EmailStore(d, "email-replayed")
    leads = d.leads.select(*store.COLUMNS, "origem")
    site = leads.where("origem = 'site'")
    moved = site.withColumns({"email": F.concat(F.lit("novo-"), "email"), "updated_at": F.expr("updated_at + INTERVAL 1 DAY")})
    other = lambda end: site.withColumn("id", F.concat("id", F.lit(end)))
    for number, batch in enumerate([leads, moved.unionByName(other("-cedo")), other("-depois")]):
        run_with_faults(store.sink, ["recusados", "leads"], batch.select(*store.COLUMNS), "q", number)
    return store.tables()


ORPHANS_SQL = """SELECT s.id, CASE WHEN l.status_lead <> 'perdido' OR l.origem = 'site' THEN 'sessions' ELSE 'espera' END AS tabela
    FROM sessions s JOIN leads l ON l.id = s.lead_id"""


class SessionStore:
    """Sessions with the rule that their lead is stored, below a new folder."""

    def __init__(self, d: Data, name: str):
        self.d, self.root = d, shared_folder(d.spark, name)
        columns = ["id", "lead_id", "started_at", "processado_em"]
        self.rows = d.sessions.withColumn("processado_em", F.col("started_at")).select(*columns)
        self.inner = versions.upsert_sink(f"{self.root}/sessions", schemas.ID_KEY, ["processado_em"], "started_at", "yyyy")

    def sink(self, leads: DataFrame, wrap=lambda name, sink: sink):
        ids = leads.select(F.col("id").alias("valor"))
        return constraints.parent_sink(wrap("sessions", self.inner), f"{self.root}/decisoes", lambda values: ids, "lead_id")

    def tables(self, query_id: str, batch_id: int) -> DataFrame:
        stored = versions.table_rows(self.d.spark, f"{self.root}/sessions", self.rows.schema)
        open_ = constraints.waiting(self.d.spark, f"{self.root}/decisoes", query_id, batch_id, self.rows.schema)
        return stored.select("id", F.lit("sessions").alias("tabela")).unionByName(open_.select("id", F.lit("espera").alias("tabela")))


@query("q06_orphans_routed", ORPHANS_SQL, LEADS, SESSIONS)
def orphans_routed(d: Data):
    """Sessions before some of their leads: they wait, and are stored once their lead is."""
    store, lost = SessionStore(d, "orphans"), F.col("status_lead") == "perdido"
    arrived = [d.leads.where(~lost), d.leads.where(~lost | (F.col("origem") == "site"))]
    for number, leads in enumerate(arrived):
        store.sink(leads)(store.rows if number == 0 else store.rows.limit(0), "q", number)
    return store.tables("q", 1)


@query("q06_orphans_replayed", ORPHANS_SQL, LEADS, SESSIONS)
def orphans_replayed(d: Data):
    """The same where every batch fails after its write and finds more leads when it runs again, and a new
    checkpoint goes on: a session that waited in the first try waits until the next batch, and none is lost."""
    store, lost = SessionStore(d, "orphans-replayed"), F.col("status_lead") == "perdido"
    few, more = d.leads.where(~lost), d.leads.where(~lost | (F.col("origem") == "site"))
    for query_id, first, rows in (("q", few, store.rows), ("r", more, store.rows.limit(0))):
        tries = iter([first, more])
        run_with_faults(lambda wrap: store.sink(next(tries), wrap), ["sessions"], rows, query_id, 0)
    return store.tables("r", 0)


@query("q06_waiting_state", ORPHANS_SQL, LEADS, SESSIONS)
def waiting_state(d: Data):
    """The same by state: sessions and some leads, a stop, then more leads; what waits is read from the checkpoint."""
    root, lost = shared_folder(d.spark, "waiting-state"), F.col("status_lead") == "perdido"
    sessions = d.sessions.select("id", "lead_id", "started_at", "pages_visited")
    leads = [d.leads.where(~lost), d.leads.where(lost & (F.col("origem") == "site"))]
    for number, arrived in enumerate(leads):
        arrived.select("id").write.mode("append").parquet(f"{root}/leads")
        (sessions if number == 0 else sessions.limit(0)).write.mode("append").parquet(f"{root}/entrada")
        children = d.spark.readStream.schema(sessions.schema).parquet(f"{root}/entrada")
        parents = d.spark.readStream.schema("id string").parquet(f"{root}/leads")
        rows = waiting.admitted(children, parents, "lead_id")
        with rocksdb_state(d.spark):
            jobs.replay(jobs.start, rows, "espera", jobs.file_sink(f"{root}/sessions"), f"{root}/checkpoints")
    stored = files.table_rows(d.spark, f"{root}/sessions", "id string, destino string").where("destino = 'aceito'")
    open_ = waiting.still_waiting(d.spark, f"{root}/checkpoints/espera").select("id", F.lit("espera").alias("tabela"))
    return stored.select("id", F.lit("sessions").alias("tabela")).unionByName(open_)


@query(
    "q06_orphans",
    """SELECT id, lead_id FROM sessions
    WHERE lead_id NOT IN (SELECT id FROM leads WHERE status_lead <> 'perdido')""",
    LEADS,
    SESSIONS,
)
def orphans(d: Data):
    kept = d.leads.where("status_lead <> 'perdido'")
    return quality.without_parent(d.sessions, kept, "lead_id").select("id", "lead_id")


@query(
    "q06_cascade",
    """SELECT id, lead_id FROM sessions
    WHERE lead_id NOT IN (SELECT id FROM leads WHERE status_lead = 'perdido')""",
    LEADS,
    SESSIONS,
)
def cascade(d: Data):
    deleted = d.leads.where("status_lead = 'perdido'")
    return quality.surviving(d.sessions, deleted, "lead_id").select("id", "lead_id")


@query(
    "q07_defaults",
    """SELECT id, coalesce(nullif(status_lead, 'perdido'), 'novo') AS status_lead,
              coalesce(nullif(origem, 'site'), 'chatbot') AS origem,
              coalesce(nullif(score_qualificacao, 50), 0) AS score_qualificacao, localizacao
    FROM leads""",
    LEADS,
)
def defaults(d: Data):
    partial = d.leads.withColumns(
        {
            "status_lead": F.nullif("status_lead", F.lit("perdido")),
            "origem": F.nullif("origem", F.lit("site")),
            "score_qualificacao": F.nullif("score_qualificacao", F.lit(50)),
        }
    )
    filled = quality.with_defaults(partial, schemas.LEAD_DEFAULTS)
    return filled.select("id", *[c for c in schemas.LEAD_DEFAULTS])


@query(
    "q08_lengths",
    """SELECT 'length_text' AS regra, count(*) FILTER (length(text) > 255) AS linhas FROM conversations
    UNION ALL SELECT 'length_role', count(*) FILTER (length(role) > 4) FROM conversations""",
)
def lengths(d: Data):
    return quality.violation_counts(d.chat, quality.max_lengths({"text": 255, "role": 4}))


@query(
    "q08_forms",
    """SELECT id, CASE WHEN n % 3 = 0 THEN 'form_id,' ELSE '' END || CASE WHEN n % 400 > 255 THEN 'form_ip_address,' ELSE '' END
              || CASE WHEN n % 5 = 0 THEN 'json_localizacao,' ELSE '' END AS regras
    FROM (SELECT 'sess-' || o_orderkey AS id, o_orderkey AS n FROM orders)""",
)
def forms(d: Data):
    """Ids, addresses and JSON texts made from every session, some of them in a wrong form."""
    n = F.col("o_orderkey")
    digest = F.regexp_replace(F.md5(n.cast("string").cast("binary")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    rows = d.table("orders").select(
        F.concat(F.lit("sess-"), n).alias("sessao"),
        F.when(n % 3 == 0, F.concat(digest, F.lit("0"))).otherwise(digest).alias("id"),
        F.concat(F.lit("10.0."), n % 400, F.lit(".1")).alias("ip_address"),
        F.when(n % 5 == 0, '{"pais":').otherwise('{"pais": "BR"}').alias("localizacao"),
    )
    rules = [
        quality.in_form("id", schemas.UUID_FORM),
        quality.in_form("ip_address", schemas.ADDRESS_FORM),
        quality.json_text("localizacao"),
    ]
    named = F.array_join(F.transform("violations", lambda r: F.concat(r, F.lit(","))), "")
    return quality.checked(rows, rules).select(F.col("sessao").alias("id"), named.alias("regras"))
