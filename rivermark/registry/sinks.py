"""Keyed writes, retention, compaction and rebuild."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivermark import schemas
from rivermark.operators import keyed
from rivermark.registry.base import EVENTOS, LEADS, SESSIONS, Data, query
from rivermark.registry.scans import EVENT_COLUMNS, EVENT_SQL
from rivermark.session import shared_folder
from rivermark.sinks import bulk, files, tables, versions
from rivermark.streaming.sync import pending, store_mark, stored_mark

CHANGED_SQL = """CASE WHEN evento = 'purchase' THEN valor * 2 ELSE valor END AS valor,
    CASE WHEN evento = 'purchase' THEN processado_em + INTERVAL 1 DAY ELSE processado_em END AS processado_em"""


def changed(stored: DataFrame) -> DataFrame:
    """Purchases seen again a day later with twice the value."""
    return stored.where("evento = 'purchase'").withColumns(
        {
            "valor": F.col("valor") * 2,
            "processado_em": F.col("processado_em") + F.expr("INTERVAL 1 DAY"),
        }
    )


@query(
    "k07_documents_by_id",
    f"SELECT id, usuario, evento, timestamp, categoria, {CHANGED_SQL} FROM eventos",
    EVENTOS,
)
def documents_by_id(d: Data):
    """Two batches and a replay of the second; each id stays one document."""
    root = shared_folder(d.spark, "documents")
    files.write_batch(d.stored, root, "documentos", 0)
    for _ in range(2):
        files.write_batch(changed(d.stored), root, "documentos", 1)
    written = files.table_rows(d.spark, root, d.stored.schema)
    return keyed.latest(written, ["id"], ["processado_em"])


@query(
    "k02_bulk_documents",
    f"SELECT id, usuario, evento, timestamp, categoria, {CHANGED_SQL} FROM eventos",
    EVENTOS,
)
def bulk_documents(d: Data):
    """The same as bodies of bulk requests, read back from these."""
    root, shape = shared_folder(d.spark, "bulk"), d.stored.schema
    for batch, rows in ((0, d.stored), (1, changed(d.stored)), (1, changed(d.stored))):
        bulk.write_bodies(rows, root, "documentos", batch, "eventos", per_body=2000)
    return bulk.documents_of(d.spark, root, shape)


@query(
    "k08_upsert",
    f"""SELECT id, usuario, evento, timestamp, categoria, {CHANGED_SQL} FROM eventos""",
    EVENTOS,
)
def upsert(d: Data):
    """New rows, newer versions, and older versions that must not win."""
    base = d.stored.where("evento <> 'view'")
    outdated = d.stored.where("evento = 'error'").withColumns(
        {"valor": F.lit(-1.0), "processado_em": F.col("processado_em") - F.expr("INTERVAL 1 DAY")}
    )
    changes = d.stored.where("evento = 'view'").unionByName(changed(d.stored)).unionByName(outdated)
    return keyed.upsert(base, changes, ["id"], ["processado_em"])


@query("k09_insert_if_absent", f"SELECT {EVENT_SQL} FROM eventos WHERE valor >= 40", EVENTOS)
def insert_if_absent(d: Data):
    existing = d.events.where("valor < 40")
    batch = d.events.unionByName(d.events.where("evento = 'click'"))
    return keyed.new_rows(existing, batch, schemas.EVENT_KEY).select(*EVENT_COLUMNS)


@query(
    "k10_retention",
    """SELECT id, lead_id, started_at FROM sessions
    WHERE started_at >= (SELECT max(started_at) FROM sessions) - INTERVAL 90 DAY""",
    SESSIONS,
)
def retention(d: Data):
    now = d.as_of(d.sessions, "started_at")
    return files.retained(d.sessions, "started_at", 90, now).select("id", "lead_id", "started_at")


@query("k13_compaction", f"SELECT {EVENT_SQL}, timestamp::DATE AS dia FROM eventos", EVENTOS)
def compaction(d: Data):
    """Rows of the compacted table, read back from its day folders."""
    root = shared_folder(d.spark, "compaction")
    files.write_by_day(d.events, f"{root}/before")
    files.compact(d.spark, f"{root}/before", f"{root}/after")
    return d.spark.read.parquet(f"{root}/after").select(*EVENT_COLUMNS, "dia")


@query(
    "k14_rebuild",
    f"SELECT id, usuario, evento, timestamp, categoria, {CHANGED_SQL} FROM eventos",
    EVENTOS,
)
def rebuild(d: Data):
    """The document table made anew from raw rows that repeat ids."""
    target = shared_folder(d.spark, "rebuild")
    raw = d.stored.unionByName(changed(d.stored))
    files.rebuild(raw, schemas.ID_KEY, ["processado_em"], target)
    return d.spark.read.parquet(target)


@query(
    "t12_incremental_sync",
    """SELECT id, created_at FROM leads
    WHERE created_at > TIMESTAMP '2024-01-20' OR
          (created_at >= (SELECT max(created_at) FROM leads WHERE created_at <= TIMESTAMP '2024-01-20'
                          AND origem <> 'site') - INTERVAL 24 HOUR AND origem = 'site')""",
    LEADS,
)
def incremental_sync(d: Data):
    """Leads after those sent, and late ones within the overlap."""
    sent = d.leads.where("created_at <= TIMESTAMP_NTZ '2024-01-20' AND origem <> 'site'")
    folder = shared_folder(d.spark, "mark")
    store_mark(sent, "created_at", folder)
    mark = stored_mark(d.spark, folder)
    rows = pending(d.leads, sent, "created_at", schemas.ID_KEY, mark=mark)
    return rows.select("id", "created_at")


RETAINED_DAYS = 10


@query(
    "k10_store_retention",
    f"""SELECT {EVENT_SQL} FROM eventos
    WHERE timestamp::DATE >= (SELECT max(timestamp)::DATE FROM eventos) - {RETAINED_DAYS}""",
    EVENTOS,
)
def store_retention(d: Data):
    """Stored batches folded by day, old days dropped, and a batch that came after the fold."""
    root = shared_folder(d.spark, "store")
    early = d.events.where("valor < 90")
    files.write_batch(early, f"{root}/lotes", "q", 0)
    files.fold(d.spark, f"{root}/lotes", f"{root}/tabela", d.events.schema, schemas.EVENT_KEY, [])
    first = d.events.agg(F.date_sub(F.to_date(F.max("timestamp")), RETAINED_DAYS).cast("string")).first()[0]
    versions.drop_days_before(d.spark, f"{root}/tabela", first)
    late = d.events.where((F.col("valor") >= 90) & (F.to_date("timestamp") >= first))
    files.write_batch(late, f"{root}/lotes", "q", 1)
    return files.folded_rows(d.spark, f"{root}/lotes", f"{root}/tabela", d.events.schema).select(*EVENT_COLUMNS)


@query(
    "k10_fold_two_checkpoints",
    f"""SELECT {EVENT_SQL} FROM eventos
    WHERE timestamp::DATE >= (SELECT max(timestamp)::DATE FROM eventos) - {RETAINED_DAYS}""",
    EVENTOS,
)
def fold_two_checkpoints(d: Data):
    """Batches of two checkpoints, folded after each with retention between: each row once, and dropped days stay dropped."""
    root = shared_folder(d.spark, "two-checkpoints")
    first = d.events.agg(F.date_sub(F.to_date(F.max("timestamp")), RETAINED_DAYS).cast("string")).first()[0]
    parts = [("q", 0, "valor < 40"), ("r", 0, "valor >= 40 AND valor < 90"), ("r", 1, f"valor >= 90 AND to_date(timestamp) >= '{first}'")]
    for query_id, batch, condition in parts:
        files.write_batch(d.events.where(condition), f"{root}/lotes", query_id, batch)
        for _ in range(2):  # the second finds nothing to do
            files.fold(d.spark, f"{root}/lotes", f"{root}/tabela", d.events.schema, schemas.EVENT_KEY, [])
            versions.drop_days_before(d.spark, f"{root}/tabela", first)
    versions.vacuum(d.spark, f"{root}/tabela", 0)
    files.drop_folded(d.spark, f"{root}/lotes", f"{root}/tabela", 0)
    files.write_batch(d.events.limit(0), f"{root}/lotes", "r", 2)
    return files.folded_rows(d.spark, f"{root}/lotes", f"{root}/tabela", d.events.schema).select(*EVENT_COLUMNS)


@query("k11_tables", f"SELECT {EVENT_SQL} FROM eventos", EVENTOS)
def catalog_tables(d: Data):
    """Created twice, made anew, filled once; read from the table's folder."""
    folder = shared_folder(d.spark, "table")
    name = f"eventos_{folder[-12:]}"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in d.events.select(*EVENT_COLUMNS).schema)
    for _ in range(2):
        tables.create(d.spark, name, columns, f"{folder}/a")
    tables.recreate(d.spark, name, columns, f"{folder}/b")
    d.events.select(*EVENT_COLUMNS).write.insertInto(name)
    d.spark.sql(f"DROP TABLE {name}")
    return d.spark.read.parquet(f"{folder}/b")


@query("k12_comments", "SELECT 'd' || chr(39) || 'agua: ' || count(*) || ' linhas' AS comentario FROM events")
def comments(d: Data):
    folder = shared_folder(d.spark, "table")
    name = f"eventos_{folder[-12:]}"
    tables.create(d.spark, name, "id string", folder)
    tables.comment(d.spark, name, f"d'agua: {d.events.count()} linhas")
    found = d.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Comment'").first().data_type
    d.spark.sql(f"DROP TABLE {name}")
    return d.spark.createDataFrame([(found,)], "comentario string")


@query("p19_active_folder", "SELECT id, lead_id, started_at FROM sessions WHERE is_active", SESSIONS)
def active_folder(d: Data):
    """Sessions stored by their flag; the filter reads one folder."""
    folder = shared_folder(d.spark, "by-flag")
    d.sessions.hint("rebalance", "is_active").write.partitionBy("is_active").parquet(folder)
    return d.spark.read.schema(d.sessions.schema).parquet(folder).where("is_active").select("id", "lead_id", "started_at")
