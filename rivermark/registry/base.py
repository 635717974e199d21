"""Registration, the input tables, and their mapping stated in SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivermark.functions.times import latest_time
from rivermark.sources import shapes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Data:
    """The tables of one folder in the shapes the queries use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return shapes.table(self.spark, self.folder, name)

    @cached_property
    def events(self) -> DataFrame:
        return shapes.event_columns(self.table("events"))

    @cached_property
    def stored(self) -> DataFrame:
        return shapes.stored_events(self.table("events"))

    @cached_property
    def metadata(self) -> DataFrame:
        return shapes.events_with_metadata(self.table("events"))

    @cached_property
    def leads(self) -> DataFrame:
        return shapes.leads(self.table("customer"), shapes.table(self.spark, self.folder, "nation"))

    @cached_property
    def sessions(self) -> DataFrame:
        return shapes.sessions(self.table("orders"))

    @cached_property
    def active(self) -> DataFrame:
        return self.sessions.where("is_active")

    @cached_property
    def chat(self) -> DataFrame:
        return self.table("conversations")

    def as_of(self, df: DataFrame, column: str) -> DataFrame:
        """The newest time in the data stands for now."""
        return latest_time(df, column)


class StreamData(Data):
    """The same shapes over streams of the tables' files.

    ``files_per_batch`` bounds a batch that is kept while it is written. Where
    event time decides what is late, the files have to come in one batch, as
    their order is not the order of time.
    """

    def __init__(self, spark: SparkSession, folder: str, files_per_batch: int | None = None):
        super().__init__(spark, folder)
        self.files_per_batch = files_per_batch

    def table(self, name: str) -> DataFrame:
        return shapes.table_stream(self.spark, self.folder, name, self.files_per_batch)


EVENTOS = """eventos AS (
    SELECT 'ev-' || event_id AS id, 'usuario' || user_id AS usuario, event_type AS evento,
           value AS valor, ts AS timestamp,
           CASE event_type WHEN 'purchase' THEN 'ecommerce' WHEN 'view' THEN 'navegacao'
                WHEN 'signup' THEN 'autenticacao' ELSE 'interacao' END AS categoria,
           props AS metadata,
           ts + ((event_id * 7) % 300) * INTERVAL 1 SECOND AS processado_em
    FROM events)"""

LEADS = """leads AS (
    SELECT 'lead-' || c_custkey AS id, c_name AS nome,
           lower(replace(c_name, '#', '')) || '@example.com' AS email,
           CAST(NULL AS VARCHAR) AS telefone, c_mktsegment AS nome_empresa,
           CAST(NULL AS VARCHAR) AS nome_projeto,
           '{"pais":"' || n_name || '"}' AS localizacao,
           [lower(c_mktsegment), origem] AS interesse,
           score AS score_qualificacao,
           CASE WHEN score >= 90 THEN 'convertido' WHEN score >= 70 THEN 'qualificado'
                WHEN score >= 50 THEN 'em_contato' WHEN score >= 20 THEN 'novo'
                ELSE 'perdido' END AS status_lead,
           origem, created_at, created_at AS updated_at,
           created_at + (c_custkey % 97) * INTERVAL 1 HOUR AS last_interaction_at
    FROM (SELECT *, least(100, greatest(0, CAST(floor((c_acctbal + 1000) / 110) AS INTEGER))) AS score,
                 CASE c_custkey % 3 WHEN 0 THEN 'chatbot' WHEN 1 THEN 'site' ELSE 'indicacao' END AS origem,
                 TIMESTAMP '2024-01-01 00:00:00' + (c_custkey % 720) * INTERVAL 1 HOUR AS created_at
          FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey))"""

SESSIONS = """sessions AS (
    SELECT 'sess-' || o_orderkey AS id, 'lead-' || o_custkey AS lead_id,
           CAST(o_orderkey % 20 AS INTEGER) AS total_messages,
           CAST(o_orderkey % 20 * 30 AS INTEGER) AS duration_seconds,
           ['/', '/p' || (o_orderkey % 5)] AS pages_visited,
           CASE o_orderkey % 3 WHEN 0 THEN 'baixo' WHEN 1 THEN 'medio' ELSE 'alto' END AS nivel_interesse,
           o_orderdate AS started_at,
           CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 30 MINUTE END AS ended_at,
           o_orderstatus = 'O' AS is_active
    FROM orders)"""

# Sum of amounts with two decimals, and their mean.
SOMA = "CAST(sum(CAST(valor AS DECIMAL(18, 2))) AS DOUBLE)"
MEDIA = f"{SOMA} / count(valor)"
AMOUNT_SCALE = 2

JANELAS = f"""janelas AS (
    SELECT janela_inicio, janela_inicio + INTERVAL 5 MINUTE AS janela_fim, categoria, evento,
           count(*) AS total_eventos, {MEDIA} AS valor_medio, {SOMA} AS valor_total
    FROM (SELECT *, time_bucket(INTERVAL 1 MINUTE, timestamp) - k * INTERVAL 1 MINUTE AS janela_inicio
          FROM eventos, range(5) r(k))
    GROUP BY ALL)"""


def with_tables(body: str, *tables: str) -> str:
    return f"WITH {', '.join(tables)}\n{body}" if tables else body


def query(key: str, sql: str | None = None, *tables: str):
    """Registers a function of Data; ``sql`` may use the named tables."""

    def register(build: Callable[[Data], DataFrame]):
        QUERIES[key] = lambda spark, folder: comparable(build(Data(spark, folder)))
        if sql is not None:
            ORACLES[key] = with_tables(sql, *tables)
        return build

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Times as wall-clock times, so no reader's zone shifts them."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def texts(df: DataFrame, *columns: str) -> DataFrame:
    """Arrays as joined text."""
    return df.withColumns({c: F.array_join(c, ",") for c in columns})
