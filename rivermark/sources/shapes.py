"""The analytics tables derived from general order and event tables.

``events``, ``customer``, ``orders`` and ``nation`` give the event, lead and
session rows every registered query reads. registry.base states the same
mapping in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivermark.sources.streams import file_stream

CATEGORY_OF = {"purchase": "ecommerce", "view": "navegacao", "signup": "autenticacao"}
OTHER_CATEGORY = "interacao"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(
    spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None
) -> DataFrame:
    """The same table as a stream of its files.

    The pattern names the table exactly; a file source takes a single file by
    pattern only.
    """
    schema = table(spark, folder, name).schema
    return file_stream(spark, f"{folder}/{name}.parque[t]", schema, files_per_batch=files_per_batch)


def numbered(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column))


def event_columns(source: DataFrame, *extra: Column) -> DataFrame:
    """Event rows; ``timestamp`` stays without zone, as it is stored."""
    kind = F.col("event_type")
    category = F.lit(OTHER_CATEGORY)
    for event, name in CATEGORY_OF.items():
        category = F.when(kind == event, name).otherwise(category)
    return source.select(
        numbered("ev-", "event_id").alias("id"),
        numbered("usuario", "user_id").alias("usuario"),
        kind.alias("evento"),
        F.col("value").alias("valor"),
        F.col("ts").alias("timestamp"),
        category.alias("categoria"),
        *extra,
    )


def events_with_metadata(source: DataFrame) -> DataFrame:
    """The variant whose events carry a JSON object."""
    return event_columns(source, F.col("props").alias("metadata"))


def stored_events(source: DataFrame) -> DataFrame:
    """Event rows with a processing time some seconds after the event."""
    delay = F.make_dt_interval(secs=F.pmod(F.col("event_id") * 7, F.lit(300)))
    return event_columns(source, (F.col("ts") + delay).alias("processado_em"))


def _hours_after(start: Column, hours: Column) -> Column:
    return start + F.make_dt_interval(hours=hours)


def _nothing(kind: str, *names: str) -> list[Column]:
    return [F.lit(None).cast(kind).alias(n) for n in names]


def leads(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """One lead per customer; adaptive execution broadcasts the nations when small."""
    names = nation.select("n_nationkey", "n_name")
    score = F.least(
        F.lit(100), F.greatest(F.lit(0), F.floor((F.col("c_acctbal") + 1000) / 110).cast("int"))
    )
    status = (
        F.when(F.col("score") >= 90, "convertido")
        .when(F.col("score") >= 70, "qualificado")
        .when(F.col("score") >= 50, "em_contato")
        .when(F.col("score") >= 20, "novo")
        .otherwise("perdido")
    )
    third = F.pmod("c_custkey", F.lit(3))
    origin = F.when(third == 0, "chatbot").when(third == 1, "site").otherwise("indicacao")
    first_day = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    email = F.lower(F.replace("c_name", F.lit("#"), F.lit("")))
    rows = (
        customer.join(names, customer.c_nationkey == names.n_nationkey, "left")
        .withColumn("score", score)
        .withColumn("origem", origin)
        .withColumn("created_at", _hours_after(first_day, F.pmod("c_custkey", F.lit(720)).cast("int")))
    )
    return rows.select(
        numbered("lead-", "c_custkey").alias("id"),
        F.col("c_name").alias("nome"),
        F.concat(email, F.lit("@example.com")).alias("email"),
        *_nothing("string", "telefone"),
        F.col("c_mktsegment").alias("nome_empresa"),
        *_nothing("string", "nome_projeto"),
        F.to_json(F.struct(F.col("n_name").alias("pais"))).alias("localizacao"),
        F.array(F.lower("c_mktsegment"), "origem").alias("interesse"),
        F.col("score").alias("score_qualificacao"),
        status.alias("status_lead"),
        "origem",
        *_nothing("string", "utm_source", "utm_medium", "utm_campaign"),
        "created_at",
        F.col("created_at").alias("updated_at"),
        _hours_after(F.col("created_at"), F.pmod("c_custkey", F.lit(97)).cast("int")).alias(
            "last_interaction_at"
        ),
    )


def sessions(orders: DataFrame) -> DataFrame:
    """One chat session per order, of the lead behind its customer."""
    messages = F.pmod("o_orderkey", F.lit(20)).cast("int")
    third = F.pmod("o_orderkey", F.lit(3))
    active = F.col("o_orderstatus") == "O"
    return orders.select(
        numbered("sess-", "o_orderkey").alias("id"),
        numbered("lead-", "o_custkey").alias("lead_id"),
        *_nothing("string", "session_token", "user_agent", "ip_address"),
        messages.alias("total_messages"),
        (messages * 30).alias("duration_seconds"),
        F.array(F.lit("/"), F.concat(F.lit("/p"), F.pmod("o_orderkey", F.lit(5)))).alias(
            "pages_visited"
        ),
        *_nothing("array<string>", "perguntas_feitas"),
        *_nothing("string", "intencao_detectada"),
        F.when(third == 0, "baixo").when(third == 1, "medio").otherwise("alto").alias(
            "nivel_interesse"
        ),
        F.col("o_orderdate").alias("started_at"),
        F.when(~active, F.col("o_orderdate") + F.expr("INTERVAL 30 MINUTES")).alias("ended_at"),
        active.alias("is_active"),
    )
