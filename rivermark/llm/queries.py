"""The operators over the given tables, each at its production parameters."""

from __future__ import annotations

import re
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from rivermark.llm import (
    chat_tree,
    class_lm,
    collocations,
    decontaminate,
    hard_negatives,
    language,
    line_dedup,
    near_dup,
    pieces,
    token_counts,
    toxicity,
    url_filter,
    vector_search,
)

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_PAIRS = "/opt/tokenizers/byte_bpe_50k.json"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def prepare(spark: SparkSession) -> None:
    """Lets Python workers that are started from elsewhere find this package, and
    sends them texts in batches of a bounded size (Spark's own bound is 10,000 rows of any length)."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    for setting, most in (("maxRecordsPerBatch", 2000), ("maxBytesPerBatch", 4 << 20)):
        name = f"spark.sql.execution.arrow.{setting}"
        now = int(re.sub("[^0-9-]", "", spark.conf.get(name)) or 0)
        if not 0 < now <= most:
            spark.conf.set(name, most)


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Callable[[str], DataFrame]], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            prepare(spark)
            return build(lambda table: spark.read.parquet(f"{folder}/{table}.parquet"))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return build

    return register


@query("op1_sentencepiece")
def op1(table):
    return pieces.sentencepiece(table("documents"), PIECES)


@query("op2_url_filter")
def op2(table):
    return url_filter.url_filter(table("pages"))


@query("op3_class_lm")
def op3(table):
    return class_lm.class_lm(table("documents"))


@query("op4_near_dup")
def op4(table):
    return near_dup.near_dup(table("documents"))


@query("op5_language")
def op5(table):
    return language.language_id(table("documents"))


@query("op6_toxicity")
def op6(table):
    return toxicity.toxicity(table("documents"), table("labels"))


@query("op7_decontaminate", decontaminate.SQL)
def op7(table):
    return decontaminate.decontaminate(table("documents"), table("benchmark"))


@query("op8_vector_search", vector_search.SQL)
def op8(table):
    return vector_search.vector_search(table("embeddings"))


@query("op9_line_dedup")
def op9(table):
    return line_dedup.line_dedup(table("documents"))


@query("op10_chat_tree", chat_tree.SQL)
def op10(table):
    return chat_tree.chat_format(table("conversations"))


@query("op11_token_counts")
def op11(table):
    return token_counts.token_counts(table("documents"), BYTE_PAIRS)


@query("op12_collocations", collocations.SQL)
def op12(table):
    return collocations.collocations(table("documents"))


@query("op13_hard_negatives", hard_negatives.SQL)
def op13(table):
    return hard_negatives.mined(table("embeddings"))
