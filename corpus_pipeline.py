"""From raw documents to token ids, in stages that are each written and read again.

Every stage takes all rows its predecessor kept and returns the columns of
``documents``, the last one also token ids. Null and empty texts pass all stages;
extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivermark.llm import decontaminate, line_dedup, near_dup, pieces, toxicity
from rivermark.llm.queries import PIECES, prepare
from rivermark.llm.rows import col, stored

ORACLE_SQL = None  # trained scores, alignment and sketches have no SQL form


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity models reject."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(toxicity.training_documents(docs), labels)
    judged = toxicity.scored(docs, model)
    score = judged.columns[-1]
    return judged.where(col(score) < toxicity.THRESHOLD).drop(score)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without passages that an earlier document has; a document of which nothing is left goes."""
    prepare(spark)
    rows, flags = line_dedup.deduplicated(docs)
    emptied = col(flags).isNotNull() & ~near_dup.has_words("text")
    return rows.where(~emptied).drop(flags)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    prepare(spark)
    return near_dup.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold benchmark windows."""
    prepare(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with token ids, and whether these decode to the text."""
    prepare(spark)
    vocabulary = pieces.Vocabulary.read(PIECES)
    rows, ids, text = pieces.encoded_and_decoded(docs, vocabulary)
    return rows.withColumn(text, col(text).eqNullSafe(F.col("text"))).withColumnRenamed(text, f"{ids}_exact")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("sentencepiece", to_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
