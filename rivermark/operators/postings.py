"""An inverted index with word positions, so that a search reads posting lists and not all texts.

A row is a block of one word: documents that hold it and its places in them, one entry per occurrence and at most
``BLOCK`` of them. A task makes the blocks of the documents it reads, so nothing but whole blocks is shuffled. Blocks lie in
folders by a hash bucket of the word (``balde``), sorted by word inside; a search filters the buckets of its words, which prunes
folders, and the words themselves, which prunes row groups. A word that very many documents hold is as many rows, in as many files
as the rebalancing makes of its bucket, never one list. Words are those of ``functions.text.tokens``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivermark.functions.text import tokens
from rivermark.operators import keyed

BUCKETS = 64
BLOCK = 4096  # occurrences in a row


def bucket(word: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int")


def _blocks(batches):
    """(termo, chaves, posicoes) of batches of (key, words): the words of a batch in order, each with its occurrences."""
    for batch in batches:
        key, words = batch.columns
        place = pc.list_parent_indices(words).to_numpy()
        if not len(place):
            continue
        coded = pc.list_flatten(words).dictionary_encode()
        position = np.arange(len(place)) - np.searchsorted(place, place, "left")
        order = np.argsort(coded.indices.to_numpy(), kind="stable")
        code = coded.indices.to_numpy()[order]
        cuts = (np.arange(len(code)) - np.searchsorted(code, code, "left")) % BLOCK == 0
        first = np.flatnonzero(cuts).astype(np.int32)
        offsets = pa.array(np.append(first, np.int32(len(code))))
        yield pa.RecordBatch.from_arrays(
            [
                coded.dictionary.take(pa.array(code[first])),
                pa.ListArray.from_arrays(offsets, key.take(pa.array(place[order]))),
                pa.ListArray.from_arrays(offsets, pa.array(position[order].astype(np.int32))),
            ],
            names=["termo", "chaves", "posicoes"],
        )


def postings(documents: DataFrame, key: str, text: str, buckets: int = BUCKETS) -> DataFrame:
    """(termo, chaves, posicoes, balde) of every word of every document; null texts have none.

    ``chaves`` and ``posicoes`` have an entry for each occurrence. Rows that share a key are taken as one text after the
    other would be: their places are not told apart, so keys should be unique.
    """
    words = documents.select(F.col(key), F.array_remove(tokens(F.col(text)), "").alias("palavras"))
    kind = words.schema[key].dataType.simpleString()
    rows = words.mapInArrow(_blocks, f"termo string, chaves array<{kind}>, posicoes array<int>")
    return rows.withColumn("balde", bucket(F.col("termo"), buckets))


def write_index(documents: DataFrame, root: str, query_id: str, batch_id: int, key: str, text: str, buckets: int = BUCKETS) -> None:
    """Stores the postings of a batch, replacing an earlier attempt of the same one. ``buckets`` is fixed by the first."""
    rows = postings(documents, key, text, buckets).hint("rebalance", "balde")
    rows = rows.sortWithinPartitions("balde", "termo")
    rows.write.mode("overwrite").partitionBy("balde").parquet(f"{root}/consulta={query_id}/lote={batch_id}")


class Index:
    """Reads the postings of all batches below ``root``."""

    def __init__(self, spark: SparkSession, root: str, key: str, kind: str, buckets: int = BUCKETS):
        self.spark, self.root, self.key, self.kind, self.buckets = spark, root, key, kind, buckets

    def lists(self, words: list[str]) -> DataFrame:
        """Postings of some words; folders of other buckets are not listed in the plan's files."""
        schema = f"termo string, chaves array<{self.kind}>, posicoes array<int>"
        rows = self.spark.read.schema(schema).option("basePath", self.root).parquet(f"{self.root}/consulta=*")
        of_bucket = [F.col("balde") == bucket(F.lit(w), self.buckets) for w in words]
        condition = F.lit(False)
        for one in of_bucket:
            condition |= one
        return rows.where(condition & F.col("termo").isin(words)).select("termo", "chaves", "posicoes")

    def words(self, text: str) -> list[str]:
        """The words of a search text, as the index names them."""
        found = self.spark.range(1).select(F.array_remove(tokens(F.lit(text)), "").alias("w")).first().w
        return list(found)

    def any_word(self, text: str) -> DataFrame:
        """Keys of documents that hold any word of ``text``, each once."""
        words = list(dict.fromkeys(self.words(text)))
        return self.lists(words).select(F.explode(F.array_distinct("chaves")).alias(self.key)).distinct()

    def phrase(self, text: str) -> DataFrame:
        """Keys of documents that hold the words of ``text`` in sequence, each once.

        Every occurrence is moved back by its word's place in the phrase; where all words meet, the phrase begins.
        """
        words = self.words(text)
        places = F.array(*(F.struct(F.lit(w).alias("termo"), F.lit(n).alias("n")) for n, w in enumerate(words)))
        moved = self.lists(list(dict.fromkeys(words))).select(
            F.explode(F.filter(places, lambda p: p["termo"] == F.col("termo"))["n"]).alias("n"),
            F.arrays_zip("chaves", "posicoes").alias("lugares"),
        )
        each = moved.select("n", F.inline("lugares").alias(self.key, "posicao"))
        starts = each.select(self.key, (F.col("posicao") - F.col("n")).alias("inicio"))
        met = starts.groupBy(self.key, "inicio").agg(F.count("*").alias("palavras"))
        return met.where(F.col("palavras") == len(words)).select(self.key).distinct()


def found(documents: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The documents of some keys."""
    return keyed.matching(documents, keys, [key], unique=True)
