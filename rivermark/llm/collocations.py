"""Phrase collocations by FM-indexes over word ids, one per shard of documents.

A shard is what a task has read when its texts reach ``SHARD`` bytes. Its words get ids, pieces of text are set apart by
id 0, and two indexes are built and stored: the words before the suffixes, sorted by their first ``longest`` words
(the Burrows-Wheeler transform for contexts of that length), and the same for the words read backwards. A phrase is an
interval of suffixes in either order. The different words beside an interval, counted, are its extensions to the left
in one index and to the right in the other, and each gives the longer phrase's interval in both: in the one from the number
of earlier occurrences of the word, in the other from the number of smaller words beside the interval.

Phrases are enumerated level by level up to ``longest`` words. Counts of a level are summed over the shards, and phrases of
``LEAST`` occurrences or more are stored; no longer phrase is as frequent as that unless its parts are. The next level's
tasks pass over extensions that a table of ``BITS`` bits rules out, in which each frequent part sets one bit by its hash.
Its size is fixed; where bits are shared more extensions are counted, none is lost.

Words are named by a 64-bit hash of language and word; before the hashes are used it is checked over the whole
vocabulary that no two words share one, else another seed is taken. So counts are exact.

Null texts are empty, a null language is ``und``. Repeated rows count each. Words are cut at spaces and tabs, pieces at
punctuation and line ends; A-Z is lower-cased. A longer text than SHARD makes a larger shard. Empty tables have
no phrases.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivermark.llm.rows import col, stored
from rivermark.llm.spans import LOWER, byte_class, mixed, slices, text_bytes
from rivermark.session import shared_folder

LONGEST = 3  # words of a phrase
LEAST = 10  # occurrences of a candidate
INSIDE = 50  # percent: so frequent a longer phrase takes the place of the one inside it
FIRST = 2000  # phrases reported per language
SHARD = 3 << 20
WORDS = 4096  # of a shard in a row
ROW_GROUP = 32 << 20  # bytes of stored indexes that are read at once
BITS = 1 << 26
GROUP = 50_000  # candidates ranked in one task at first

PIECE_ENDS = byte_class((0x2E, 0x2E), (0x2C, 0x2C), (0x3B, 0x3B), (0x3A, 0x3A), (0x21, 0x21), (0x3F, 0x3F), (0x0A, 0x0D))
WORD = ~(PIECE_ENDS | byte_class((0x20, 0x20), (0x09, 0x09)))
# a shard is one row with its index, and rows with parts of its vocabulary
INDEX = "names binary, counts binary, left binary, right binary, lang string, words array<struct<h1: long, word: string, n: long>>"


WORD_LIST = pa.list_(pa.struct([("h1", pa.int64()), ("word", pa.string()), ("n", pa.int64())]))


class Index:
    """Bidirectional index of a shard: ``before[k]`` stands before the k-th suffix, ``after[k]`` before the k-th reversed one."""

    def __init__(self, counts: np.ndarray, before: np.ndarray, after: np.ndarray):
        self.starts = np.concatenate([[0], np.cumsum(counts)])  # interval of each word, in either index
        self.sides = (before, after)
        self.places: list[tuple[np.ndarray, np.ndarray] | None] = [None, None]

    @classmethod
    def of(cls, ids: np.ndarray, kinds: int, longest: int) -> Index:
        """``ids`` end with 0, which sets pieces apart; they are read as a circle."""
        return cls(np.bincount(ids, minlength=kinds), words_before(ids, kinds, longest), words_before(ids[::-1], kinds, longest))

    def occurrences(self, side: int, word: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each word stands among the first ``end`` entries of a side."""
        if self.places[side] is None:
            column = self.sides[side]
            order = np.argsort(column, kind="stable")
            self.places[side] = column[order].astype(np.int64) * (len(column) + 1) + order, np.searchsorted(column[order], np.arange(len(self.starts)))
        keys, first = self.places[side]
        return np.searchsorted(keys, word.astype(np.int64) * (len(self.sides[side]) + 1) + end) - first[word]

    def words(self) -> Phrases:
        """All words as phrases of one word."""
        every = np.arange(1, len(self.starts) - 1)
        starts = np.stack([self.starts[every], self.starts[every]])
        return Phrases(every[:, None], starts, np.diff(self.starts)[every])

    def extended(self, phrases: Phrases, side: int) -> Phrases:
        """Every phrase with each word beside it, on the left (side 0) or the right (side 1)."""
        sizes, column = phrases.counts, self.sides[side]
        owner = np.repeat(np.arange(len(sizes)), sizes)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        beside = column[phrases.starts[side][owner] + inside].astype(np.int64)
        kinds = len(self.starts)
        keys, counts = np.unique(owner * kinds + beside, return_counts=True)
        owner, word = keys // kinds, keys % kinds
        smaller = np.cumsum(counts) - counts
        smaller -= smaller[np.searchsorted(owner, owner, "left")]
        keep = word > 0
        owner, word, counts, smaller = owner[keep], word[keep], counts[keep], smaller[keep]
        starts = np.empty((2, len(owner)), np.int64)
        starts[side] = self.starts[word] + self.occurrences(side, word, phrases.starts[side][owner])
        starts[1 - side] = phrases.starts[1 - side][owner] + smaller
        parts = (word[:, None], phrases.ids[owner]) if side == 0 else (phrases.ids[owner], word[:, None])
        return Phrases(np.concatenate(parts, axis=1), starts, counts)


class Phrases:
    """Word ids of phrases of one length, where their intervals start in both indexes, and their counts."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, counts: np.ndarray):
        self.ids, self.starts, self.counts = ids, starts, counts

    def where(self, keep: np.ndarray) -> Phrases:
        return Phrases(self.ids[keep], self.starts[:, keep], self.counts[keep])


def words_before(ids: np.ndarray, kinds: int, longest: int) -> np.ndarray:
    """The word before each suffix, suffixes sorted by their first ``longest`` words."""
    contexts = [np.roll(ids, -n) for n in range(longest)]
    order = np.lexsort(contexts[::-1]) if kinds**longest >= 1 << 63 else None
    if order is None:
        key = np.zeros(len(ids), np.int64)
        for context in contexts:
            key = key * kinds + context
        order = np.argsort(key, kind="stable")
    return np.roll(ids, 1)[order].astype(np.int32)


def cut_words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """Words of the texts in order, the text of each, and whether each begins a piece."""
    raw, cuts = text_bytes(texts)
    raw = LOWER[raw]
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = WORD[raw]
    begins, stops = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    edge = np.unique(cuts[(cuts > 0) & (cuts < len(raw))])
    begins[edge] = inside[1:-1][edge]
    stops[edge - 1] = inside[1:-1][edge - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    text = np.searchsorted(cuts, starts, "right") - 1
    broken = np.concatenate([[0], np.cumsum(PIECE_ENDS[raw])])
    first = np.ones(len(starts), bool)
    first[1:] = (broken[starts[1:]] > broken[ends[:-1]]) | (text[1:] != text[:-1])
    # words and what is between them, in turns; then the words alone
    edges = np.stack([starts, ends], axis=1).ravel().astype(np.int32)
    if not len(edges):
        return pa.array([], pa.string()).dictionary_encode(), text, first
    alternating = pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(raw)])
    words = alternating.take(pa.array(np.arange(0, len(edges) - 1, 2))).dictionary_encode()
    return words, text, first


def word_hash(lang: str, word: bytes, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode() + b"\x00" + word, seed) - (1 << 63)


def index_of(texts: pa.Array, langs: pa.Array, longest: int, seed: int) -> pa.RecordBatch:
    """A row with the two indexes of a shard and the hashes and counts of its words by id, and rows with the words."""
    words, text, first = cut_words(texts)
    kinds = langs.dictionary_encode()
    lang = kinds.indices.to_numpy(zero_copy_only=False)[text] if len(text) else np.zeros(0, np.int64)
    key = lang.astype(np.int64) * (len(words.dictionary) + 1) + words.indices.to_numpy(zero_copy_only=False)
    distinct, which, counts = np.unique(key, return_inverse=True, return_counts=True)
    ids = np.zeros(len(which) + int(first.sum()) + 1, np.int64)
    ids[np.arange(len(which)) + np.cumsum(first)] = which + 1  # a 0 before each piece, and one at the end
    index = Index.of(ids, len(distinct) + 1, longest)
    spelling, names = distinct % (len(words.dictionary) + 1), kinds.dictionary.to_pylist()
    hashes, parts, part_langs = np.zeros(len(distinct), np.int64), [], []
    edges = np.searchsorted(distinct // (len(words.dictionary) + 1), np.arange(len(names) + 1))
    for n, name in enumerate(names):
        for start in range(edges[n], edges[n + 1], WORDS):
            end = min(start + WORDS, edges[n + 1])
            spelled = words.dictionary.take(pa.array(spelling[start:end])).to_pylist()
            hashes[start:end] = [word_hash(name, word, seed) for word in spelled]
            spelled = [word.decode("utf-8", "replace") for word in spelled]
            fields = [pa.array(hashes[start:end]), pa.array(spelled, pa.string()), pa.array(counts[start:end])]
            parts.append(pa.StructArray.from_arrays(fields, names=["h1", "word", "n"]))
            part_langs.append(name)
    held = pa.concat_arrays(parts) if parts else None
    offsets = np.cumsum([0, 0, *map(len, parts)]).astype(np.int32)
    words_column = (
        pa.ListArray.from_arrays(pa.array(offsets), held) if parts else pa.array([None], WORD_LIST)
    )
    blank = [None] * len(parts)
    binary = [hashes.tobytes(), counts.tobytes(), index.sides[0].tobytes(), index.sides[1].tobytes()]
    columns = [pa.array([value, *blank], pa.binary()) for value in binary]
    columns += [pa.array([None, *part_langs], pa.string()), words_column]
    return pa.RecordBatch.from_arrays(columns, names=["names", "counts", "left", "right", "lang", "words"])


def indexed(documents: DataFrame, lang_column: str, text_column: str, longest: int, seed: int) -> DataFrame:
    """One row per shard."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text", SHARD // 4):
                held.append(part)
                size += part.column("text").nbytes
                if size >= SHARD:
                    yield finished(held)
                    held, size = [], 0
        if held:
            yield finished(held)

    def finished(held):
        table = pa.Table.from_batches(held).combine_chunks()
        texts, langs = (table.column(c).combine_chunks() for c in ("text", "lang"))
        return index_of(texts, langs, longest, seed)

    rows = documents.select(
        F.coalesce(col(text_column).cast("string"), F.lit("")).alias("text"),
        F.coalesce(col(lang_column).cast("string"), F.lit("und")).alias("lang"),
    )
    return rows.mapInArrow(run, INDEX)


def indexes_of(batch: pa.RecordBatch):
    """Hashes of the words and index of each shard in a batch."""
    for row in range(batch.num_rows):
        buffers = [batch.column(c)[row].as_buffer() for c in ("names", "counts", "left", "right")]
        hashes, counts, before, after = (np.frombuffer(b, t) for b, t in zip(buffers, (np.int64, np.int64, np.int32, np.int32)))
        separators = len(before) - int(counts.sum())
        yield hashes, Index(np.append(separators, counts), before, after)


def slot(hashes: np.ndarray) -> np.ndarray:
    """Bit of a phrase, from the hashes of its words."""
    value = np.zeros(len(hashes), np.uint64)
    for n in range(hashes.shape[1]):
        value = mixed(value * np.uint64(31) + hashes[:, n].view(np.uint64) + np.uint64(n + 1))
    return (value % np.uint64(BITS)).astype(np.int64)


def bits_of(phrases: DataFrame, words: int) -> np.ndarray:
    """BITS bits, packed: those of the stored phrases are set. Only distinct bytes of the table reach the driver."""

    def run(batches):
        for batch in batches:
            hashes = np.stack([np.asarray(batch.column(n)) for n in range(words)], axis=1)
            at = np.unique(slot(hashes))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 3), pa.array(1 << (7 - (at & 7)))], names=["at", "bit"])

    columns = [f"h{n}" for n in range(1, words + 1)]
    made = phrases.select(*columns).mapInArrow(run, "at long, bit long").groupBy("at").agg(F.bit_or("bit").alias("bits"))
    table = np.zeros(BITS // 8, np.uint8)
    found = made.select(F.col("at").cast("int").alias("at"), F.col("bits").cast("short").alias("bits")).toArrow()
    table[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    return table


def is_set(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = slot(hashes)
    return (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0


def counted(shards: DataFrame, size: int, frequent: list) -> DataFrame:
    """(h1, ..., n): phrases of ``size`` words of each shard whose parts may be frequent; ``frequent`` has
    the bits of every shorter length."""

    def run(batches):
        tables = [shared.value for shared in frequent]
        for batch in batches:
            for hashes, index in indexes_of(batch):
                phrases = index.words()
                named = np.append(0, hashes)  # id 0 has no name
                phrases = phrases.where(is_set(tables[0], named[phrases.ids]))
                for words in range(2, size + 1):
                    phrases = index.extended(phrases, words % 2)
                    names = named[phrases.ids]
                    keep = is_set(tables[0], names[:, :1]) & is_set(tables[0], names[:, -1:])
                    if words > 2:
                        keep &= is_set(tables[words - 2], names[:, 1:]) & is_set(tables[words - 2], names[:, :-1])
                    if words < size:
                        keep &= is_set(tables[words - 1], names)
                    phrases = phrases.where(keep)
                names = named[phrases.ids]
                columns = [*(names[:, n] for n in range(size)), phrases.counts]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[*keys, "n"])

    keys = [f"h{n}" for n in range(1, size + 1)]
    schema = ", ".join(f"{k} long" for k in [*keys, "n"])
    return shards.where("left is not null").select("names", "counts", "left", "right").mapInArrow(run, schema)


def vocabulary(shards: DataFrame) -> DataFrame:
    """(h1, lang, word, n) over all shards, stored."""
    each = shards.where("lang is not null").select("lang", F.inline("words"))
    return stored(each.groupBy("h1", "lang", "word").agg(F.sum("n").alias("n")), "words")


def frequent_phrases(
    documents: DataFrame, lang_column: str = "lang", text_column: str = "text", longest: int = LONGEST, least: int = LEAST
) -> tuple[DataFrame, list[DataFrame]]:
    """The vocabulary (h1, lang, word, n), and for each length the phrases (h1, h2, ..., n) that occur ``least`` times."""
    spark, seed = documents.sparkSession, 0
    while True:
        folder = shared_folder(spark, "indexes")
        made = indexed(documents, lang_column, text_column, longest, seed)
        made.write.option("parquet.block.size", ROW_GROUP).parquet(folder)
        shards = spark.read.schema(INDEX).parquet(folder)
        words = vocabulary(shards)
        if words.groupBy("h1").count().where("count > 1").isEmpty():
            break
        seed += 1
    tables, bits = [words.where(F.col("n") >= least).select("h1", "n")], []
    for size in range(2, longest + 1):
        bits.append(spark.sparkContext.broadcast(bits_of(tables[-1], size - 1)))
        keys = [f"h{n}" for n in range(1, size + 1)]
        summed = counted(shards, size, bits).groupBy(*keys).agg(F.sum("n").alias("n"))
        tables.append(stored(summed.where(F.col("n") >= least), "phrases"))
    return words, tables


def extensions(tables: list[DataFrame], size: int, side: str) -> DataFrame:
    """(h1, ..., kinds, n): different words that stand left or right of each phrase of ``size`` words in frequent
    longer phrases, and their occurrences."""
    first = 2 if side == "left" else 1
    keys = [F.col(f"h{first + n}").alias(f"h{n + 1}") for n in range(size)]
    return tables[size].groupBy(*keys).agg(F.count("*").alias("kinds"), F.sum("n").alias("n"))


def scored(tables: list[DataFrame], size: int) -> DataFrame:
    """Phrases of ``size`` words with a, l, r and score: of all cuts the one of the lowest score, then the earliest.

    Both parts of a candidate are as frequent as it is, hence in the tables. Their keys are unique there,
    so a hot part splits on the candidates' side only.
    """
    phrases = tables[size - 1].withColumnRenamed("n", "a")
    keys = [f"h{n}" for n in range(1, size + 1)]
    exact = lambda c: F.col(c).cast("decimal(16,0)")
    found, best = phrases, []
    for cut in range(1, size):
        left = tables[cut - 1].toDF(*[f"h{n}" for n in range(1, cut + 1)], f"l{cut}")
        right = tables[size - cut - 1].toDF(*[f"h{n}" for n in range(cut + 1, size + 1)], f"r{cut}")
        found = found.join(left, keys[:cut]).join(right, keys[cut:])
        # decimal(38,0) holds 10**6 * a * a for a below 5 * 10**15
        share = F.expr(f"(cast(a as decimal(16,0)) * cast(a as decimal(16,0)) * cast(1000000 as decimal(7,0))) div (cast(l{cut} as decimal(16,0)) * cast(r{cut} as decimal(16,0)))")
        best.append(F.struct(share.cast("long").alias("score"), F.lit(cut).alias("cut"), F.col(f"l{cut}").alias("l"), F.col(f"r{cut}").alias("r")))
    chosen = F.least(*best) if len(best) > 1 else best[0]
    return found.select(*keys, "a", chosen.alias("best")).select(*keys, "a", "best.l", "best.r", "best.score")


def not_inside(candidates: DataFrame, tables: list[DataFrame], size: int, inside: int) -> DataFrame:
    """Candidates without those that a longer phrase holds whose occurrences are ``inside`` percent of theirs."""
    keys = [f"h{n}" for n in range(1, size + 1)]
    for longer in range(size + 1, len(tables) + 1):
        parts = [
            F.struct(*(F.col(f"h{first + n}").alias(f"h{n}") for n in range(1, size + 1))) for first in range(longer - size + 1)
        ]
        held = tables[longer - 1].select(F.explode(F.array(*parts)).alias("part"), "n").groupBy("part").agg(F.max("n").alias("most"))
        held = stored(held.select("part.*", "most"), "held")  # an aggregate here would keep a hot key from being split
        candidates = candidates.join(held, keys, "left").where(
            F.col("most").isNull() | (100 * F.col("most").cast("decimal(20,0)") < inside * F.col("a").cast("decimal(20,0)"))
        ).drop("most")
    return candidates


def spelled(candidates: DataFrame, words: DataFrame, size: int) -> DataFrame:
    """(lang, phrase, a, l, r, score) of phrases of ``size`` words."""
    for n in range(1, size + 1):
        names = words.select(F.col("h1").alias(f"h{n}"), F.col("word").alias(f"w{n}"), *(["lang"] if n == 1 else []))
        candidates = candidates.join(names, f"h{n}")
    phrase = F.concat_ws(" ", *(f"w{n}" for n in range(1, size + 1)))
    return candidates.select("lang", phrase.alias("phrase"), "a", "l", "r", "score")


def first_of_each(rows: DataFrame, group: str, order: list, count: int) -> DataFrame:
    """The first ``count`` rows of each group with their rank. A large group is ranked in parts first."""
    parts = rows.count() // GROUP + 1
    part = F.pmod(F.xxhash64(*rows.columns), F.lit(parts))
    few = rows.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy(group, "part").orderBy(*order)))
    few = few.where(F.col("rank") <= count).drop("part", "rank")
    return few.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= count)


def collocations(
    documents: DataFrame, longest: int = LONGEST, least: int = LEAST, inside: int = INSIDE, first: int = FIRST
) -> DataFrame:
    """The phrases of each language that hold together best."""
    words, tables = frequent_phrases(documents, longest=longest, least=least)
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    rows = None
    for size in range(2, longest + 1):
        kept = not_inside(scored(tables, size), tables, size, inside)
        named = spelled(kept, words, size)
        rows = named if rows is None else rows.unionByName(named)
    order = [F.desc("score"), F.desc("a"), "phrase"]
    best = first_of_each(stored(rows, "candidates"), "lang", order, first)
    return best.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[ \t]+') IF x != ''] AS w FROM pieces
), grams AS (
    SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
    FROM split, (VALUES (1), (2), (3)) sizes(k) WHERE len(w) >= k
), f AS MATERIALIZED (
    SELECT lang, k, phrase, string_split(phrase, ' ') AS w, count(*) AS a FROM grams GROUP BY lang, k, phrase
), totals AS (
    SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), often AS MATERIALIZED (
    SELECT * FROM f WHERE a >= 10
), parts AS (
    SELECT lang, phrase, k, a, 1 AS cut, w[1] AS lp, array_to_string(w[2:k], ' ') AS rp FROM often WHERE k >= 2
    UNION ALL SELECT lang, phrase, k, a, 2, array_to_string(w[1:2], ' '), w[3] FROM often WHERE k = 3
), cuts AS (
    SELECT p.lang, p.phrase, p.k, p.a, p.cut, l.a AS l, r.a AS r,
        CAST((1000000::HUGEINT * p.a * p.a) // (l.a::HUGEINT * r.a) AS BIGINT) AS score
    FROM parts p JOIN often l ON l.lang = p.lang AND l.phrase = p.lp JOIN often r ON r.lang = p.lang AND r.phrase = p.rp
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase, k ORDER BY score, cut) = 1
), longer AS (
    SELECT lang, phrase, max(a) AS most FROM (
        SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM often WHERE k = 3
    ) GROUP BY lang, phrase
)
SELECT c.lang, CAST(row_number() OVER (PARTITION BY c.lang ORDER BY c.score DESC, c.a DESC, c.phrase) AS INTEGER) AS rank,
    c.phrase, c.a, c.l, c.r, t.n, c.score
FROM lowest c JOIN totals t ON t.lang = c.lang LEFT JOIN longer h ON c.k = 2 AND h.lang = c.lang AND h.phrase = c.phrase
WHERE h.most IS NULL OR 100 * h.most < 50 * c.a
QUALIFY rank <= 2000
"""
