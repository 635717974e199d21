"""Benchmark decontamination by Wu-Manber search for word windows.

A benchmark item is cut into windows of ``WINDOW`` consecutive words; an item of fewer
words is one window. Windows of one length form a pattern set. A document's
words are the symbols: the block of the last two words before the search position
gives, from the shift table, how far the position may move without missing
a window; where the shift is zero, the block's bucket gives the windows that end
in it, and the words themselves are compared before an occurrence counts. All
documents of a batch are searched in step, in stretches of ``STRETCH`` positions, so a
long document is no longer loop than a short one. Nothing is shuffled.

The tables of at most ``CHARACTERS`` of benchmark text are sent to the executors at
once; a larger benchmark is searched for in several passes over the documents, with
the spans found so far written between them.

Words are runs of ASCII letters (case folded), digits and characters beyond ASCII. Null
texts have no words. Items without words have no window, an item without an id
is named by the empty text, rows that share an id are one item. Repeated rows get
equal results.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivermark.llm.rows import col, free_name, stored
from rivermark.llm.spans import ALPHANUMERIC, U64, Words, look_up, mixed, slices

WINDOW = 13
BLOCK = 2
STRETCH = 512
CHARACTERS = 16_000_000
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def joined(hashes: np.ndarray) -> np.ndarray:
    """One hash per row of word hashes."""
    value = np.full(len(hashes), hashes.shape[1], U64)
    for n in range(hashes.shape[1]):
        value = mixed(value * U64(0xD6E8FEB86659FD93) + hashes[:, n])
    return value


class PatternSet:
    """Windows of one length with their shift table and suffix buckets."""

    def __init__(self, length: int, windows: dict[tuple[bytes, ...], set[str]], hashes: dict[bytes, int]):
        self.length, self.block = length, min(BLOCK, length)
        self.windows, self.items = list(windows), [sorted(x) for x in windows.values()]
        table = np.array([[hashes[w] for w in window] for window in self.windows], U64).reshape(-1, length)
        shifts: dict[int, int] = {}
        for end in range(self.block, length + 1):
            for value in joined(table[:, end - self.block : end]).tolist():
                shifts[value] = min(shifts.get(value, length), length - end)
        self.blocks = np.array(sorted(shifts), U64)
        self.shifts = np.array([shifts[b] for b in sorted(shifts)], np.int64)
        self.furthest = length - self.block + 1
        self.buckets: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        whole = joined(table)
        for n, (suffix, value) in enumerate(zip(joined(table[:, -self.block :]).tolist(), whole.tolist())):
            self.buckets[suffix][value].append(n)
        self.buckets = {k: dict(v) for k, v in self.buckets.items()}
        self.whole = np.unique(whole)

    def occurrences(self, words: Words, hashes: np.ndarray) -> Iterator[tuple[int, int]]:
        """(last word, window) of every occurrence."""
        begin, stop = words.first[:-1] + self.length - 1, words.first[1:]
        pieces = np.maximum(-(-(stop - begin) // STRETCH), 0)
        text = np.repeat(np.arange(len(pieces)), pieces)
        at = begin[text] + (np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * STRETCH
        until = np.minimum(at + STRETCH, stop[text])
        back = np.arange(1 - self.block, 1)
        while len(at):
            block = joined(hashes[at[:, None] + back])
            place, known = look_up(self.blocks, block)
            shift = np.where(known, self.shifts[place], self.furthest)
            zero = shift == 0
            if zero.any():
                yield from self.confirmed(words, hashes, at[zero], block[zero])
            at = at + np.maximum(shift, 1)
            live = at < until
            at, until = at[live], until[live]

    def confirmed(self, words: Words, hashes: np.ndarray, at: np.ndarray, block: np.ndarray):
        window = joined(hashes[at[:, None] + np.arange(1 - self.length, 1)])
        _, likely = look_up(self.whole, window)
        for end, suffix, value in zip(at[likely].tolist(), block[likely].tolist(), window[likely].tolist()):
            first = end - self.length + 1
            for n in self.buckets.get(suffix, {}).get(value, ()):
                spans = zip(words.starts[first : end + 1], words.ends[first : end + 1])
                if all(words.raw[s:e].tobytes() == w for (s, e), w in zip(spans, self.windows[n])):
                    yield end, n


def pattern_sets(items: list[tuple[str, str]]) -> list[PatternSet]:
    words = Words(pa.array([text for _, text in items], pa.string()), ALPHANUMERIC)
    raw = words.raw.tobytes()
    strings = [raw[s:e] for s, e in zip(words.starts, words.ends)]
    hashes = dict(zip(strings, words.hashes.tolist()))
    windows: dict[int, dict[tuple[bytes, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
    for n, (name, _) in enumerate(items):
        own = strings[words.first[n] : words.first[n + 1]]
        length = min(WINDOW, len(own))
        for start in range(len(own) - length + 1 if own else 0):
            windows[length][tuple(own[start : start + length])].add(name)
    return [PatternSet(length, found, hashes) for length, found in sorted(windows.items())]


def batches_of_items(benchmark: DataFrame, id_column: str, text_column: str, characters: int) -> Iterator[list]:
    """The benchmark in lists of at most ``characters`` (or one item)."""
    part, used = [], 0
    name, text = F.coalesce(col(id_column).cast("string"), F.lit("")), col(text_column).cast("string")
    for row in benchmark.select(name.alias("name"), text.alias("text")).where("text is not null").toLocalIterator():
        if part and used + len(row.text) > characters:
            yield part
            part, used = [], 0
        part.append((row.name, row.text))
        used += len(row.text)
    yield part


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return [(a, b) for a, b in out]


def search(shared, text_column: str, found_column: str):
    """Adds what the shared pattern sets find to the found column."""

    def run(batches):
        sets = shared.value
        for batch in batches:
            for part in slices(batch, text_column):
                words = Words(part.column(text_column), ALPHANUMERIC)
                hashes, text_of = words.hashes, words.text_of
                spans, items = defaultdict(list), defaultdict(set)
                for patterns in sets:
                    for end, n in patterns.occurrences(words, hashes):
                        text = int(text_of[end])
                        last = end + 1 - int(words.first[text])
                        spans[text].append((last - patterns.length, last))
                        items[text].update(patterns.items[n])
                rows = part.column(found_column).to_pylist()
                for text, row in enumerate(rows):
                    before = [(s["first"], s["end"]) for s in row["spans"]]
                    row["n_words"] = int(words.counts[text])
                    row["spans"] = [{"first": a, "end": b} for a, b in merged(before + spans.get(text, []))]
                    row["items"] = sorted(items.get(text, set()) | set(row["items"]))
                at = part.schema.get_field_index(found_column)
                column = pa.array(rows, part.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(
                    [column if n == at else c for n, c in enumerate(part.columns)], names=part.schema.names
                )

    return run


def with_hits(
    documents: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    characters: int = CHARACTERS,
) -> tuple[DataFrame, str]:
    """``documents`` with one more column, and its name: words, spans of hit words, items found."""
    name = free_name(documents, "found")
    nothing = F.struct(F.lit(0).cast("long"), F.array(), F.array()).cast(FOUND)
    rows, context = documents.withColumn(name, nothing), documents.sparkSession.sparkContext
    for count, items in enumerate(batches_of_items(benchmark, item_id, item_text, characters)):
        rows = stored(rows, "hits") if count else rows
        rows = rows.mapInArrow(search(context.broadcast(pattern_sets(items)), text_column, name), rows.schema)
    return rows, name


def hit_words(found: str):
    return F.aggregate(col(found)["spans"], F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])


def contaminated(found: str):
    """A twentieth of the words, and one at least, lies in windows."""
    return (hit_words(found) > 0) & (20 * hit_words(found) >= col(found)["n_words"])


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row: id, words, hit words, items found and their digest, whether it is contaminated."""
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    rows, found = with_hits(rows, benchmark)
    return rows.select(
        "doc_id",
        col(found)["n_words"].alias("n_words"),
        hit_words(found).alias("n_hit"),
        F.size(col(found)["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(col(found)["items"]), ","), 256).alias("items_sha256"),
        contaminated(found).alias("contaminated"),
    )


def clean(documents: DataFrame, benchmark: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows that are not contaminated."""
    rows, found = with_hits(documents, benchmark, text_column)
    return rows.where(~contaminated(found)).drop(found)


SQL = r"""
WITH cut AS (
    SELECT doc_id, d.rowid AS row, [w FOR w IN regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF w != ''] AS words
    FROM (SELECT *, row_number() OVER () AS rowid FROM documents) d
), items AS (
    SELECT CAST(item_id AS VARCHAR) AS item, [w FOR w IN regexp_split_to_array(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF w != ''] AS words
    FROM benchmark
), patterns AS (
    SELECT DISTINCT item, least(13, len(words)) AS size, array_to_string(words[n : n + least(13, len(words)) - 1], ' ') AS window
    FROM items, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS t(n) WHERE len(words) > 0
), windows AS (
    SELECT row, n, s.size, array_to_string(words[n : n + s.size - 1], ' ') AS window
    FROM cut, (SELECT DISTINCT size FROM patterns) s, unnest(range(1, len(words) - s.size + 2)) AS t(n)
), found AS (
    SELECT row, p.item, n, p.size FROM windows w JOIN patterns p ON w.size = p.size AND w.window = p.window
), hit AS (
    SELECT row, count(DISTINCT place) AS n_hit FROM found, unnest(range(n, n + size)) AS t(place) GROUP BY row
), named AS (
    SELECT row, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM found GROUP BY row
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM cut LEFT JOIN hit USING (row) LEFT JOIN named USING (row)
"""
