"""Removal of passages that an earlier document has, by pairwise alignment.

Every line of at least ``MIN_WORDS`` words is rare enough to be evidence, and so is every run of shorter lines, one after
the other but for empty ones, that is just long enough together (verse, lists, tables). Two letters of a script that is
written without spaces count as a word. Each later
document that holds such a line or run is paired with the first one that does. So a line that many
documents share gives one pair per holder, not all pairs, and no line is left out
for being frequent. Both documents of a pair are aligned by patience diff over line
hashes; common blocks of at least ``MIN_WORDS`` words are deleted from the later one.
What is left of it is aligned again, so moved blocks go as well, and lines and runs that a
document repeats, which patience diff leaves alone, go if the first document has
them. Every such line or run but its first holder's is thus deleted; short lines go only
in a run or inside a block.

Documents are ordered by id (null first), then by a hash of their text; rows with
equal id and text are one document, never compared with each other, and treated
alike. Null texts stay null, a text whose lines all go becomes empty. Lines are cut
at line feeds and compared without the white space around them.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivermark.llm.rows import col, free_name, row_key, stored
from rivermark.llm.spans import U64, mixed

MIN_WORDS = 5
SPACE = r"[\x20\x09-\x0D]+"
UNSPACED = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")  # scripts written without spaces


def size_of(line: Column) -> Column:
    """Words of a line without white space at its ends."""
    spaced = "".join(rf"\p{{Is{script}}}" for script in UNSPACED)
    letters = F.length(F.regexp_replace(line, f"[^{spaced}]+", ""))
    more = F.when(F.octet_length(line) > F.length(line), F.floor(letters / 2).cast("int")).otherwise(0)
    return F.when(line == "", 0).otherwise(F.size(F.split(line, SPACE)) + more)


def line_sequences(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Per document: key and its lines' hashes, second hashes and word counts."""
    bare = lambda line: F.regexp_replace(line, f"^{SPACE}|{SPACE}$", "")
    rows = documents.where(col(text_column).isNotNull()).select(
        row_key(id_column, text_column).alias("key"),
        F.transform(F.split(col(text_column).cast("string"), "\n", -1), bare).alias("lines"),
    )
    return rows.select(
        "key",
        F.transform("lines", lambda line: F.xxhash64(line)).alias("hashes"),
        F.transform("lines", lambda line: F.hash(line)).alias("checks"),
        F.transform("lines", size_of).alias("words"),
    ).dropDuplicates(["key"])


def short_runs(min_words: int):
    """(key, line): for each place the run of short lines that begins there and is just long enough, as one hash."""

    def run(batches):
        for batch in batches:
            hashes, checks, words = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("hashes", "checks", "words"))
            owner = np.repeat(np.arange(batch.num_rows), np.asarray(batch.column("words").value_lengths()))
            filled = np.flatnonzero(words > 0)
            words, owner = words[filled], owner[filled]
            names = [column[filled].astype(np.int64).view(np.uint64) for column in (hashes, checks)]
            sums, longs = (np.concatenate([[0], np.cumsum(x)]) for x in (words, words >= min_words))
            starts = np.flatnonzero(words < min_words)
            ends = np.searchsorted(sums, sums[starts] + min_words)
            whole = ends < len(sums)
            starts, ends = starts[whole], ends[whole]
            sound = (owner[ends - 1] == owner[starts]) & (longs[ends] == longs[starts])
            starts, ends = starts[sound], ends[sound]
            joined = [np.zeros(len(starts), U64) for _ in names]
            for n in range(min_words):
                inside = starts + n < ends
                for value, name in zip(joined, names):
                    value[inside] = mixed(value[inside] * U64(31) + name[starts[inside] + n] + U64(1))
            line = pa.StructArray.from_arrays(
                [pa.array(joined[0].view(np.int64)), pa.array(joined[1].astype(np.uint32).view(np.int32))], names=["hashes", "checks"]
            )
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(owner[starts])), line], names=["key", "line"])

    return run


def overlapping(sequences: DataFrame, min_words: int) -> DataFrame:
    """Pairs (key, first): ``first`` is the first document with one of the later document's long lines or runs."""
    key = sequences.schema["key"].dataType.simpleString()
    long = (
        sequences.select("key", F.explode(F.arrays_zip("hashes", "checks", "words")).alias("line"))
        .where(F.col("line.words") >= min_words)
        .select("key", F.struct("line.hashes", "line.checks").alias("line"))
    )
    runs = sequences.mapInArrow(short_runs(min_words), f"key {key}, line struct<hashes: long, checks: int>")
    lines = long.unionByName(runs)
    firsts = lines.groupBy("line").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    # stored, as an aggregate beside the join would keep a line that very many documents hold in one task
    shared = stored(firsts.where("first != last").select("line", "first"), "shared-lines")
    return lines.join(shared, "line").where("key != first").select("key", "first").distinct()


def patience(later: list, earlier: list) -> list[tuple[int, int]]:
    """Index pairs of an alignment: equal ends, then lines unique in both, recursively between them."""
    matched, gaps = [], [(0, len(later), 0, len(earlier))]
    while gaps:
        i, i_end, j, j_end = gaps.pop()
        while i < i_end and j < j_end and later[i] == earlier[j]:
            matched.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and later[i_end - 1] == earlier[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            matched.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        mine, theirs = Counter(later[i:i_end]), Counter(earlier[j:j_end])
        place = {line: n for n, line in enumerate(earlier[j:j_end], j) if theirs[line] == 1}
        points = [(n, place[line]) for n, line in enumerate(later[i:i_end], i) if mine[line] == 1 and line in place]
        anchors = increasing(points)
        edges = [(i - 1, j - 1), *anchors, (i_end, j_end)]
        if anchors:
            matched += anchors
            gaps += [(a + 1, c, b + 1, d) for (a, b), (c, d) in zip(edges, edges[1:])]
    return sorted(matched)


def increasing(points: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest run of points that rises in both places."""
    tails, ends, before = [], [], []
    for n, (_, j) in enumerate(points):
        k = bisect_left(tails, j)
        before.append(ends[k - 1] if k else -1)
        tails[k : k + 1] = [j]
        ends[k : k + 1] = [n]
    run, n = [], ends[-1] if ends else -1
    while n >= 0:
        run.append(points[n])
        n = before[n]
    return run[::-1]


def runs_of(lines: list, words: list[int], min_words: int) -> list[list[int]]:
    """Places of each run of short lines that is just long enough."""
    filled = [n for n in range(len(lines)) if words[n]]
    found = []
    for at in range(len(filled)):
        size, run = 0, []
        for n in filled[at:]:
            if words[n] >= min_words:
                break
            size += words[n]
            run.append(n)
            if size >= min_words:
                found.append(run)
                break
    return found


def common_lines(later: list, words: list[int], earlier: list, their_words: list[int], min_words: int) -> set[int]:
    """Lines of the later document to delete."""
    if later == earlier:
        return set(range(len(later))) if sum(words) >= min_words else set()
    known, gone, rest = set(earlier), set(), list(range(len(later)))
    while rest:
        found: set[int] = set()
        block: list[tuple[int, int]] = []
        aligned = [(rest[i], j) for i, j in patience([later[n] for n in rest], earlier)]
        for pair in [*aligned, None]:
            if block and (pair is None or pair != (block[-1][0] + 1, block[-1][1] + 1)):
                if sum(words[i] for i, _ in block) >= min_words:
                    found.update(i for i, _ in block)
                block = []
            block.append(pair)
        if not found:
            break
        gone |= found
        rest = [n for n in rest if n not in found]
    gone |= {n for n in rest if words[n] >= min_words and later[n] in known}
    mine = [run for run in runs_of(later, words, min_words) if not gone.issuperset(run)]
    if mine:
        theirs = {tuple(earlier[n] for n in run) for run in runs_of(earlier, their_words, min_words)}
        gone.update(n for run in mine if tuple(later[n] for n in run) in theirs for n in run)
    return gone


def align_pairs(min_words: int):
    def align(batches):
        for batch in batches:
            cut = []
            for pair in zip(*(batch.column(c).to_pylist() for c in ("hashes", "words", "others", "their_words"))):
                cut.append(sorted(common_lines(*pair, min_words)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(cut, pa.list_(pa.int32()))], names=["key", "cut"]
            )

    return align


def as_masks(batches):
    """Sorted places to one flag per line."""
    for batch in batches:
        masks = []
        for cut, lines in zip(batch.column("cut").to_pylist(), batch.column("lines").to_pylist()):
            mask = [True] * lines
            for n in cut:
                mask[n] = False
            masks.append(mask)
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(masks, pa.list_(pa.bool_()))], names=["key", "keep"]
        )


def kept_lines(documents: DataFrame, id_column: str, text_column: str, min_words: int) -> DataFrame:
    """Per document that loses lines: key and a flag for each line."""
    sequences = stored(line_sequences(documents, id_column, text_column), "line-sequences")
    pairs = overlapping(sequences, min_words)
    theirs = sequences.select(F.col("key").alias("first"), F.col("hashes").alias("others"), F.col("words").alias("their_words"))
    both = pairs.join(theirs, "first").join(sequences, "key").select("key", "hashes", "words", "others", "their_words")
    key = sequences.schema["key"].dataType.simpleString()
    cuts = both.mapInArrow(align_pairs(min_words), f"key {key}, cut array<int>").where("size(cut) > 0")
    places = cuts.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list("cut"))).alias("cut"))
    sized = places.join(sequences.select("key", F.size("hashes").alias("lines")), "key")
    return sized.select("key", "cut", "lines").mapInArrow(as_masks, f"key {key}, keep array<boolean>")


def deduplicated(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS
) -> tuple[DataFrame, str]:
    """``documents`` without the passages, and the name of the added column: the lines' flags, null if none went."""
    keep, key = free_name(documents, "keep_lines"), free_name(documents, "line_key")
    flags = kept_lines(documents, id_column, text_column, min_words).select(
        F.col("key").alias(key), F.col("keep").alias(keep)
    )
    flags = stored(flags, "kept-lines")
    joined = documents.withColumn(key, row_key(id_column, text_column)).join(flags, key, "left")
    lines = F.split(col(text_column).cast("string"), "\n", -1)
    left = F.array_join(F.filter(lines, lambda _, n: F.element_at(col(keep), n + 1)), "\n")
    text = F.when(col(keep).isNull(), col(text_column)).otherwise(left).alias(text_column)
    return joined.select(*[text if c == text_column else col(c) for c in documents.columns], col(keep)), keep


def line_dedup(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, number of lines, places of the removed ones, and the text that is left."""
    rows = documents.select(col(id_column).alias("doc_id"), col(text_column).alias("text"))
    rows = rows.withColumn("n_lines", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long"))
    result, keep = deduplicated(rows)
    flags = F.coalesce(col(keep), F.array().cast("array<boolean>"))
    removed = F.filter(F.transform(flags, lambda flag, n: F.when(~flag, n)), lambda n: n.isNotNull())
    return result.select("doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"), "text")
