"""Near-duplicate groups by ProbMinHash over weighted word shingles.

A text is the multiset of its runs of five words; a text of fewer words is one
shingle, a text without words none. The similarity of two texts is the
probability Jaccard index of their shingle counts, which for texts without
repeated shingles is the ordinary Jaccard index.

ProbMinHash: a shingle of weight w arrives at random registers at the points of a
Poisson process of rate w, drawn from the shingle's hash; a register keeps the
shingle that arrives first, and two texts agree in a register with the
probability of their similarity. Arrivals end as soon as none can come before the
last register's: they are drawn up to a time by which all registers are
filled with near certainty, and further only for texts where one is not.

Registers are banded. Texts with equal shingles are one node. In each bucket all
nodes are compared with the smallest one, and verified links give components: a
group of copies costs one pair per member. Only buckets that still hold several
components are looked at again: their nodes are dealt to blocks of about ``BLOCK``,
blocks meet in pairs, and a task compares the nodes of two blocks that are in
different components, with all their shingles. It gives the links that join
components, not the pairs. So no candidate pair between two classes is left out. A pair
whose registers agree in less than ``WORTH`` is not compared (for a similarity of 0.8
that has a probability below 1e-5).

Words are runs of ASCII letters (case folded), digits and characters beyond ASCII, so
punctuation does not tell copies apart. Null texts count as empty;
texts without words are in a class of their own each. Ids may be null or repeated:
the class id is the smallest id of a class (null if it has none else), rows with
equal texts share a class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivermark.llm.components import components
from rivermark.llm.rows import col, free_name, row_key, stored
from rivermark.llm.spans import ALPHANUMERIC, U64, Words, mixed, slices

WIDTH = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4
REGISTERS = BANDS * ROWS
WORTH = 0.6
BLOCK = 512
DENSE = 20_000_000  # cells of a table of nodes and shingles that a task may hold
SIGNED = "key {key}, high long, low long, registers binary"


def shingles(words: Words, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted: owner, hash, count."""
    hashes = words.hashes
    counts = np.where(words.counts > 0, np.maximum(words.counts - width + 1, 1), 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    starts = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + words.first[:-1][owner]
    length = np.minimum(width, words.counts[owner])
    values = length.astype(U64)
    for n in range(width):
        there = n < length
        values[there] = mixed(values[there] * U64(0xD6E8FEB86659FD93) + hashes[starts[there] + n])
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
    at = np.flatnonzero(new)
    return owner[at], values[at], np.diff(np.append(at, len(owner)))


def arrivals(values: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Waiting time (rate 1) and register of each shingle's arrival number ``step``."""
    bits = mixed(values + U64((step * 0x9E3779B97F4A7C15) % 2**64))
    wait = -np.log(((bits >> U64(11)).astype(np.float64) + 0.5) / 2**53)
    return wait, (mixed(bits) % U64(REGISTERS)).astype(np.int64)


def registers(owner: np.ndarray, values: np.ndarray, counts: np.ndarray, texts: int) -> np.ndarray:
    """One row per text: the shingle that reached each register first, 32 bits of its hash."""
    first = np.full((texts, REGISTERS), np.inf)
    winner = np.zeros((texts, REGISTERS), U64)
    weight = np.bincount(owner, counts, texts)
    reach = REGISTERS * (np.log(REGISTERS) + 3.0) / np.maximum(weight, 1)
    limit = reach.copy()
    wait, register = arrivals(values, 0)
    when = wait / counts
    live, steps = np.arange(len(owner)), np.zeros(len(owner), np.int64)
    while len(live):
        now = when[live] <= limit[owner[live]]
        early, late = live[now], live[~now]
        step = 0
        while len(early):
            take(first, winner, owner[early], register[early], when[early], values[early])
            steps[early] += 1
            for step in np.unique(steps[early]):
                same = early[steps[early] == step]
                wait, register[same] = arrivals(values[same], int(step))
                when[same] += wait / counts[same]
            inside = when[early] <= limit[owner[early]]
            late = np.concatenate([late, early[~inside]])
            early = early[inside]
        last = first.max(axis=1)
        live = late[when[late] < last[owner[late]]]
        limit = np.minimum(np.where(np.isinf(last), limit + reach, last), np.inf)
    return (winner >> U64(32)).astype(np.uint32)


def take(first, winner, owner, register, when, values) -> None:
    """Keeps the earliest arrival per register; ties go to the smaller hash."""
    cell = owner * REGISTERS + register
    order = np.lexsort((values, when, cell))
    cell, when, values = cell[order], when[order], values[order]
    head = np.ones(len(cell), bool)
    head[1:] = cell[1:] != cell[:-1]
    cell, when, values = cell[head], when[head], values[head]
    flat, won = first.reshape(-1), winner.reshape(-1)
    better = (when < flat[cell]) | ((when == flat[cell]) & (values < won[cell]))
    flat[cell[better]], won[cell[better]] = when[better], values[better]


def fingerprints(owner: np.ndarray, values: np.ndarray, counts: np.ndarray, texts: int) -> np.ndarray:
    """128 bits over the multiset of shingles."""
    out = np.zeros((texts, 2), U64)
    for half, salt in enumerate((0x2545F4914F6CDD1D, 0xBF58476D1CE4E5B9)):
        np.add.at(out[:, half], owner, mixed(values ^ U64(salt)) * (counts.astype(U64) * U64(2) + U64(1)))
    return mixed(out)


def sign(batches):
    for batch in batches:
        for part in slices(batch, "text"):
            words = Words(part.column("text"), ALPHANUMERIC)
            texts = np.flatnonzero(words.counts > 0)
            owner, values, counts = shingles(words)
            marks = fingerprints(owner, values, counts, part.num_rows)[texts].view(np.int64)
            signature = registers(owner, values, counts, part.num_rows)[texts]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("key").take(pa.array(texts)),
                    pa.array(marks[:, 0]),
                    pa.array(marks[:, 1]),
                    pa.array([row.tobytes() for row in signature], pa.binary()),
                ],
                names=["key", "high", "low", "registers"],
            )


def buckets(batches):
    """One row per node and band; the bucket is a hash of band and registers."""
    for batch in batches:
        rows = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint32).reshape(-1, BANDS, ROWS)
        value = np.broadcast_to(np.arange(1, BANDS + 1).astype(U64), rows.shape[:2])
        for n in range(ROWS):
            value = mixed(value * U64(0xD6E8FEB86659FD93) + rows[:, :, n].astype(U64))
        node = batch.column("node").take(pa.array(np.repeat(np.arange(batch.num_rows), BANDS)))
        band = np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [node, pa.array(value.reshape(-1).view(np.int64)), pa.array(band)], names=["node", "bucket", "band"]
        )


def agreement(batches):
    """Keeps pairs whose registers agree in ``WORTH`` of all or more."""
    for batch in batches:
        left, right = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, REGISTERS)
            for c in ("left", "right")
        )
        yield batch.select(["a", "b"]).filter(pa.array((left == right).mean(axis=1) >= WORTH))


def gather_shingles(batches):
    for batch in batches:
        for part in slices(batch, "text"):
            owner, values, counts = shingles(Words(part.column("text"), ALPHANUMERIC))
            cuts = pa.array(np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32))
            lists = [
                pa.ListArray.from_arrays(cuts, pa.array(values.view(np.int64))),
                pa.ListArray.from_arrays(cuts, pa.array(counts.astype(np.int32))),
            ]
            yield pa.RecordBatch.from_arrays([part.column("node"), *lists], names=["node", "values", "counts"])


def probability_jaccard(left, left_counts, right, right_counts) -> float:
    """Sum over common x of 1 / sum over y of max(left[y] / left[x], right[y] / right[x])."""
    _, at_left, at_right = np.intersect1d(left, right, assume_unique=True, return_indices=True)
    if not len(at_left):
        return 0.0
    only_left, only_right = left_counts.sum() - left_counts[at_left].sum(), right_counts.sum() - right_counts[at_right].sum()
    mine, theirs = left_counts[at_left].astype(float), right_counts[at_right].astype(float)
    ratio = mine / theirs  # the larger share of y, as seen from x: left if ratio[y] > ratio[x]
    order = np.argsort(ratio)
    mine, theirs, ratio = mine[order], theirs[order], ratio[order]
    above = np.append(np.cumsum(mine[::-1])[::-1], 0)  # left counts of y from here on
    below = np.append(0, np.cumsum(theirs))
    after = np.searchsorted(ratio, ratio, "right")
    total = (only_left + above[after]) / mine + (only_right + below[after]) / theirs
    return float((1 / total).sum())


def verify(similarity: float):
    def check(batches):
        for batch in batches:
            columns = [batch.column(c) for c in ("values", "counts", "others", "other_counts")]
            good = []
            for row in zip(*columns):
                good.append(probability_jaccard(*(x.values.to_numpy() for x in row)) >= similarity - 1e-12)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return check


def common_counts(values: list[np.ndarray]) -> np.ndarray | None:
    """Number of common shingles of all pairs, if the table of shared shingles is small enough."""
    kinds, which, times = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    shared = np.cumsum(times > 1) - 1
    width = int((times > 1).sum())
    if width * len(values) > DENSE:
        return None
    table = np.zeros((len(values), width), np.float32)
    owner = np.repeat(np.arange(len(values)), [len(v) for v in values])
    keep = times[which] > 1
    table[owner[keep], shared[which[keep]]] = 1
    return table @ table.T


def compare_blocks(similarity: float):
    """Links between components among the nodes of one bucket's pair of blocks."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        part, block = (np.array(table.column(c).to_pylist()) for c in ("part_code", "block"))
        marks = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint32).reshape(-1, BANDS, ROWS)
        band = table.column("band")[0].as_py()
        values, counts = ([x.values.to_numpy() for x in table.column(c)] for c in ("values", "counts"))
        single = np.array([(c == 1).all() for c in counts])
        sizes = np.array([len(v) for v in values])
        common = common_counts(values)
        parent = {p: p for p in part.tolist()}

        def root(p):
            while parent[p] != p:
                parent[p] = p = parent[parent[p]]
            return p

        links = []
        for a in range(len(part)):
            # each pair once: in its blocks, and in the first band they share
            others = (part != part[a]) & (block != block[a] if table.column("apart")[0].as_py() else True)
            others[: a + 1] = False
            same = marks == marks[a]
            others &= same.mean(axis=(1, 2)) >= WORTH
            others &= same.all(axis=2).argmax(axis=1) == band
            if common is not None and single[a]:
                likely = common[a] >= (similarity - 1e-12) * (sizes + sizes[a] - common[a]) - 1e-6
                others &= likely | ~single
            for b in np.flatnonzero(others).tolist():
                x, y = root(part[a].item()), root(part[b].item())
                if x != y and probability_jaccard(values[a], counts[a], values[b], counts[b]) >= similarity - 1e-12:
                    parent[x] = y
                    links.append((a, b))
        left, right = ([pair[n] for pair in links] for n in (0, 1))
        node = table.column("node").combine_chunks()
        return pa.table({"a": node.take(pa.array(left, pa.int64())), "b": node.take(pa.array(right, pa.int64()))})

    return run


class Candidates:
    """Nodes, buckets and the texts behind them; every table is stored once."""

    def __init__(self, documents: DataFrame, id_column: str, text_column: str, similarity: float):
        self.similarity = similarity
        self.texts = documents.select(
            row_key(id_column, text_column).alias("key"), col(text_column).cast("string").alias("text")
        )
        self.key_type = self.texts.schema["key"].dataType.simpleString()
        signed = self.texts.mapInArrow(sign, SIGNED.format(key=self.key_type))
        node = F.struct("high", "low").alias("node")
        self.signed = stored(signed.select("key", node, "registers"), "signed")
        self.node_type = self.signed.schema["node"].dataType.simpleString()
        self.pair_type = f"a {self.node_type}, b {self.node_type}"
        self.nodes = stored(
            self.signed.groupBy("node").agg(F.min("key").alias("key"), F.first("registers").alias("registers")), "nodes"
        )
        rows = self.nodes.select("node", "registers").mapInArrow(buckets, f"node {self.node_type}, bucket long, band int")
        least = rows.groupBy("bucket").agg(F.min("node").alias("least"), F.max("node").alias("most"), F.count("*").alias("size"))
        self.buckets = stored(rows.join(least.where("least != most").drop("most"), "bucket"), "buckets")

    def shingle_sets(self, nodes: DataFrame) -> DataFrame:
        """(node, values, counts) of distinct ``nodes``."""
        chosen = nodes.join(self.nodes, "node").select("key", "node")
        found = self.texts.join(chosen, "key").select("node", "text")
        sets = found.mapInArrow(gather_shingles, f"node {self.node_type}, values array<long>, counts array<int>")
        return stored(sets.dropDuplicates(["node"]), "shingles")

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of nodes that are similar enough, by registers and then by all shingles."""
        marks = self.nodes.select("node", "registers")
        signed = pairs.join(marks.toDF("a", "left"), "a").join(marks.toDF("b", "right"), "b")
        likely = stored(signed.mapInArrow(agreement, self.pair_type), "likely-pairs")
        sets = self.shingle_sets(likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct())
        both = likely.join(sets.toDF("a", "values", "counts"), "a").join(sets.toDF("b", "others", "other_counts"), "b")
        return both.mapInArrow(verify(self.similarity), self.pair_type)

    def classes(self) -> DataFrame:
        """(node, component) of all nodes with a link."""
        stars = self.buckets.where("node != least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
        links = stored(self.links(stars), "star-links")
        parts = stored(components(links), "components")
        more = stored(self.across(parts), "cross-links")
        return parts if more.isEmpty() else components(links.unionByName(more))

    def across(self, parts: DataFrame) -> DataFrame:
        """Links between components of one bucket that no star has found."""
        part = F.coalesce("component", "node")
        placed = self.buckets.drop("least").join(parts, "node", "left").select(*self.buckets.drop("least").columns, part.alias("part"))
        mixed = placed.groupBy("bucket").agg(F.min("part").alias("first"), F.max("part").alias("last"))
        mixed = mixed.where("first != last").select("bucket")
        open_ = stored(placed.join(mixed, "bucket"), "open-buckets")
        sets = self.shingle_sets(open_.select("node").distinct())
        blocks = F.ceil(F.col("size") / BLOCK).cast("int")
        rows = open_.withColumns({"blocks": blocks, "block": F.pmod(F.xxhash64("node"), blocks).cast("int")})
        facing = F.transform(
            F.sequence(F.lit(0), F.col("blocks") - 1),
            lambda n: F.struct(F.least("block", n).alias("low"), F.greatest("block", n).alias("high")),
        )
        rows = rows.select("bucket", "band", "node", "block", F.xxhash64("part").alias("part_code"), F.explode(facing).alias("pair"))
        rows = rows.withColumn("apart", F.col("pair.low") != F.col("pair.high"))
        rows = rows.join(self.nodes.select("node", "registers"), "node").join(sets, "node")
        return rows.groupBy("bucket", "pair").applyInArrow(compare_blocks(self.similarity), self.pair_type)


def near_duplicates(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """Per document with words: key (id and text hash), first (the class's smallest key) and its node."""
    found = Candidates(documents, id_column, text_column, similarity)
    members = found.signed.select("key", "node").join(found.classes(), "node", "left")
    members = members.select("key", "node", F.coalesce("component", "node").alias("part"))
    firsts = members.groupBy("part").agg(F.min("key").alias("first"), F.count("*").alias("size"))
    return members.join(firsts, "part").select("key", "first", "size", "node")


def near_dup(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, class id (the smallest id of its class), and the rows in the class."""
    rows = documents.select(col(id_column).alias("doc_id"), col(text_column).alias("text"))
    classes = near_duplicates(rows).select(
        F.col("key.id").alias("doc_id"), F.col("first.id").alias("class_id"), F.col("size").alias("class_rows")
    )
    blank = rows.where(~has_words("text")).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_rows")
    )
    return classes.unionByName(blank)


def has_words(column: str):
    return F.coalesce(col(column).cast("string").rlike(r"[0-9A-Za-z]|[^\x00-\x7F]"), F.lit(False))


def one_of_each(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``documents`` with the first document of every class; texts without words all stay."""
    key = free_name(documents, "row_key")
    firsts = stored(near_duplicates(documents, id_column, text_column).select("first").distinct(), "class-firsts")
    keyed = documents.withColumn(key, row_key(id_column, text_column))
    kept = keyed.where(has_words(text_column)).join(firsts.select(F.col("first").alias(key)), key, "left_semi")
    return kept.dropDuplicates([key]).drop(key).unionByName(documents.where(~has_words(text_column)))
