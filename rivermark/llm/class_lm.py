"""Language-model scores by Brown's class-based bigrams.

P(word | word before) = P(class | class before) * P(word | class). Classes come from exchange
clustering: a word is moved to the class in which the likelihood of all neighbouring words is greatest, until
nothing is gained. It is done in two steps.

* *Classes of the word before.* Units are the ``CORE`` most frequent words, and groups of the other words by their last bytes
  (``TAILS`` groups), so every word, known or not, has a unit. Units are exchanged in turns on the driver,
  by the table of neighbouring units, whose size CORE and TAILS fix and which is counted over all training texts.
* *Classes of the word itself.* Every training word, however rare, is exchanged by what stands before it: how
  often which class does is counted once for each word, and in each of ``ROUNDS`` the tasks that hold these counts choose the best class
  for each of their words by the table of classes before classes, which is sent to them. The
  table is then counted anew. Words move all at once, by a rule that never lowers the likelihood. It begins with the units' classes,
  and a word stays there unless there is evidence: what stood before a word that was seen once or twice says little of it.

A word that is not in the training texts has the class that most training words with its last bytes have, core words left out. The text end is a class of
its own, and what stands before the first word.

Words are far too many to send to every executor. Documents are dealt to chunks of about ``CHUNK`` bytes
by a hash; a chunk counts its own words once, all chunks' counts of a word are added up, and each
chunk gets the sums and classes of just its words back. So what is shuffled are distinct words per chunk, not words.
Counts of one word from very many tasks are merged in ``MERGED`` at a time first.

Tokens are runs of anything but white space, A-Z lower-cased, and one end per text; null texts are empty. Repeated
rows count and are scored each. Without training texts all words are unknown. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivermark.llm.rows import col, in_training, stored
from rivermark.llm.spans import NOT_SPACE, U64, Words, look_up, mixed, slices, sums_by

CORE, TAILS, CLASSES = 400, 256, 64
TAIL_BYTES = 3
CHUNK = 16 << 20
SWEEPS = 20  # over the units
ROUNDS = 2  # over all words
HOME = 3.0  # a word leaves its unit's class when that makes what stands before it exp(HOME) times likelier
MERGED = 64
PRIOR = 1.0  # of a class after a class
ADDED = 1.0  # to the count of every word of a class
END = U64(3)  # stands for the end of a text among word hashes
UNITS = CORE + TAILS + 1
BOUNDARY = UNITS - 1


def tails(words: Words) -> np.ndarray:
    """Group of each word by its last bytes."""
    starts = np.maximum(words.starts, words.ends - TAIL_BYTES)
    value = np.zeros(len(words), U64)
    for n in range(TAIL_BYTES):
        at = starts + n
        inside = at < words.ends
        value[inside] = value[inside] * U64(257) + words.raw[at[inside]].astype(U64) + U64(1)
    return (mixed(value) % U64(TAILS)).astype(np.int32)


def chunked(documents: DataFrame, id_column: str, text_column: str, training) -> tuple[DataFrame, int]:
    """(chunk, id, text, training) with chunks of about CHUNK bytes, and the number of chunks."""
    text = F.coalesce(col(text_column).cast("string"), F.lit(""))
    size = documents.agg(F.sum(F.octet_length(text))).first()[0] or 0
    count = size // CHUNK + 1
    chunk = F.pmod(F.xxhash64(col(id_column), text), F.lit(count)).cast("int")
    rows = documents.select(chunk.alias("chunk"), col(id_column).alias("id"), text.alias("text"), training.alias("training"))
    return rows, count


def batches_of(table: pa.Table):
    for batch in table.combine_chunks().to_batches():
        yield from slices(batch, "text")


def words_of_chunk(table: pa.Table) -> pa.Table:
    """Distinct words of a chunk with their number in training texts."""
    found: list[np.ndarray] = []
    for part in batches_of(table):
        words = Words(part.column("text"), NOT_SPACE)
        training = part.column("training").to_numpy(zero_copy_only=False)
        hashes, which = np.unique(words.hashes, return_inverse=True)
        n = np.bincount(which, training[words.text_of].astype(float), len(hashes))
        found.append(np.stack([hashes.view(np.int64), n.astype(np.int64)]))
        found.append(np.array([[int(END)], [int(training.sum())]], np.int64))
    every = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    hashes, which = np.unique(every[0], return_inverse=True)
    n = np.bincount(which, every[1].astype(float), len(hashes)).astype(np.int64)
    chunk = np.full(len(hashes), table.column("chunk")[0].as_py() if table.num_rows else 0, np.int32)
    return pa.table({"chunk": chunk, "word": hashes, "n": n})


def vocabulary(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chunk, word, n), each chunk's words with their number in its training texts, and (word, total) of the training texts."""
    words = stored(chunks.groupBy("chunk").applyInArrow(words_of_chunk, "chunk int, word long, n long"), "chunk-words")
    totals = words.where("n > 0").groupBy("word").agg(F.sum("n").alias("total"))
    return words, stored(totals, "word-totals")


def units_of(words: Words, hashes: np.ndarray, core: np.ndarray) -> np.ndarray:
    at, known = look_up(core, hashes)
    return np.where(known, at, CORE + tails(words))


def with_boundaries(values: np.ndarray, counts: np.ndarray, boundary) -> tuple[np.ndarray, np.ndarray]:
    """Each text's values and a boundary after them; the text of each."""
    text = np.repeat(np.arange(len(counts)), counts + 1)
    out = np.full(len(text), boundary, values.dtype)
    ends = np.cumsum(counts + 1) - 1
    inside = np.ones(len(text), bool)
    inside[ends] = False
    out[inside] = values
    return out, text


def count_neighbours(core: np.ndarray):
    """Neighbouring units of training texts, added up per task."""

    def run(batches):
        table = np.zeros(UNITS * UNITS, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"), NOT_SPACE)
                units, _ = with_boundaries(units_of(words, words.hashes, core), words.counts, BOUNDARY)
                before = np.append(BOUNDARY, units[:-1])
                table += np.bincount(before * UNITS + units, minlength=len(table))
        pairs = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int32)), pa.array(table[pairs])], names=["pair", "n"])

    return run


def x_log_x(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(pairs: np.ndarray) -> np.ndarray:
    """Class of every unit, from the counts of neighbouring units. The boundary keeps class CLASSES."""
    free = len(pairs) - 1
    weight = pairs.sum(axis=1)
    classes = np.full(len(pairs), CLASSES)
    classes[:free][np.argsort(-weight[:free], kind="stable")] = np.arange(free) % CLASSES
    members = np.zeros((len(pairs), CLASSES + 1))
    members[np.arange(len(pairs)), classes] = 1
    table = members.T @ pairs @ members
    sizes = members.T @ weight
    for _ in range(SWEEPS):
        moved = 0
        for unit in np.argsort(-weight[:free], kind="stable"):
            if not weight[unit]:
                continue
            members[unit] = 0
            after, before, itself = pairs[unit] @ members, pairs[:, unit] @ members, pairs[unit, unit]
            after[-1], before[-1] = pairs[unit, -1], pairs[-1, unit]
            old = classes[unit]
            table[old] -= after
            table[:, old] -= before
            table[old, old] -= itself
            sizes[old] -= weight[unit]
            gain = (x_log_x(table + after) - x_log_x(table)).sum(axis=1)
            gain += (x_log_x(table + before[:, None]) - x_log_x(table)).sum(axis=0)
            own = np.diag(table)
            gain += x_log_x(own + after + before + itself) + x_log_x(own)
            gain -= x_log_x(own + after) + x_log_x(own + before)
            gain -= 2 * (x_log_x(sizes + weight[unit]) - x_log_x(sizes))
            new = int(gain[:CLASSES].argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = old
            moved += new != old
            classes[unit] = new
            members[unit, new] = 1
            table[new] += after
            table[:, new] += before
            table[new, new] += itself
            sizes[new] += weight[unit]
        if not moved:
            break
    return classes


def class_contexts(core: np.ndarray, classes: np.ndarray, salts: int):
    """(word, unit, steps, salt): for each word of a task's training texts what classes stand before it, and how often,
    as numbers class + 128 * count."""

    def counted(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        word, unit, before, n = (np.concatenate(column) for column in zip(*parts))
        order = np.lexsort((before, word))
        word, unit, before, n = word[order], unit[order], before[order], n[order]
        first = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (before[1:] != before[:-1])))
        return word[first], unit[first], before[first], np.add.reduceat(n, first)

    def rows(parts, number: int) -> pa.RecordBatch:
        word, unit, before, n = counted(parts)
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        steps = pa.ListArray.from_arrays(pa.array(np.append(starts, len(word)).astype(np.int32)), pa.array(before + 128 * n))
        salt = np.full(len(starts), number % salts, np.int32)
        columns = [pa.array(word[starts].view(np.int64)), pa.array(unit[starts].astype(np.int32)), steps, pa.array(salt)]
        return pa.RecordBatch.from_arrays(columns, names=["word", "unit", "steps", "salt"])

    def run(batches):
        parts, size, number = [], 0, TaskContext.get().partitionId() * 7919
        for batch in batches:
            for part in slices(batch, "text"):
                words = Words(part.column("text"), NOT_SPACE)
                hashes, _ = with_boundaries(words.hashes, words.counts, END)
                units, _ = with_boundaries(units_of(words, words.hashes, core), words.counts, BOUNDARY)
                before = np.append(CLASSES, classes[units][:-1]).astype(np.int64)
                parts.append(counted([(hashes, units, before, np.ones(len(hashes), np.int64))]))
                size += len(words.raw)
                if size >= CHUNK:
                    yield rows(parts, number)
                    parts, size, number = [], 0, number + 1
        if parts:
            yield rows(parts, number)

    return run


def merge_contexts(table: pa.Table) -> pa.Table:
    """Rows of equal words added up."""
    lists = table.column("steps").combine_chunks()
    sizes = np.asarray(lists.value_lengths())
    word = np.repeat(table.column("word").to_numpy(), sizes)
    unit = np.repeat(table.column("unit").to_numpy(), sizes)
    packed = np.asarray(lists.flatten())
    before, n = packed % 128, packed // 128
    order = np.lexsort((before, word))
    word, unit, before, n = word[order], unit[order], before[order], n[order]
    first = np.flatnonzero(np.append(True, (word[1:] != word[:-1]) | (before[1:] != before[:-1])))[: len(word)]
    word, unit, before, n = word[first], unit[first], before[first], np.add.reduceat(n, first) if len(first) else n
    starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))[: len(word)]
    steps = pa.ListArray.from_arrays(pa.array(np.append(starts, len(word)).astype(np.int32)), pa.array(before + 128 * n))
    return pa.table({"word": word[starts], "unit": unit[starts], "steps": steps})


def all_contexts(texts: DataFrame, core: np.ndarray, classes: np.ndarray, chunks: int) -> DataFrame:
    """(word, unit, steps) of all training words, stored."""
    salts = chunks // MERGED + 1
    schema = "word long, unit int, steps array<long>"
    rows = texts.mapInArrow(class_contexts(core, classes, salts), f"{schema}, salt int")
    bucket = F.pmod(F.xxhash64("word"), F.lit(chunks))
    if salts > 1:
        rows = rows.groupBy(bucket.alias("bucket"), "salt").applyInArrow(merge_contexts, schema)
    return stored(rows.groupBy(bucket.alias("bucket")).applyInArrow(merge_contexts, schema), "contexts")


def unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Row of each step, class before, count; and each row's first step."""
    lists = batch.column("steps")
    sizes = np.asarray(lists.value_lengths())
    packed = np.asarray(lists.flatten())
    return np.repeat(np.arange(len(sizes)), sizes), packed % 128, packed // 128, np.cumsum(sizes) - sizes


def best_classes(table: np.ndarray, owner, before, n, starts, now: np.ndarray, home: np.ndarray) -> np.ndarray:
    """For each word the class that makes what stands before it likeliest, by the table of classes before (rows) and classes
    (columns), where ``home`` has an advantage of HOME; the present one if none is better.

    The likelihood of all words is the greatest sum of these over all conditional distributions, so moving every word at once
    never lowers it (with HOME for each word at home), and nor does counting the table anew.
    """
    free = table[:, :CLASSES]
    share = np.log(np.maximum(free, 1)) - np.log(np.maximum(free.sum(axis=0), 1))
    value = np.add.reduceat(n[:, None] * np.where(free > 0, share, NEVER)[before], starts, axis=0)
    rows = np.arange(len(now))
    value[rows, home] += HOME
    value[rows, now] += 1e-9 * np.abs(value[rows, now])
    return value.argmax(axis=1)


NEVER = -50.0  # log of what a class has not been seen after; below all that have been
PART = 1 << 14  # steps weighed at once


def reassign(table: np.ndarray, unit_classes: np.ndarray):
    """(word, unit, steps, class) with new classes."""

    def run(batches):
        for batch in batches:
            owner, before, n, starts = unpacked(batch)
            now = batch.column("class").to_numpy()
            home = np.minimum(unit_classes[batch.column("unit").to_numpy()], CLASSES - 1)
            found, row = now.astype(np.int32), 0
            while row < len(now):
                end = max(row + 1, int(np.searchsorted(starts, starts[row] + PART)))
                low, high = starts[row], starts[end] if end < len(now) else len(n)
                mine = np.minimum(now[row:end], CLASSES - 1)
                part = best_classes(table, owner[low:high] - row, before[low:high], n[low:high], starts[row:end] - low, mine, home[row:end])
                found[row:end] = np.where(now[row:end] == CLASSES, CLASSES, part)  # the text end keeps its own
                row = end
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found)], names=batch.schema.names)

    return run


def table_of(batches):
    """Classes before classes, added up per task."""
    table = np.zeros((CLASSES + 1) ** 2, np.int64)
    for batch in batches:
        owner, before, n, _ = unpacked(batch)
        at = before * (CLASSES + 1) + batch.column("class").to_numpy()[owner]
        np.add.at(table, at, n)
    pairs = np.flatnonzero(table)
    yield pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int32)), pa.array(table[pairs])], names=["pair", "n"])


def counted_table(assigned: DataFrame) -> np.ndarray:
    pairs = assigned.mapInArrow(table_of, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((CLASSES + 1) ** 2)
    table[pairs.column("pair").to_numpy()] = pairs.column("n").to_numpy()
    return table.reshape(CLASSES + 1, CLASSES + 1)


def likelihood(table: np.ndarray) -> float:
    """What depends on the classes in the log-likelihood of the words, given the classes before them."""
    return x_log_x(table).sum() - x_log_x(table.sum(axis=0)).sum()


def exchanged(contexts: DataFrame, unit_classes: np.ndarray) -> tuple[DataFrame, np.ndarray]:
    """(word, unit, steps, class) after the last round, and its table."""
    of_unit = F.array(*(F.lit(int(c)) for c in unit_classes))
    assigned = contexts.withColumn("class", F.element_at(of_unit, F.col("unit") + 1))
    for _ in range(ROUNDS):
        table = counted_table(assigned)
        assigned = stored(assigned.mapInArrow(reassign(table, unit_classes), "word long, unit int, steps array<long>, class int"), "assigned")
    return assigned, counted_table(assigned)


@dataclass
class Model:
    core: np.ndarray  # sorted hashes of the core words
    classes: np.ndarray  # of each unit, as the word before
    unknown: np.ndarray  # class of words that are not in the training texts, by tail
    steps: np.ndarray  # log10 P(class | class before)
    sizes: np.ndarray  # log10 of each class's words with what is added
    tokens: int
    kinds: int

    def score(self, texts: pa.Array, keys: np.ndarray, totals: np.ndarray, own: np.ndarray) -> dict[str, np.ndarray]:
        """keys, totals, own: sorted words of the texts with their number in training texts, 0 if none, and their class."""
        words = Words(texts, NOT_SPACE)
        hashes, text = with_boundaries(words.hashes, words.counts, END)
        units, _ = with_boundaries(units_of(words, words.hashes, self.core), words.counts, BOUNDARY)
        tail, _ = with_boundaries(tails(words), words.counts, np.int32(0))
        at, known = look_up(keys, hashes)
        n = np.where(known, totals[at], 0) if len(totals) else np.zeros(len(hashes))
        ends = units == BOUNDARY
        classes = np.where(n > 0, own[at] if len(own) else 0, self.unknown[tail])
        classes[ends] = CLASSES
        before = np.append(CLASSES, self.classes[units][:-1])
        emitted = np.where(ends, 0.0, np.log10(n + ADDED) - self.sizes[classes])
        base = np.log10((n + 1) / (self.tokens + self.kinds + 1))
        count = len(texts)
        return {
            "n_tokens": words.counts + 1,
            "n_known": sums_by(text, (n > 0).astype(float), count).astype(np.int64),
            "base_score": sums_by(text, base, count),
            "score": sums_by(text, self.steps[before, classes] + emitted, count),
        }


def train(chunks: DataFrame, totals: DataFrame, chunk_count: int) -> tuple[Model, DataFrame]:
    """The model of the chunks' training texts, and (word, class) of all their words."""
    top = totals.where(F.col("word") != int(END)).orderBy(F.desc("total"), "word").limit(CORE).toArrow()
    core = np.sort(top.column("word").to_numpy().astype(np.int64).view(np.uint64))
    texts = chunks.where("training").select("text")
    pairs = texts.mapInArrow(count_neighbours(core), "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(UNITS * UNITS)
    table[pairs.column("pair").to_numpy().astype(np.int64)] = pairs.column("n").to_numpy()
    classes = exchange(table.reshape(UNITS, UNITS))
    assigned, between = exchanged(all_contexts(texts, core, classes, chunk_count), classes)
    share = (between.sum(axis=0) + 1) / (between.sum() + CLASSES + 1)
    steps = np.log10((between + PRIOR * share) / (between.sum(axis=1, keepdims=True) + PRIOR))
    per_unit = assigned.where(F.col("class") < CLASSES).groupBy("unit", "class").agg(F.count("*").alias("kinds")).toArrow()
    kinds = np.zeros((UNITS, CLASSES + 1))
    kinds[per_unit.column("unit").to_numpy(), per_unit.column("class").to_numpy()] = per_unit.column("kinds").to_numpy()
    of_tail = kinds[CORE : CORE + TAILS]
    unknown = np.where(of_tail.sum(axis=1) > 0, of_tail.argmax(axis=1), classes[CORE : CORE + TAILS])
    sizes = np.log10(between.sum(axis=0) + ADDED * (kinds.sum(axis=0) + 1))
    counts = totals.agg(F.sum("total").alias("tokens"), F.count("*").alias("kinds")).first()
    model = Model(core, classes, unknown, steps, sizes, counts.tokens or 0, counts.kinds)
    return model, assigned.select("word", "class")


def score_chunks(model: Model):
    def run(documents: pa.Table, words: pa.Table) -> pa.Table:
        keys = words.column("word").to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(keys)
        keys, totals, own = keys[order], words.column("total").to_numpy()[order], words.column("class").to_numpy()[order]
        out = []
        for part in batches_of(documents):
            found = model.score(part.column("text"), keys, totals, own)
            rows = {"doc_id": part.column("id"), "held_out": pa.array(~part.column("training").to_numpy(zero_copy_only=False))}
            rows |= {name: pa.array(found[name]) for name in ("n_tokens", "n_known")}
            rows["train_tokens"] = pa.array(np.full(part.num_rows, model.tokens, np.int64))
            out.append(pa.table(rows | {name: pa.array(found[name]) for name in ("base_score", "score")}))
        schema = [("doc_id", documents.schema.field("id").type), ("held_out", pa.bool_())]
        schema += [(n, pa.int64()) for n in ("n_tokens", "n_known", "train_tokens")]
        empty = pa.schema([*schema, ("base_score", pa.float64()), ("score", pa.float64())]).empty_table()
        return pa.concat_tables(out) if out else empty

    return run


def scored(documents: DataFrame, training, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, tokens, known ones, training tokens, unigram and model log10 probability.
    ``training`` is a condition: which rows to learn from."""
    chunks, count = chunked(documents, id_column, text_column, training)
    words, totals = vocabulary(chunks)
    model, classes = train(chunks, totals, count)
    # both sides of the first join have a word once; what a chunk gets back is stored, so a frequent word's rows are split
    known = stored(totals.join(classes, "word"), "word-classes")
    given = words.select("chunk", "word").join(known, "word").select("chunk", "word", "total", "class")
    kind = chunks.schema["id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    both = chunks.groupBy("chunk").cogroup(given.groupBy("chunk"))
    return both.applyInArrow(score_chunks(model), schema)


def class_lm(documents: DataFrame) -> DataFrame:
    """Scores of all documents, learned from those that are not held out, with perplexity per token."""
    result = scored(documents, in_training("doc_id", 7, 2))
    return result.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
