"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text is cut into words wherever no piece holds the two characters side by side, as at the start of a
run of spaces (written as U+2581 in pieces); so no piece reaches across a cut. The distinct words of a batch
that are not known yet are sorted, which is a trie walked depth-first: neighbours share their common prefix,
and the forward states up to its end are kept, so every prefix is scored once.

The forward state of a prefix is the last piece of its best segmentation. For a
unigram model that is the piece with the best sum of scores. For a BPE model it
is the one piece that may follow the segmentation before it: two pieces
may stand side by side if merging their text by the model gives back the two, a
text whose neighbours all may is the model's own result, and each prefix of
that result is one too. So ids equal the model's for both kinds.

Characters without a piece become their UTF-8 bytes' pieces. A literal U+2581 also
does, unlike a space, so decoding gives back every text exactly (white space, controls
and long words included). Null stays null; the empty text has no ids.

Models need byte pieces, no normalisation rules, and marks before words.
The vocabulary, which is of fixed size, is sent to the executors; texts are encoded row by row
without a shuffle, in parts of about ``PART`` bytes, and one worker of a task also decodes them. It keeps about ``CACHED`` words, of ``LONG`` characters on average at most, with
their ids and as many tested pairs. Of too many words the half met in most batches stays.
"""

from __future__ import annotations

from hashlib import sha256
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivermark.llm.rows import col, free_name
from rivermark.llm.spans import slices, text_bytes

MARK = "▁"
CACHED = 150_000
PART = 1 << 18  # bytes of text that are encoded and decoded at once; their arrays are many times as large
LONG = 64  # characters; longer words are not kept when there is too much
KINDS = 1024  # of characters; more characters than that share kinds, which only makes fewer cuts
NORMAL, BYTE = 1, 6
UNIGRAM, BPE = 1, 2
IDS = T.ArrayType(T.IntegerType())


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all ranges, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Vocabulary:
    """Pieces of a model with scores, byte pieces, and the model's kind."""

    def __init__(self, kind: int, pieces: list[tuple[str, float, int]]):
        self.kind = kind
        self.digest = sha256(repr((kind, pieces)).encode()).hexdigest()
        self.ids = {text: n for n, (text, _, sort) in enumerate(pieces) if sort == NORMAL}
        self.scores = {text: score for text, score, sort in pieces if sort == NORMAL}
        byte = {int(text[3:5], 16): n for n, (text, _, sort) in enumerate(pieces) if sort == BYTE}
        if kind not in (UNIGRAM, BPE) or len(byte) != 256 or any(MARK in t.lstrip(MARK) for t in self.ids):
            raise ValueError("needs a unigram or BPE model with byte pieces and marks before words")
        self.bytes = [byte[n] for n in range(256)]
        self.longest = max(map(len, self.ids), default=1)
        self.unknown = min(self.scores.values(), default=0.0) - 10
        single = {n: bytes([b]) for b, n in byte.items()}
        text = lambda t, sort: t.replace(MARK, " ").encode() if sort == NORMAL else b""
        self.content = [single.get(n, text(t, sort)) for n, (t, _, sort) in enumerate(pieces)]

    def joins(self) -> tuple[np.ndarray, np.ndarray]:
        """The kind of every character (0: in no piece; U+2581 is written as a space), and
        whether some piece holds a character of one kind right before one of another."""
        others = sorted({c for t in self.ids for c in t} - {MARK, " "})
        kind = {c: 2 + n % (KINDS - 2) for n, c in enumerate(others)} | {MARK: 1}
        kinds, joined = np.zeros(0x110000, np.uint16), np.zeros((KINDS, KINDS), bool)
        for c, n in kind.items():
            kinds[ord(" " if c == MARK else c)] = n
        for left, right in {t[n : n + 2] for t in self.ids for n in range(len(t) - 1)}:
            joined[kind.get(left, 0), kind.get(right, 0)] = True
        joined[0], joined[:, 0] = False, False
        return kinds, joined

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        from sentencepiece import sentencepiece_model_pb2 as format

        with open(path, "rb") as file:
            return cls.parsed(format.ModelProto.FromString(file.read()))

    @classmethod
    def parsed(cls, model) -> Vocabulary:
        rules, trained = model.normalizer_spec, model.trainer_spec
        plain = rules.escape_whitespaces and rules.add_dummy_prefix and not rules.remove_extra_whitespaces
        if not plain or rules.precompiled_charsmap or trained.treat_whitespace_as_suffix:
            raise ValueError("needs a model without normalisation rules, with a mark before the first word")
        sorts = {p.type for p in model.pieces}
        if sorts - {1, 2, 3, BYTE}:
            raise ValueError("user-defined and unused pieces are not supported")
        return cls(trained.model_type, [(p.piece, p.score, p.type) for p in model.pieces])


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.content = pa.array(vocabulary.content, pa.large_binary())
        self.kinds, self.joined = vocabulary.joins()
        self.known: dict[str, int] = {}  # places in the next three
        self.starts, self.sizes, self.uses = (np.zeros(0, np.int64) for _ in range(3))
        self.flat, self.characters = np.zeros(0, np.int32), 0
        self.forget_tests()

    def forget_tests(self) -> None:
        self.tested: dict[str, dict[str, bool]] = {}
        self.tests = 0

    def forget_words(self) -> None:
        """Keeps the half met in most batches, of equals the latest; what was met long ago counts less each time."""
        words = list(self.known)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        keep = np.argsort(np.where(lengths <= LONG, self.uses, -1), kind="stable")[-(CACHED // 2) :]
        keep = np.sort(keep[lengths[keep] <= LONG])
        self.known = {words[n]: place for place, n in enumerate(keep.tolist())}
        self.characters = int(lengths[keep].sum())
        self.flat = self.flat[ranges(self.starts[keep], self.sizes[keep])]
        self.sizes, self.uses = self.sizes[keep], self.uses[keep] // 2
        self.starts = np.cumsum(self.sizes) - self.sizes

    def merged(self, text: str) -> list[str]:
        """The BPE merges of a short text: the best pair first, the leftmost of equals."""
        parts, scores = list(text), self.vocabulary.scores
        while len(parts) > 1:
            best, at = None, -1
            for n in range(len(parts) - 1):
                score = scores.get(parts[n] + parts[n + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, n
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def beside(self, left: str, right: str) -> bool:
        """Whether BPE leaves the two pieces side by side; ``left`` may be empty."""
        fits = self.tested.setdefault(left, {})
        if right not in fits:
            fits[right] = self.merged(left + right) == ([left, right] if left else [right])
            self.tests += 1
        return fits[right]

    def last_by_merges(self, word: str, end: int, size: list[int], score: list[float]) -> None:
        """The only piece that fits, so the likely lengths are tried first."""
        ids, tested = self.vocabulary.ids, self.tested
        length, tried = size[-1] + 1, 0
        while True:
            start = end - length
            piece = word[start:end]
            if piece in ids or length == 1:
                left = word[start - size[start] : start]
                try:
                    fits = tested[left][piece]
                except KeyError:
                    fits = self.beside(left, piece)
                if fits:
                    size.append(length)
                    return
            tried += 1
            length = tried

    def last_by_score(self, word: str, end: int, size: list[int], score: list[float]) -> None:
        scores, best, length = self.vocabulary.scores, None, 0
        for start in range(max(0, end - self.vocabulary.longest), end):
            own = scores.get(word[start:end])
            if own is None and start == end - 1:
                own = self.vocabulary.unknown
            if own is not None and (best is None or score[start] + own > best):
                best, length = score[start] + own, end - start
        size.append(length)
        score.append(best)

    def segment(self, words: list[str]) -> list[list[int]]:
        """Ids of sorted words. ``size[d]`` is the length of the last piece of the first d characters."""
        ids, step = self.vocabulary.ids, self.last_by_merges
        if self.vocabulary.kind == UNIGRAM:
            step = self.last_by_score
        size, score, before, out = [0], [0.0], "", []
        for word in words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del size[shared + 1 :], score[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                step(word, end, size, score)
            backwards, end = [], len(word)
            while end:
                start = end - size[end]
                piece = word[start:end]
                if piece in ids:
                    backwards.append(ids[piece])
                else:
                    backwards.extend(self.vocabulary.bytes[b] for b in reversed(piece.encode()))
                end = start
            out.append(backwards[::-1])
            before = word
        return out

    def words(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The words of all texts, and the places where those of each text begin and end."""
        raw, cuts = text_bytes(texts)
        some = np.diff(cuts) > 0
        raw = np.insert(raw, cuts[:-1][some], ord(" "))
        cuts = cuts + np.concatenate([[0], np.cumsum(some)])
        data = raw.tobytes()
        kinds = self.kinds[np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)]
        starts = np.flatnonzero((raw & 0xC0) != 0x80)
        begins = np.ones(len(starts), bool)
        begins[1:] = ~self.joined[kinds[:-1], kinds[1:]]
        begins[np.searchsorted(starts, cuts[:-1][some])] = True
        starts = starts[begins]
        offsets = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
        words = pa.LargeStringArray.from_buffers(len(starts), offsets, pa.py_buffer(data))
        return words, np.searchsorted(starts, cuts)

    def learn(self, words: list[str]) -> None:
        """Segments words that are not known yet, in sorted order. A literal U+2581 is a word of its own."""
        words = sorted(words)
        ids = self.segment([word.replace(" ", MARK) for word in words])
        for n, word in enumerate(words):
            self.known[word] = len(self.known)
            if word == MARK:
                ids[n] = [self.vocabulary.bytes[b] for b in MARK.encode()]
        self.characters += sum(map(len, words))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.starts = np.append(self.starts, len(self.flat) + np.cumsum(sizes) - sizes)
        self.sizes = np.append(self.sizes, sizes)
        self.flat = np.append(self.flat, np.fromiter(chain.from_iterable(ids), np.int32))
        self.uses = np.append(self.uses, np.zeros(len(ids), np.int64))

    def encode(self, texts: pa.Array) -> pa.ListArray:
        if len(self.known) > CACHED or self.characters > CACHED * LONG:
            self.forget_words()
        if self.tests > CACHED:
            self.forget_tests()
        words, first = self.words(texts)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        place = np.fromiter(map(self.known.get, distinct, repeat(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(place < 0)
        if len(missing):
            new = [distinct[n] for n in missing]
            self.learn(new)
            place[missing] = [self.known[word] for word in new]
        self.uses[place] += 1
        which = place[coded.indices.to_numpy()]
        sizes = self.sizes[which]
        cuts = np.concatenate([[0], np.cumsum(sizes)])[first]
        mask = pc.is_null(texts) if texts.null_count else None
        ids = self.flat[ranges(self.starts[which], sizes)]
        return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids), mask=mask)

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """Texts; bytes that are no UTF-8 become U+FFFD, ids without a piece are an error."""
        lists = ids.cast(pa.large_list(pa.int32()))
        cuts = lists.offsets.to_numpy()
        values = lists.values[cuts[0] : cuts[-1]]
        pieces = pa.LargeListArray.from_arrays(pa.array(cuts - cuts[0]), self.content.take(values))
        whole = pc.binary_join(pieces, pa.scalar(b"", pa.large_binary()))
        raw = [None if none else x for x, none in zip(whole.to_pylist(), pc.is_null(ids).to_pylist())]
        texts = [None if x is None else x.decode("utf-8", "replace") for x in raw]
        return pa.array([t[1:] if t and t[0] == " " else t for t in texts], pa.string())


_codecs: dict[str, Codec] = {}


def codec_of(shared, key: str) -> Codec:
    """One codec per worker process, so that words stay known between tasks."""
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(shared.value)
    return _codecs[key]


def with_columns(documents: DataFrame, source: str, limit: int, added: dict[str, T.DataType], make) -> DataFrame:
    """``documents`` with the columns that ``make`` gives for a part of the source column, row for row."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, source, limit):
                columns = [*part.columns, *make(part.column(source))]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, *added])

    return documents.mapInArrow(run, T.StructType([*documents.schema.fields, *(T.StructField(*x) for x in added.items())]))


def encoded(documents: DataFrame, vocabulary: Vocabulary, text_column: str = "text") -> tuple[DataFrame, str]:
    """``documents`` with one more column, and its name: the ids of the text."""
    name, shared = free_name(documents, "ids"), documents.sparkSession.sparkContext.broadcast(vocabulary)
    key = vocabulary.digest
    make = lambda texts: [codec_of(shared, key).encode(texts)]
    return with_columns(documents, text_column, PART, {name: IDS}, make), name


def decoded(documents: DataFrame, vocabulary: Vocabulary, ids_column: str = "ids") -> tuple[DataFrame, str]:
    """``documents`` with one more column, and its name: the text of the ids."""
    name, shared = free_name(documents, "decoded"), documents.sparkSession.sparkContext.broadcast(vocabulary)
    key = vocabulary.digest
    make = lambda ids: [codec_of(shared, key).decode(ids)]
    return with_columns(documents, ids_column, PART // 4, {name: T.StringType()}, make), name


def encoded_and_decoded(
    documents: DataFrame, vocabulary: Vocabulary, text_column: str = "text"
) -> tuple[DataFrame, str, str]:
    """``documents`` with two more columns, and their names: the ids of the text, and the text that these ids decode to.
    Both are made by one worker, so a task needs no second one with a vocabulary and words of its own."""
    ids, shared = free_name(documents, "ids"), documents.sparkSession.sparkContext.broadcast(vocabulary)
    text, key = free_name(documents, "decoded"), vocabulary.digest

    def make(texts):
        codec = codec_of(shared, key)
        found = codec.encode(texts)
        return found, codec.decode(found)

    return with_columns(documents, text_column, PART, {ids: IDS, text: T.StringType()}, make), ids, text


def sentencepiece(documents: DataFrame, model: str) -> DataFrame:
    """Per row: id, ids of the text, their number and digest, and whether decoding gives the text back."""
    vocabulary = Vocabulary.read(model)
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    rows, ids, text = encoded_and_decoded(rows, vocabulary)
    return rows.select(
        "doc_id",
        F.coalesce(F.size(col(ids)), F.lit(0)).cast("long").alias("n_ids"),
        F.xxhash64(col(ids)).alias("ids_hash"),
        col(text).eqNullSafe(F.col("text")).alias("exact"),
        col(ids).alias("ids"),
    )
