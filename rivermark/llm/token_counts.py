"""Token counts of whole texts by a byte-level BPE vocabulary, compiled to finite-state transducers.

Two deterministic transducers run one after the other.

* The *cutter* reads character classes and marks where a word begins (an ending, a run of letters,
  digits or other characters with the space before it, white space). It has eleven states. A batch's characters are cut
  into chunks of ``CHUNK``; each chunk's map from the state before it to the state after it is worked out
  for all states at once, the maps are composed by a parallel prefix scan, and each chunk is read once
  more from the state it really starts in. So a text of any length is read in steps over all chunks together.
* The *counter* reads a word's bytes. Each transition carries the number of tokens that the byte adds to the count of the
  word so far (it may be negative: a byte can join several tokens to one). A state says where a token that is not
  complete yet may have begun, the token before each such place (or one that allows the same tokens to follow), and
  how many tokens fewer there were. A token ends the encoding of a prefix if merging leaves it beside the token before it; exactly one does. States are
  compiled when a text first needs them and numbered; a worker keeps ``STATES`` of them at most and then starts
  over with those in use.

Counts equal the library's without added tokens. Strings of special tokens inside texts are
one token each, as is its default; a text is cut there. Null texts count as empty and have no tokens. Repeated rows
are counted each; other columns are kept, whatever their names. The vocabulary's size bounds what is sent to the
executors. Texts are counted row by row without a shuffle.
"""

from __future__ import annotations

import json
import re
import unicodedata
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivermark.llm.rows import col, free_name
from rivermark.llm.spans import slices, text_bytes

CHUNK = 256
STATES = 1 << 17
PAIRS = 1 << 19  # tested pairs of tokens kept
FEW = 24  # words still being read at which they are read one by one
SPARSE = 8  # so many tokens below a node are compared one by one
LIMIT = 1024  # tokens of one model input

# character classes
SPACE, WHITE, APOSTROPHE, SHORT, R, V, E, L, LETTER, NUMBER, OTHER, SPECIAL, END, PAD = range(14)
CLASSES = 14
# states of the cutter: after a complete word; inside letters, digits, others; after an apostrophe that began a word,
# with r or v after it, with l after it; after one or more white-space characters, the last of which is a space or not
(BEGIN, IN_LETTERS, IN_NUMBERS, IN_OTHERS, QUOTE, QUOTE_RV, QUOTE_L, ONE_SPACE, ONE_WHITE, MANY_SPACE, MANY_WHITE) = range(11)
CUTTER_STATES = 11
HERE, BEFORE = 1, 2  # marks: a word begins at this character, at the one before it


def cutter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks by state * CLASSES + class; a state is stored as state * CLASSES."""
    first = {SPACE: ONE_SPACE, WHITE: ONE_WHITE, APOSTROPHE: QUOTE, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, SPECIAL: BEGIN, END: BEGIN}
    letters = {SHORT, R, V, E, L, LETTER}
    first |= dict.fromkeys(letters, IN_LETTERS)
    # what a space before it belongs to
    after_space = dict.fromkeys(letters, IN_LETTERS) | {NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, APOSTROPHE: IN_OTHERS}
    more_white = {SPACE: MANY_SPACE, WHITE: MANY_WHITE}
    going_on = {
        IN_LETTERS: dict.fromkeys(letters, IN_LETTERS),
        IN_NUMBERS: {NUMBER: IN_NUMBERS},
        IN_OTHERS: {OTHER: IN_OTHERS, APOSTROPHE: IN_OTHERS},
        QUOTE: {SHORT: BEGIN, R: QUOTE_RV, V: QUOTE_RV, L: QUOTE_L, OTHER: IN_OTHERS, APOSTROPHE: IN_OTHERS},
        QUOTE_RV: {E: BEGIN},
        QUOTE_L: {L: BEGIN},
        ONE_SPACE: more_white | after_space,
        ONE_WHITE: more_white,
        MANY_SPACE: more_white,
        MANY_WHITE: more_white,
    }
    step = np.zeros((CUTTER_STATES, CLASSES), np.uint8)
    marks = np.zeros((CUTTER_STATES, CLASSES), np.uint8)
    for state in range(CUTTER_STATES):
        for sort in range(CLASSES):
            if sort == PAD:
                target, mark = state, 0
            elif sort in going_on.get(state, {}):
                target, mark = going_on[state][sort], 0
            elif state in (QUOTE_RV, QUOTE_L):  # no ending after all: the letter began a word of its own
                target, mark = (IN_LETTERS, BEFORE) if sort in letters else (first[sort], BEFORE | HERE)
            elif state == MANY_SPACE and sort in after_space:
                target, mark = after_space[sort], BEFORE
            elif state == MANY_WHITE and sort in after_space:
                target, mark = first[sort], BEFORE | HERE
            else:
                target, mark = first[sort], HERE
            step[state, sort], marks[state, sort] = target * CLASSES, mark
    return step.ravel(), marks.ravel()


STEP, MARKS = cutter()


def character_classes(is_letter, is_number) -> np.ndarray:
    """Class of every code point. The functions decide on those that one Unicode version has and another has not."""
    table = np.full(0x110000, OTHER, np.uint8)
    known = {"L": LETTER, "N": NUMBER}
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for sort, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\s+")):
        for run in regex.finditer(pattern, every):
            for c in map(ord, run.group()):
                if sort != WHITE and known.get(unicodedata.category(chr(c))[0]) != sort:
                    sort_here = LETTER if is_letter(chr(c)) else NUMBER if is_number(chr(c)) else OTHER
                    table[c] = sort_here
                else:
                    table[c] = sort
    for characters, sort in ((" ", SPACE), ("'", APOSTROPHE), ("stmd", SHORT), ("r", R), ("v", V), ("e", E), ("l", L)):
        table[[ord(c) for c in characters]] = sort
    return table


def byte_letters() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in shown}
    rest = (b for b in range(256) if b not in set(shown))
    return letters | {chr(256 + n): b for n, b in enumerate(rest)}


class Vocabulary:
    """Tokens and merges of a byte-level BPE file, special strings and character classes."""

    def __init__(self, tokens: list[bytes], merges: list[tuple[int, int, int]], special: list[str], classes: np.ndarray):
        self.tokens, self.merges, self.special, self.classes = tokens, merges, special, classes
        self.digest = sha256(repr((tokens, merges, special)).encode() + classes.tobytes()).hexdigest()

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        model, cut = rules["model"], rules["pre_tokenizer"] or {}
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        joined = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        if model.get("type", "BPE") != "BPE" or any(model.get(name) for name in joined) or rules["normalizer"] or not plain:
            raise ValueError("needs a byte-level BPE file without normalisation, prefix space or other options")
        added = rules["added_tokens"]
        if any(a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"] for a in added):
            raise ValueError("special tokens with options are not supported")
        letters = byte_letters()
        special = {a["content"] for a in added}
        names = [name for name in model["vocab"] if name not in special]
        place = {name: n for n, name in enumerate(names)}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merges = [(place[a], place[b], place[a + b]) for a, b in pairs]
        tokens = [bytes(letters[c] for c in name) for name in names]
        pre = Tokenizer.from_file(path).pre_tokenizer
        joins = lambda before: lambda c: len(pre.pre_tokenize_str(before + c)) == 1
        return cls(tokens, merges, sorted(special, key=lambda s: (-len(s), s)), character_classes(joins("a"), joins("1")))


class Counter:
    """The counting transducer of a vocabulary, compiled as texts need it.

    ``table[state, byte]`` holds the next state and what the byte adds, 0 where not compiled yet.
    """

    SHIFT, BIAS = 10, 600

    def __init__(self, vocabulary: Vocabulary):
        self.join = {(a, b): rank for rank, (a, b, _) in enumerate(vocabulary.merges)}
        self.made = {}  # token: (left, right, rank of the merge)
        for rank, (a, b, token) in enumerate(vocabulary.merges):
            if token in self.made or any(x in self.made and self.made[x][2] > rank for x in (a, b)):
                raise ValueError("needs one merge per token, after those of its parts")
            self.made[token] = (a, b, rank)
        self.sides: dict[tuple[int, bool], list[tuple[int, int, float]]] = {}
        if {t for t in vocabulary.tokens if len(t) == 1} != {bytes([b]) for b in range(256)}:
            raise ValueError("needs a token for every byte")
        if max(map(len, vocabulary.tokens)) > self.BIAS - 2:
            raise ValueError("tokens are too long")
        self.child: dict[int, int] = {}  # node << 8 | byte: node
        self.token: dict[int, int] = {}  # node: token
        self.inner: set[int] = set()  # nodes with children
        sound: set[int] = set()
        nodes = 1
        for token, content in sorted(enumerate(vocabulary.tokens), key=lambda t: self.made.get(t[0], (0, 0, -1))[2]):
            if token in self.made:
                a, b, rank = self.made[token]
                if a not in sound or b not in sound or not self.beside(a, b, rank):
                    continue  # merging its own bytes gives something else, so it never occurs
            elif len(content) > 1:
                continue
            sound.add(token)
            node = 0
            for byte in content:
                self.inner.add(node)
                key = node << 8 | byte
                if key not in self.child:
                    self.child[key] = nodes
                    nodes += 1
                node = self.child[key]
            self.token[node] = token
        self.below: dict[int, list[int]] = {}  # node: tokens below it, for nodes with few
        for token in sound:
            node = 0
            for byte in vocabulary.tokens[token]:
                self.below.setdefault(node, []).append(token)
                node = self.child[node << 8 | byte]
        self.below = {node: tokens for node, tokens in self.below.items() if len(tokens) <= SPARSE}
        self.restart([])

    def side(self, token: int, right: bool) -> list[tuple[int, int, float]]:
        """(part, rank from which it is there, rank at which it is joined) along a token's right or left edge."""
        key = (token, right)
        if key not in self.sides:
            parts, joined = [], float("inf")
            while True:
                left_part, right_part, rank = self.made.get(token, (None, None, -1))
                parts.append((token, rank, joined))
                if left_part is None:
                    break
                token, joined = (right_part if right else left_part), rank
            self.sides[key] = parts
        return self.sides[key]

    def beside(self, a: int, b: int, until: float = float("inf")) -> bool:
        """Whether no merge of rank below ``until`` joins a part of ``a`` with one of ``b`` across their border.

        Parts at the border meet while both are there. Of merges of one rank the leftmost comes first, so a
        merge within ``a`` goes before one across, and that before one within ``b``.
        """
        for left, made_left, joined_left in self.side(a, True):
            for right, made_right, joined_right in self.side(b, False):
                rank = self.join.get((left, right))
                if rank is not None and rank < until and rank < joined_left and rank <= joined_right:
                    if joined_left > made_right and joined_right >= made_left:
                        return False
        return True

    def restart(self, keep: list[tuple]) -> np.ndarray:
        """Forgets all states but the first one and ``keep``; their new numbers."""
        self.states: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.table = np.zeros((1024, 256), np.int32)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.same: dict[tuple[int, int], int | None] = {}
        self.alike: dict[tuple, int] = {}
        self.number(((0, -1, 0),))
        return np.array([self.number(state) for state in keep], np.int32)

    def number(self, state: tuple) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            if len(self.states) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        return self.numbers[state]

    def fits(self, before: int, token: int) -> bool:
        if before < 0:
            return True
        key = (before, token)
        if key not in self.pairs:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            self.pairs[key] = self.beside(before, token)
        return self.pairs[key]

    def stand_in(self, node: int, before: int) -> int | None:
        """A token that allows the same tokens below ``node`` as ``before`` does, the same one for all such; None if they allow none."""
        if node not in self.below or before < 0:
            return before
        key = (node, before)
        if key not in self.same:
            if len(self.same) > PAIRS:
                self.same.clear()
            allowed = tuple(self.fits(before, token) for token in self.below[node])
            self.same[key] = self.alike.setdefault((node, allowed), before) if any(allowed) else None
        return self.same[key]

    def compile(self, number: int, byte: int) -> None:
        """The transition of a state for a byte.

        A state lists (node, token before, tokens up to there less those up to here) for each place from
        which the bytes read lead to a node below which tokens go on; the last one is this place itself.
        """
        alive, found = [], None
        for node, before, fewer in self.states[number]:
            below = self.child.get(node << 8 | byte)
            if below is None:
                continue
            if found is None and below in self.token and self.fits(before, self.token[below]):
                found = (self.token[below], fewer + 1)
            if below in self.inner and (same := self.stand_in(below, before)) is not None:
                alive.append((below, same, fewer))
        token, added = found
        after = tuple((node, before, fewer - added) for node, before, fewer in alive) + ((0, token, 0),)
        target = self.number(after)
        self.table[number, byte] = target << self.SHIFT | (added + self.BIAS)

    def count(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Tokens of each word raw[start : start + size]."""
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        state, total = np.zeros(len(starts), np.int32), np.zeros(len(starts), np.int64)
        longer = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), "left")  # words with more bytes
        for n in range(len(longer)):
            active = int(longer[n])
            if active < FEW:
                break
            bytes_here = raw[starts[:active] + n]
            value = self.table[state[:active], bytes_here]
            missing = np.flatnonzero(value == 0)
            if len(missing):
                new = np.unique(state[missing].astype(np.int64) << 8 | bytes_here[missing])
                if len(self.states) + len(new) > STATES:
                    used, where = np.unique(state[:active], return_inverse=True)
                    state[:active] = self.restart([self.states[s] for s in used])[where]
                    new = np.unique(state[:active].astype(np.int64) << 8 | bytes_here)
                for key in new.tolist():
                    if not self.table[key >> 8, key & 255]:
                        self.compile(key >> 8, key & 255)
                value = self.table[state[:active], bytes_here]
            state[:active] = value >> self.SHIFT
            total[:active] += (value & ((1 << self.SHIFT) - 1)) - self.BIAS
        else:
            n = len(longer)
        for word in range(int(longer[n]) if n < len(longer) else 0):
            total[word] += self.read_on(int(state[word]), raw[starts[word] + n : starts[word] + sizes[word]].tobytes(), word, state)
        out = np.empty(len(order), np.int64)
        out[order] = total
        return out

    def read_on(self, now: int, rest: bytes, word: int, state: np.ndarray) -> int:
        """Tokens added by the rest of one word; later words' states stay valid."""
        total, low = 0, (1 << self.SHIFT) - 1
        for byte in rest:
            value = self.table.item(now, byte)
            if not value:
                if len(self.states) >= STATES:
                    kept = [self.states[now], *(self.states[s] for s in state[word + 1 :][:FEW])]
                    fresh = self.restart(kept)
                    now = int(fresh[0])
                    state[word + 1 :][: len(fresh) - 1] = fresh[1:]
                self.compile(now, byte)
                value = self.table.item(now, byte)
            now = value >> self.SHIFT
            total += (value & low) - self.BIAS
        return total


def code_points(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and where each begins."""
    begins = np.flatnonzero((raw & 0xC0) != 0x80)
    points = raw[begins].astype(np.int32)
    wide = np.flatnonzero(points >= 0x80)
    if len(wide):
        at, lead = begins[wide], points[wide]
        size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
        value = lead & (0x7F >> size)
        for n in range(1, 4):
            more = np.flatnonzero(size > n)
            value[more] = value[more] << 6 | raw[np.minimum(at[more] + n, len(raw) - 1)] & 0x3F
        points[wide] = np.minimum(value, 0x10FFFF)
    return points, begins


def states_before(classes: np.ndarray) -> np.ndarray:
    """State before each chunk (a row of ``classes`` per place, a column per chunk), from the chunks' state maps."""
    maps = np.repeat(np.arange(CUTTER_STATES, dtype=np.uint8)[:, None] * CLASSES, classes.shape[1], axis=1)
    for row in classes:
        maps = STEP[maps + row]
    distance, chunks = 1, maps.shape[1]
    while distance < chunks:  # composes each map with that of the chunks before it, twice as many in each round
        composed = np.take_along_axis(maps[:, distance:], maps[:, :-distance] // CLASSES, axis=0)
        maps = np.concatenate([maps[:, :distance], composed], axis=1)
        distance *= 2
    return np.append(np.uint8(BEGIN * CLASSES), maps[BEGIN, :-1]).astype(np.uint8)


def word_starts(classes: np.ndarray) -> np.ndarray:
    """Whether a word, a special string or an end begins at each character; every text's last class is END."""
    chunks = -(-len(classes) // CHUNK)
    padded = np.full(chunks * CHUNK, PAD, np.uint8)
    padded[: len(classes)] = classes
    rows = np.ascontiguousarray(padded.reshape(chunks, CHUNK).T)
    state, marks = states_before(rows), np.empty_like(rows)
    for n, row in enumerate(rows):
        at = state + row
        marks[n], state = MARKS[at], STEP[at]
    flat = marks.T.ravel()[: len(classes)]
    begins = (flat & HERE) > 0
    begins[:-1] |= (flat[1:] & BEFORE) > 0
    return begins


class Tokens:
    """Counts tokens of text batches."""

    def __init__(self, vocabulary: Vocabulary):
        self.classes = vocabulary.classes
        self.counter = Counter(vocabulary)
        special = b"|".join(re.escape(s.encode()) for s in vocabulary.special)
        self.special = re.compile(special) if special else None

    def special_spans(self, raw: np.ndarray, cuts: np.ndarray) -> list[tuple[int, int]]:
        """Special strings that lie inside one text."""
        found, at, content = [], 0, raw.tobytes()
        while self.special and (hit := self.special.search(content, at)):
            end_of_text = cuts[np.searchsorted(cuts, hit.start(), "right")]
            inside = hit.end() <= end_of_text
            if inside:
                found.append(hit.span())
            at = hit.end() if inside else hit.start() + 1
        return found

    def __call__(self, texts: pa.Array) -> np.ndarray:
        raw, cuts = text_bytes(texts)
        points, begins = code_points(raw)
        classes = self.classes[points]
        for start, end in self.special_spans(raw, cuts):
            low, high = np.searchsorted(begins, [start, end])
            classes[low], classes[low + 1 : high] = SPECIAL, PAD
        places = np.searchsorted(begins, cuts[1:])
        classes = np.insert(classes, places, END)
        begins = np.insert(begins, places, cuts[1:])
        if not len(raw):
            return np.zeros(len(texts), np.int64)
        marked = np.flatnonzero(word_starts(classes))  # the last one is an end
        word = classes[marked] != END
        special = classes[marked] == SPECIAL
        starts = begins[marked]
        sizes = np.append(starts[1:], len(raw)) - starts
        counts = word.astype(np.int64)
        plain = np.flatnonzero(word & ~special)
        counts[plain] = self.counter.count(raw, starts[plain], sizes[plain])
        text = np.cumsum(~word) - ~word
        return np.bincount(text, counts, len(texts))[: len(texts)].astype(np.int64)


_tokens: dict[str, Tokens] = {}


def tokens_of(shared, digest: str) -> Tokens:
    """One pair of transducers per worker process, so that states stay compiled between tasks."""
    if digest not in _tokens:
        _tokens.clear()
        _tokens[digest] = Tokens(shared.value)
    return _tokens[digest]


def counted(documents: DataFrame, vocabulary: Vocabulary, text_column: str = "text") -> tuple[DataFrame, str]:
    """``documents`` with one more column, and its name: the tokens of the text."""
    name, digest = free_name(documents, "n_tokens"), vocabulary.digest
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_column):
                counts = pa.array(tokens_of(shared, digest)(part.column(text_column)))
                yield pa.RecordBatch.from_arrays([*part.columns, counts], names=[*part.schema.names, name])

    schema = T.StructType([*documents.schema.fields, T.StructField(name, T.LongType())])
    return documents.mapInArrow(run, schema), name


def token_counts(documents: DataFrame, vocabulary_file: str, limit: int = LIMIT) -> DataFrame:
    """Per row: id, UTF-8 bytes, tokens, and whether these are more than ``limit``."""
    rows = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows, n = counted(rows, Vocabulary.read(vocabulary_file))
    return rows.select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        col(n).alias("n_tokens"),
        (col(n) > limit).alias("over_limit"),
    )
