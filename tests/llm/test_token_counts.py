"""Token counts against the library, and the parts of the transducers."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rivermark.llm import token_counts
from rivermark.llm.queries import BYTE_PAIRS

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTE_PAIRS)


@pytest.fixture(scope="module")
def vocabulary():
    return token_counts.Vocabulary.read(BYTE_PAIRS)


@pytest.fixture(scope="module")
def tokens(vocabulary):
    return token_counts.Tokens(vocabulary)


def expected(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


PARTS = ["a", "b", "e", "r", "v", "l", "s", " ", "  ", "\n", "'", "'re", "'ll", "'s", "'r", "1", "é", "字", ".", "<|endoftext|>", "<|endof", "text|>", "　", "🙂", "\x00"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=30).map("".join) | st.text(max_size=40) | st.none(), max_size=6))
def test_counts_are_the_librarys(library, tokens, texts):
    texts = [t.encode("utf-8", "replace").decode() if t else t for t in texts]
    assert tokens(pa.array(texts, pa.string())).tolist() == expected(library, texts)


def test_long_words_and_texts(library, tokens):
    random.seed(2)
    texts = ["a" * 5000, "字" * 3000, " " * 5000, "ÃÂ" * 2000, "".join(random.choice("abcdefghij") for _ in range(30_000)), "x y " * 20_000, "", None]
    assert tokens(pa.array(texts)).tolist() == expected(library, texts)


def test_few_states_are_enough(library, vocabulary, monkeypatch):
    """States are forgotten and compiled again while words are being read."""
    monkeypatch.setattr(token_counts, "STATES", 300)
    monkeypatch.setattr(token_counts, "PAIRS", 200)
    random.seed(4)
    words = lambda n: " ".join("".join(random.choice("aeinorst") for _ in range(random.randrange(1, 12))) for _ in range(n))
    texts = [words(200) for _ in range(20)] + ["".join(random.choice("aeinorst") for _ in range(3000))]
    assert token_counts.Tokens(vocabulary)(pa.array(texts)).tolist() == expected(library, texts)


def test_chunk_maps_compose_to_a_plain_run(vocabulary):
    random.seed(1)
    text = "".join(random.choice(PARTS[:19]) for _ in range(3000))
    classes = vocabulary.classes[np.array([ord(c) for c in text])]
    classes = np.append(classes, token_counts.END).astype(np.uint8)
    state, marks = 0, []
    for c in classes:
        marks.append(int(token_counts.MARKS[state + c]))
        state = int(token_counts.STEP[state + c])
    plain = [bool(m & 1) for m in marks]
    for n, m in enumerate(marks):
        if m & 2:
            plain[n - 1] = True
    assert token_counts.word_starts(classes).tolist() == plain


def test_rows_and_columns_stay(spark, library, vocabulary):
    rows = [(1, "It's <|endoftext|> 'rest", 7), (1, "It's <|endoftext|> 'rest", 7), (None, None, 1), (2, "", 2), (3, "wort " * 50_000, 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    out, name = token_counts.counted(frame, vocabulary)
    got = out.collect()
    assert name != "n_tokens" and sorted(map(repr, (tuple(r)[:3] for r in got))) == sorted(map(repr, rows))
    assert [r[name] for r in got] == expected(library, [r.text for r in got])
    assert token_counts.counted(frame.limit(0), vocabulary)[0].count() == 0


def test_query_on_all_documents(spark, library):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = {r.doc_id: r for r in token_counts.token_counts(documents, BYTE_PAIRS).collect()}
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    want = dict(zip(texts, expected(library, texts.values())))
    assert {k: (r.n_bytes, r.n_tokens, r.over_limit) for k, r in got.items()} == {
        k: (len(texts[k].encode()), want[k], want[k] > 1024) for k in texts
    }
