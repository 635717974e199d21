"""Collocations against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from rivermark.llm import collocations

AZ = {n: n + 32 for n in range(65, 91)}


def counts(rows, longest=3):
    found, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(AZ)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for size in range(1, longest + 1):
                for n in range(len(words) - size + 1):
                    found[lang or "und"][tuple(words[n : n + size])] += 1
    return found, total


def expected(rows, least, inside, first, longest=3):
    out = []
    found, total = counts(rows, longest)
    for lang, f in found.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in candidates.items():
            holds = lambda q: any(q[n : n + len(p)] == p for n in range(len(q) - len(p) + 1))
            if any(len(q) > len(p) and holds(q) and 100 * b >= inside * a for q, b in candidates.items()):
                continue
            cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            ranked.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:first], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def sample(seed, texts=300):
    random.seed(seed)
    words = ["Der", "die", "x", "y", "x", "é", "字", "a-b", "q'", " ", "x1"]
    marks = [" "] * 6 + ["  ", "\t", ". ", ",", "\n", " ; "]
    make = lambda: "".join(random.choice(words) + random.choice(marks) for _ in range(random.randrange(30)))
    rows = [(random.choice(["de", "en", None]), make()) for _ in range(texts)]
    return rows + [("de", None), (None, ""), ("de", "...,,"), ("en", "one word")] + rows[:20]


@pytest.mark.parametrize("shard", [200, 1 << 20])
def test_equals_plain_counting(spark, monkeypatch, shard):
    rows = sample(7)
    monkeypatch.setattr(collocations, "SHARD", shard)
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "lang string, text string, n int, hashes int").repartition(3)
    got = collocations.collocations(frame, least=4, inside=60, first=25)
    assert sorted(tuple(r) for r in got.collect()) == expected(rows, 4, 60, 25)


def test_longer_phrases(spark):
    rows = sample(3, 120)
    frame = spark.createDataFrame(rows, "lang string, text string")
    got = collocations.collocations(frame, longest=4, least=3, inside=50, first=1000)
    assert sorted(tuple(r) for r in got.collect()) == expected(rows, 3, 50, 1000, 4)


def test_extensions(spark):
    rows = [("en", "a b c. a b d. a b c. z a b")] * 3
    words, tables = collocations.frequent_phrases(spark.createDataFrame(rows, "lang string, text string"), least=2)
    names = {r.h1: r.word for r in words.collect()}
    right = collocations.extensions(tables, 2, "right").collect()
    left = collocations.extensions(tables, 2, "left").collect()
    assert {(names[r.h1], names[r.h2]): (r.kinds, r.n) for r in right}["a", "b"] == (2, 9)
    assert {(names[r.h1], names[r.h2]): (r.kinds, r.n) for r in left}["a", "b"] == (1, 3)


def test_intervals_of_both_indexes():
    """Each extension's interval holds just the suffixes that begin with the phrase, in either direction."""
    rng = np.random.default_rng(5)
    ids = np.append(0, np.append(rng.integers(0, 5, 400), 0))
    index = collocations.Index.of(ids, 5, 3)
    phrases = index.words()
    for side in (0, 1):
        phrases = index.extended(phrases, side)
        circle = np.concatenate([ids, ids[:3]])
        size = phrases.ids.shape[1]
        for way, text in ((0, circle), (1, np.concatenate([ids[::-1], ids[::-1][:3]]))):
            suffixes = sorted(tuple(text[n : n + 3]) for n in range(len(ids)))
            for phrase, start, count in zip(phrases.ids, phrases.starts[way], phrases.counts):
                want = tuple(phrase if way == 0 else phrase[::-1])
                held = [n for n, s in enumerate(suffixes) if s[:size] == want]
                assert held == list(range(start, start + count))


def test_words_that_share_a_hash_get_another_seed(spark, monkeypatch):
    real = collocations.word_hash
    monkeypatch.setattr(collocations, "SHARD", 100)
    rows = sample(1, 60)
    frame = spark.createDataFrame(rows, "lang string, text string")
    seeds = []

    def indexed(documents, lang, text, longest, seed, made=collocations.indexed):
        seeds.append(seed)
        if seed:
            return made(documents, lang, text, longest, seed)
        from pyspark.sql import functions as F

        same = made(documents, lang, text, longest, seed)
        return same.withColumn("words", F.transform("words", lambda w: w.withField("h1", w["h1"] % 3)))

    monkeypatch.setattr(collocations, "indexed", indexed)
    assert real("en", b"x", 0) != real("en", b"x", 1)
    got = collocations.collocations(frame, least=3, first=50)
    assert seeds == [0, 1] and sorted(tuple(r) for r in got.collect()) == expected(rows, 3, 50, 50)


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
