"""Toxicity, language, class model, url filter, vector search, chat trees, and the pipeline."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
import corpus_pipeline
from rivermark.llm import chat_tree, class_lm, decontaminate, language, near_dup, toxicity, url_filter, vector_search

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score double, held_out int, chunk int, training int, block_score int"
AZ = {n: n + 32 for n in range(65, 91)}
LONG = "word " * 40_000


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, 0.5, 1, 2, 3, 4) for i, t, lang in rows], SCHEMA)


def odd_documents(spark):
    rows = [(1, None, "en"), (2, "", "en"), (None, "some words", None), (3, LONG, "de"), (4, "a b", "fr"), (4, "a b", "fr")]
    return documents(spark, rows)


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


# toxicity


def test_insults_are_found_in_held_out_texts(spark):
    random.seed(1)
    insults = [f"insult{c}" for c in "abcdefgh"]
    rows, labels = [], []
    for n in range(600):
        own = [random.choice("abcdefghijklmnop") * 3 + random.choice("xyz") for _ in range(random.randrange(20, 200))]
        toxic = n % 6 == 0
        if toxic:
            for _ in range(max(2, len(own) // 50)):
                own[random.randrange(len(own))] = random.choice(insults).upper()
        rows.append((n, " ".join(own), "en"))
        labels.append((n, int(toxic)))
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.toxicity(documents(spark, rows), table).collect()
    assert len(got) == 600
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {n for n in range(600) if remainder(n, 4) == 2}
    assert all(r.predicted == (r.score >= 0.3) for r in got)
    assert sum(r.predicted != labels[r.doc_id][1] for r in held) <= 0.03 * len(held)


def test_insults_of_half_a_percent_each_are_learned(spark):
    random.seed(3)
    insults = [f"q{n:03d}".translate({48 + d: 97 + d for d in range(10)}) for n in range(600)]
    usual = [f"w{n:04d}".translate({48 + d: 97 + d for d in range(10)}) for n in range(2000)]
    rows = []
    for n in range(8000):
        own = random.sample(usual, 10) + (random.sample(insults, 3) if n % 2 else [])
        random.shuffle(own)
        rows.append((n, " ".join(own), "en"))
    labels = spark.createDataFrame([(n, n % 2) for n in range(8000)], "doc_id long, toxic int")
    held = toxicity.toxicity(documents(spark, rows), labels).where("held_out").collect()
    found = Counter((r.doc_id % 2, r.predicted) for r in held)
    assert found[1, 1] >= 0.8 * (found[1, 0] + found[1, 1])
    assert found[0, 1] <= 0.2 * (found[0, 0] + found[0, 1])


def test_a_count_that_chance_does_not_explain_survives_any_number_of_texts():
    for texts in (800, 80_000, 8_000_000):
        got = toxicity.kept(np.array([4.0, 40.0, 40.0]), np.array([4.0, 0.0, 40.0]), texts, texts)
        assert got[0] == got[2] == 0 and got[1] > 20


def test_labels_without_a_document_take_no_places(spark):
    frame = documents(spark, [(n, "kala moja", "aa") for n in range(20)])
    labels = spark.createDataFrame([(n, n % 2) for n in range(2000)], "doc_id long, toxic int")
    found = toxicity.labelled_sample(frame, labels, "doc_id", "text", 10, 1000).collect()
    assert Counter(r.toxic for r in found) == {0: 10, 1: 10}


def test_toxicity_of_odd_rows(spark):
    frame = odd_documents(spark)
    labels = spark.createDataFrame([(1, 0), (3, None), (4, 1), (4, 0), (7, 5)], "doc_id long, toxic int")
    got = toxicity.toxicity(frame, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.toxicity(frame, none).collect()} == {0}
    assert toxicity.toxicity(frame.limit(0), none).count() == 0
    model = toxicity.train(frame, none)
    assert toxicity.scored(frame, model).columns == [*frame.columns, "score_"]


def test_kneser_ney_probabilities_add_up():
    random.seed(2)
    words = np.arange(10, 30, dtype=np.uint64)
    draw = lambda: random.choice(words.tolist())
    # most pairs of a context are of one class only
    rows = Counter((p := random.choice([1, *range(10, 16)]), w := draw(), (p + w) % 2) for _ in range(9000))
    pairs = sorted({(p, w) for p, w, _ in rows})
    previous, following = (np.array(x, np.uint64) for x in zip(*pairs))
    pair_rows = np.array([[rows[p, w, side] for p, w in pairs] for side in (0, 1)], float)
    contexts = np.unique(previous)
    of_context = np.stack([np.bincount(np.searchsorted(contexts, previous), n) for n in pair_rows])
    spread = np.stack([np.bincount(np.searchsorted(words, following), n) for n in pair_rows])
    different = np.bincount(np.searchsorted(words, following)).astype(float)
    counts = toxicity.Counts(
        np.array([300, 300]), spread.sum(axis=1), int(different.sum()) + len(words),
        words, spread, different, contexts, of_context, previous, following, pair_rows,
    )
    model = toxicity.kneser_ney(counts)
    assert np.allclose(model.lower.sum(axis=1), 1)
    for side in (0, 1):
        for n, context in enumerate(contexts):
            at, known = toxicity.look_up(model.pairs, toxicity.pair_hash(np.full(len(words), context), words))
            own = np.where(known, model.own[side][at], 0).sum()
            assert own > 0 and own + model.shared[side][n] == pytest.approx(1, abs=1e-5)


# language


def test_languages_of_held_out_texts(given):
    got = {r.doc_id: r for r in language.language_id(given).collect()}
    truth = {r.doc_id: r.lang for r in given.collect()}
    held = [r for r in got.values() if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if remainder(i, 5) == 0}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_texts_over_the_bound_do_not_end_a_sample(spark):
    rows = [(n, "kala moja " * 5, "aa") for n in range(20)] + [(n, "kala moja " * 30, "aa") for n in range(20, 40)]
    rows += [(50, "zum wohl " * 400, "bb"), (51, "zum wohl " * 300, "bb")]  # none fits
    found = Counter(map(tuple, language.sample(documents(spark, rows), "doc_id", "text", "lang", 2000, 250).collect()))
    assert found == {("aa", "kala moja " * 5): 5, ("bb", "zum wohl " * 300): 1}
    labels = spark.createDataFrame([(n, int(n >= 50)) for n, _, _ in rows], "doc_id long, toxic int")
    found = toxicity.labelled_sample(documents(spark, rows), labels, "doc_id", "text", 100, 250).collect()
    assert Counter((r.toxic, len(r.text)) for r in found) == {(0, 50): 5, (1, 2700): 1}


def test_language_of_odd_rows(spark):
    got = language.language_id(odd_documents(spark).union(documents(spark, [(50, "12 !? 3", "en")]))).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == 7
    assert all((by_id[i].lang_pred, by_id[i].score) == ("und", 0.0) for i in (1, 2, 50))
    assert language.language_id(odd_documents(spark).limit(0)).count() == 0


def test_unseen_words_fall_back_to_the_longest_known_grams():
    counts = [("xx", "the cat sat there"), ("yy", "der katze sass dort")]
    found = defaultdict(lambda: [0, 0])
    for n, (_, text) in enumerate(counts):
        for word in text.split():
            found[0, word][n] += 1
            for size in range(1, 6):
                padded = f" {word} " if size > 1 else word
                for at in range(len(padded) - size + 1):
                    found[size, padded[at : at + size]][n] += 1
    logs = {}
    for size in range(6):
        mine = {k: v for k, v in found.items() if k[0] == size}
        total = np.array(list(mine.values())).sum(axis=0) + 0.1 * len(mine)
        logs |= {k: np.log((np.array(v) + 0.1) / total) for k, v in mine.items()}
    batch = pa.RecordBatch.from_pydict({"language": [c[0] for c in counts], "text": [c[1] for c in counts]})
    rows = pa.Table.from_batches(list(language.count_text([batch])))
    sums = Counter()
    for name, length, key, n in zip(*(rows.column(c).to_pylist() for c in ("language", "length", "hash", "n"))):
        sums[name, length, key % 2**64] += n
    keys, tables = [], []
    for size in range(6):
        key = np.array(sorted({k[2] for k in sums if k[1] == size}), np.uint64)
        table = np.array([[sums["xx", size, k], sums["yy", size, k]] for k in key.tolist()], float)
        keys.append(key)
        tables.append(np.log((table + 0.1) / (table.sum(axis=0) + 0.1 * len(key))))
    model = language.Model(["xx", "yy"], keys, tables)
    for word in ("cat", "there", "theft", "katzen", "at", "zzzd", "q"):
        want = logs.get((0, word))
        for size in range(5, 0, -1):
            padded = f" {word} " if size > 1 else word
            grams = [logs[size, padded[n : n + size]] for n in range(len(padded) - size + 1) if (size, padded[n : n + size]) in logs]
            if want is None and grams:
                want = np.mean(grams, axis=0)
        got = model.word_scores(language.LetterWords(pa.array([word])))[0]
        assert got == pytest.approx(np.zeros(2) if want is None else want), word


# class model


def test_class_model_counts_and_base(spark, given, monkeypatch):
    monkeypatch.setattr(class_lm, "CHUNK", 100_000)
    extra = odd_documents(spark).select("doc_id", "text")
    rows = given.select("doc_id", "text").union(extra)
    got = class_lm.class_lm(rows).collect()
    tokens = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(AZ)), None]
    texts = [(r.doc_id, r.text) for r in rows.collect()]
    held = lambda i: i is not None and remainder(i, 7) == 2
    counts = Counter(w for i, t in texts if not held(i) for w in tokens(t))
    total, kinds = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in texts:
        own = tokens(t)
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in own)
        want[i, held(i), len(own), sum(counts[w] > 0 for w in own), total, round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert all(r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens)) for r in got)


def test_exchange_does_not_lose_likelihood():
    random.seed(6)
    size = 30
    pairs = np.zeros((size + 1, size + 1))
    for _ in range(20_000):
        a = random.randrange(size + 1)
        pairs[a, (a * 7 + random.randrange(3)) % (size + 1)] += 1

    def likelihood(classes):
        members = np.zeros((size + 1, class_lm.CLASSES + 1))
        members[np.arange(size + 1), classes] = 1
        table = members.T @ pairs @ members
        return class_lm.x_log_x(table).sum() - 2 * class_lm.x_log_x(members.T @ pairs.sum(axis=1)).sum()

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(class_lm, "CLASSES", 4)
        start = np.append(np.argsort(np.argsort(-pairs.sum(axis=1)[:size], kind="stable")) % 4, 4)
        found = class_lm.exchange(pairs)
        assert found[-1] == 4 and likelihood(found) > likelihood(start)


def test_all_words_move_without_loss():
    """Each to the class that is likeliest before the move; the likelihood of all rises until nothing moves."""
    rng = np.random.default_rng(8)
    size, classes = 200, class_lm.CLASSES
    counts = [{int(j): int(rng.integers(1, 9)) for j in rng.choice(classes + 1, rng.integers(1, 5), replace=False)} for _ in range(size)]
    now = home = rng.integers(0, 8, size)

    def table_with(assignment):
        table = np.zeros((classes + 1, classes + 1))
        for own, k in zip(counts, assignment):
            for j, n in own.items():
                table[j, k] += n
        return table

    steps = pa.array([[j + 128 * n for j, n in sorted(own.items())] for own in counts], pa.list_(pa.int64()))
    owner, before, n, starts = class_lm.unpacked(pa.RecordBatch.from_arrays([steps], names=["steps"]))
    values = []
    for _ in range(6):
        table = table_with(now)
        values.append(class_lm.likelihood(table) + class_lm.HOME * (now == home).sum())
        got = class_lm.best_classes(table, owner, before, n, starts, now, home)
        log = lambda j, k: math.log(table[j, k] / table[:, k].sum()) if table[j, k] else class_lm.NEVER
        for word, own in enumerate(counts):
            value = lambda k: sum(c * log(j, k) for j, c in own.items()) + class_lm.HOME * (k == home[word])
            assert value(got[word]) == pytest.approx(max(value(k) for k in range(classes)))
        now = got
    assert values == sorted(values) and values[-1] > values[0]


def test_rounds_raise_the_likelihood_and_scores_are_the_formula(spark):
    random.seed(12)
    kinds = {c: [f"{c}{random.choice('klmn')}{n}" for n in range(150)] for c in "abcd"}
    order = {"a": "b", "b": "c", "c": "d", "d": "a"}

    def text():
        c, out = random.choice("abcd"), []
        for _ in range(random.randrange(0, 60)):
            out.append(random.choice(kinds[c]))
            c = order[c]
        return " ".join(out)

    rows = [(n, text(), "en") for n in range(400)] + [(1, None, "en"), (2, "new words here", "en")]
    frame = documents(spark, rows)
    training = F.col("doc_id") % 5 != 0
    chunks, count = class_lm.chunked(frame, "doc_id", "text", training)
    words, totals = class_lm.vocabulary(chunks)
    model, classes = class_lm.train(chunks, totals, count)
    assert (10**model.steps).sum(axis=1) == pytest.approx(1)
    of_word = {r["word"]: r["class"] for r in classes.collect()}
    n_of = {r.word: r.total for r in totals.collect()}
    emitted = Counter()
    for word, k in of_word.items():
        if k < class_lm.CLASSES:
            emitted[k] += (n_of[word] + class_lm.ADDED) / 10 ** model.sizes[k]
    assert all(total < 1 for total in emitted.values())  # the rest is for unknown words
    got = Counter((r.doc_id, round(r.score, 6)) for r in class_lm.scored(frame, training).collect())
    want = Counter()
    for doc_id, content, _ in rows:
        spans = class_lm.Words(pa.array([content or ""]), class_lm.NOT_SPACE)
        units, tail, before, score = class_lm.units_of(spans, spans.hashes, model.core), class_lm.tails(spans), class_lm.CLASSES, 0.0
        for h, unit, t in zip(spans.hashes.view(np.int64).tolist(), units, tail):
            k = of_word.get(h, model.unknown[t])
            score += model.steps[before, k] + math.log10(n_of.get(h, 0) + class_lm.ADDED) - model.sizes[k]
            before = model.classes[unit]
        want[doc_id, round(score + model.steps[before, class_lm.CLASSES], 6)] += 1
    assert got == want
    contexts = class_lm.all_contexts(chunks.where("training").select("text"), model.core, model.classes, 200)  # merged in parts
    rounds = [class_lm.likelihood(class_lm.exchanged(contexts, model.classes)[1])]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(class_lm, "ROUNDS", 0)
        rounds.append(class_lm.likelihood(class_lm.exchanged(contexts, model.classes)[1]))
    assert rounds[0] > rounds[1]


def test_class_model_without_rows(spark):
    assert class_lm.class_lm(odd_documents(spark).limit(0)).count() == 0


# url filter


def test_rules_and_parts_of_urls(spark):
    urls = [
        (1, "https://WWW.Example.COM/en/1?q=/x#y", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        (2, "http://m.example.com/en/2", "m.example.com", "/en/2", "example.com/en/", "block"),
        (3, "http://example.com/de/2#a", "example.com", "/de/2", "com/", "allow"),
        (4, "http://a.net/es/1", "a.net", "/es/1", "net/es/", "block"),
        (5, "http://a.com", "a.com", "", None, None),
        (6, "http://xcom/", "xcom", "/", None, None),
        (7, "no scheme.com/", "", "", None, None),
        (8, None, "", "", None, None),
        (9, "", "", "", None, None),
        (10, "://com/a://b/c", "com", "/a://b/c", "com/", "allow"),
        (11, "http://ÀB.org/" + "x" * 50_000, "Àb.org", "/" + "x" * 50_000, None, None),
        (11, "http://ÀB.org/" + "x" * 50_000, "Àb.org", "/" + "x" * 50_000, None, None),
    ]
    frame = spark.createDataFrame([(i, u, None, 1, 2) for i, u, *_ in urls], "page_id long, url string, html string, host int, rule int")
    got = url_filter.url_filter(frame).collect()
    key = lambda r: (r.page_id, r.host, r.path, r.rule)
    assert Counter(map(key, got)) == Counter((i, h, p, r) for i, _, h, p, r, _ in urls)
    want = {i: v for i, *_, v in urls if v}
    assert all(r.verdict in ("allow", "block") and r.verdict == want.get(r.page_id, r.verdict) for r in got)
    assert url_filter.url_filter(frame.limit(0)).count() == 0
    assert {r.verdict for r in url_filter.url_filter(frame, []).collect()} == {"allow"}


def test_hosts_are_split_into_known_words(spark):
    texts = spark.createDataFrame([("cheap pills " * 50 + "free bets " * 40 + "the cat " * 30,), (None,)], "text string")
    hosts = ["cheappills.com", "freebets24.the-cat.org", "", "xqzcheap.com", "a" * 300]
    got = url_filter.segmented_hosts(spark.createDataFrame([(h,) for h in hosts], "host string"), texts)
    by_host = {r.host: r.words for r in got.collect()}
    assert by_host["cheappills.com"][:2] == ["cheap", "pills"]
    assert by_host["freebets24.the-cat.org"][:4] == ["free", "bets", "the", "cat"]
    assert by_host["xqzcheap.com"][:2] == ["xqz", "cheap"] and by_host[""] == []
    assert all("".join(words) == re.sub("[^a-z]", "", host) for host, words in by_host.items())


def test_long_words_are_found(spark):
    long = "verylongcompoundwordoftwentyeightx", "длинноеслово", "x" * 70
    texts = spark.createDataFrame([(" ".join(long) + " cat",)] * 20, "text string")
    hosts = [f"{word}cat.org" for word in long] + ["q" * 40 + "cat.org"]
    got = url_filter.segmented_hosts(spark.createDataFrame([(h,) for h in hosts], "host string"), texts)
    by_host = {r.host: r.words for r in got.collect()}
    assert [by_host[h][:2] for h in hosts] == [[word, "cat"] for word in [*long, "q" * 40]]


def test_splits_and_scores_equal_brute_force(spark):
    random.seed(31)
    total, words = 1000, {w: random.randrange(1, 90) for w in ["a", "ab", "abc", "ba", "cab", "bcab"]}
    cost = lambda w: math.log(words[w] / total) if w in words else math.log(10 / (total + 1)) - len(w) * math.log(10)

    def splits(text):
        return [[]] if not text else [[text[:n], *rest] for n in range(1, len(text) + 1) for rest in splits(text[n:])]

    for _ in range(60):
        run = "".join(random.choice("abcd") for _ in range(random.randrange(1, 9)))
        held = {(n + 5, m + 5): words[run[n:m]] for n in range(len(run)) for m in range(n + 1, len(run) + 1) if run[n:m] in words}
        got = [p.decode() for p in url_filter.split_run(run.encode(), 5, held, total)]
        value = lambda parts: sum(map(cost, parts))
        assert value(got) == pytest.approx(max(map(value, splits(run)))), run
    rows = [(n, f"http://{random.choice(['m.example.com', 'shop.com', 'b.net'])}/{random.choice(['en', 'es', 'buy'])}/{n % 7}/w{n % 5}") for n in range(120)]
    rows += [(200 + n, f"http://shop.org/{random.choice(['en', 'es', 'buy'])}/{n}/w{n % 5}/new") for n in range(20)]
    frame = spark.createDataFrame([(i, u, "shop example") for i, u in rows], "page_id long, url string, html string")
    got = url_filter.url_filter(frame).collect()
    cut = lambda r: [*r.words, *("/" + ("0" if t.isdigit() else t) for t in re.findall("[a-z0-9]+", r.path))]
    sides = {"allow": Counter(), "block": Counter()}
    pages = Counter()
    for r in got:
        if r.rule:
            sides[r.verdict].update(cut(r))
            pages[r.verdict] += 1
    kinds = len(set(sides["allow"]) | set(sides["block"]))
    log = lambda side, t: math.log((sides[side][t] + 1) / (sum(sides[side].values()) + kinds))
    for r in got:
        odds = math.log(pages["block"] / pages["allow"])
        odds += sum(log("block", t) - log("allow", t) for t in cut(r) if sides["allow"][t] + sides["block"][t])
        assert r.block_score == pytest.approx(1 / (1 + math.exp(-odds)), abs=1e-6)
        assert r.rule or r.verdict == ("block" if odds > 0 else "allow")


def test_the_method_follows_the_judged_urls(spark):
    rows = [(n, f"http://m.example.com/en/{n}") for n in range(40)] + [(n, f"http://shop.com/buy/{n}") for n in range(40, 80)]
    rows += [(90, "http://other.org/en/5"), (91, "http://shop.org/buy/7")]
    frame = spark.createDataFrame([(i, u, "shop example other") for i, u in rows], "page_id long, url string, html string")
    got = {r.page_id: r for r in url_filter.url_filter(frame).collect()}
    assert (got[90].verdict, got[91].verdict, got[90].rule) == ("block", "allow", None)


# vector search


def nearest(rows, queries, k):
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, mine in whole:
        if q in queries:
            scores = sorted((-sum(a * b for a, b in zip(mine, v)), i) for i, v in whole if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return Counter(out)


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "BLOCK", 3)
    random.seed(9)
    rows = [(n, [random.gauss(0, 0.3) for _ in range(6)]) for n in range(300)]
    rows += [(n, [0.5] * 6) for n in range(300, 340)] + [(n, rows[7][1]) for n in range(340, 344)]
    rows += [(350, None), (351, [0.1, None]), (352, [float("nan")] * 6), (353, [float("inf")] * 6), (354, []), (355, [0.5, -0.2]), (None, [1.0] * 6)]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, entry int")
    got = vector_search.vector_search(frame)
    queries = {i for i, _ in rows if i is not None and i % 50 == 0}
    assert Counter(map(tuple, got.collect())) == nearest(rows, queries, 5)


def test_search_of_repeated_rows_and_ids_with_several_vectors(spark):
    random.seed(12)
    draw = lambda: [random.gauss(0, 0.3) for _ in range(4)]
    single = [(n, draw()) for n in range(120)]
    cases = [
        single * 2,  # every row twice
        single + [(50, [2.0] * 4)] * 6 + [(n, [2.0] * 4) for n in range(200, 210)],  # many rows of a query before other ids
        single + [(3, [3.0] * 4), (3, [-3.0] * 4), (3, [3.0] * 3)],  # an id with several vectors
        single + [(100, [1.0 + n, 1.0, 1.0, 1.0]) for n in range(9)],  # a query with more vectors than results
    ]
    for rows in cases:
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = Counter(map(tuple, vector_search.vector_search(frame).collect()))
        assert got == nearest(rows, {0, 50, 100, 200}, 5)


def test_search_of_few_or_no_rows(spark):
    frame = spark.createDataFrame([(0, [1.0, 2.0]), (50, [3.0, 4.0]), (7, [0.0, -1.0])], "vec_id long, embedding array<double>")
    got = vector_search.vector_search(frame)
    assert Counter(map(tuple, got.collect())) == nearest([(0, [1.0, 2.0]), (50, [3.0, 4.0]), (7, [0.0, -1.0])], {0, 50}, 5)
    assert vector_search.vector_search(frame.limit(0)).count() == 0
    assert vector_search.vector_search(frame.where("vec_id = 0")).count() == 0


def test_the_cells_leave_few_exact_reads(spark):
    random.seed(10)
    rows = [(n, [random.gauss(0, 0.12) for _ in range(32)]) for n in range(2000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    exact = vector_search.entries(vector_search.whole_numbers(frame, "vec_id", "embedding"), 5)
    low, step = vector_search.cell_ranges(exact)
    file = vector_search.file_of_cells(exact, low, step).coalesce(1)
    query = vector_search.as_matrix(exact.where("entry = 0").toArrow().column("vector").combine_chunks(), 32)
    shared = spark.sparkContext.broadcast((np.array([0]), query))
    assert file.mapInArrow(vector_search.scan(shared, low, step, 6), "query long, entry long, upper double, lower double").count() < 1200
    assert vector_search.certain(file, exact, shared, low, step, 5).count() <= 60


# chat trees


def chats(spark, rows):
    return spark.createDataFrame([(c, t, r, x, 1, 2) for c, t, r, x in rows], "conv_id long, turn long, role string, text string, path int, turns int")


CHATS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "a [INST] </s> \\ x"), (1, 2, "user", None),
    (2, 0, "user", "hi"), (2, 1, "assistant", "other"),
    (3, 1, "assistant", "late"), (3, 0, "system", "<<SYS>>\nbe good\n<</SYS>>"), (3, 2, "assistant", "\\"),
    (4, 0, "tool>", "{}"), (4, 0, "tool>", "{}"), (4, None, None, "first"),
    (5, 0, "user", "hi"), (5, 1, "assistant", "a [INST] </s> \\ x"), (5, 2, "user", None),
    (None, 0, "user", "é\n" * 3000), (6, 0, "assistant", ""),
]


def test_chat_digests(spark):
    rows = [*CHATS, (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    by_id = defaultdict(list)
    for conv, turn, role, text in rows:
        by_id[conv].append((turn is not None, turn or 0, role or "", text or ""))
    want = set()
    for conv, turns in by_id.items():
        turns = [(role, text) for _, _, role, text in sorted(turns)]
        loss = "".join(text for role, text in turns if role == "assistant")
        shown = sum(len(chat_tree.rendered(role, text)[0]) for role, text in turns)
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        want.add((conv, len(turns), sha256(whole.encode()).hexdigest(), len(loss), sha256(loss.encode()).hexdigest(), shown))
    assert {tuple(r) for r in chat_tree.chat_format(chats(spark, CHATS)).collect()} == want
    assert chat_tree.chat_format(chats(spark, CHATS).limit(0)).count() == 1
    assert chat_tree.packed(chats(spark, CHATS).limit(0)).count() == 0


def test_shared_turns_are_written_once_and_attention_is_the_path(spark):
    packs = chat_tree.packed(chats(spark, CHATS).coalesce(1)).collect()
    for pack in packs:
        nodes = [n.asDict(recursive=True) for n in pack.nodes]
        assert "".join(pack.text[n["start"] : n["end"]] for n in nodes) == pack.text
        siblings = Counter((n["parent"], pack.text[n["start"] : n["end"]]) for n in nodes)
        assert max(siblings.values()) == 1
        for node in nodes:
            seen, above = set(), node["parent"]
            while above >= 0:
                seen |= set(range(nodes[above]["start"], nodes[above]["end"]))
                above = nodes[above]["parent"]
            spans = [(a["start"], a["end"]) for a in node["attends"]]
            assert {x for s, e in spans for x in range(s, e)} == seen and node["position"] == len(seen)
        assert len(chat_tree.position_ids(nodes)) == len(pack.text)
    everything = sum(len(pack.text) for pack in packs)
    assert everything < sum(r.formatted_chars for r in chat_tree.chat_format(chats(spark, CHATS)).collect())


def test_packs_are_bounded(spark):
    rows = [(n, t, "user" if t % 2 == 0 else "assistant", "same" if t == 0 else f"{n} {t}") for n in range(300) for t in range(4)]
    frame = chats(spark, rows)
    packs = chat_tree.packed(frame, limit=2000)
    assert packs.count() > 10 and max(len(p.text) for p in packs.collect()) < 3000
    assert chat_tree.read_back(packs).count() == 300


@pytest.mark.parametrize("text", ["", "\\", "[INST]", "a</s>b", "\\[", "<s> x </s>", "<<ROLE a>>", "x\n\\\n"])
def test_escapes_are_reversible(text):
    for role in ("user", "assistant", "system", "other>role", ""):
        shown, begin, end = chat_tree.rendered(role, text)
        assert chat_tree.parsed(shown * 2) == [{"role": role, "text": text}] * 2
        assert chat_tree.unescaped(shown[begin:end]) == text


# pipeline


def test_pipeline_keeps_columns_and_drops_what_each_stage_names(spark, given):
    docs, kept = given, {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, FOLDER).persist()
        kept[name] = {r.doc_id for r in result.select("doc_id").collect()}
        assert kept[name] <= {r.doc_id for r in docs.select("doc_id").collect()}
        assert result.columns[: len(given.columns)] == given.columns
        if name != "sentencepiece":
            assert result.schema == given.schema
        docs = result
        if name == "decontaminate":
            found = decontaminate.decontaminate(before, spark.read.parquet(f"{FOLDER}/benchmark.parquet"))
            dirty = {r.doc_id for r in found.where("contaminated").collect()}
            assert kept["near_dup"] - kept[name] == dirty
        before = docs
    assert docs.where("not ids_exact").count() == 0
    classes = near_dup.near_dup(docs).groupBy("class_id").count().where("count > 1")
    assert classes.count() == 0
    assert kept["sentencepiece"] == kept["decontaminate"] and len(kept["near_dup"]) < len(kept["line_dedup"]) < len(kept["toxicity"])


def test_pipeline_takes_odd_rows(spark):
    docs = odd_documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr) == sorted(
        [(1, None), (2, ""), (None, "some words"), (3, LONG), (4, "a b")], key=repr
    )
    empty = odd_documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, FOLDER)
    assert empty.count() == 0


def test_every_operator_is_registered_once():
    numbers = [int(m[1]) for m in (re.match(r"op(\d+)_", k) for k in entry_module.queries()) if m]
    assert sorted(numbers) == list(range(1, 11)) and "pipeline" in entry_module.queries()


def test_sources_are_not_used_as_inputs(spark, given):
    """lang, source and the id of a row do not change its prediction."""
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = toxicity.train(toxicity.training_documents(given), labels)
    texts = given.select("text")
    assert toxicity.scored(texts, model).agg(F.count("*")).first()[0] == given.count()
