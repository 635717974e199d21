"""Codec, decontamination, line removal, near copies: against libraries and brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from hashlib import sha256

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rivermark.llm import decontaminate, line_dedup, near_dup, pieces
from rivermark.llm.components import components
from rivermark.llm.queries import PIECES
from rivermark.llm.spans import slices

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, keep_lines int, line_key int, ids int, found int, score int, row_key int"
AZ = {n: n + 32 for n in range(65, 91)}


def documents(spark, rows):
    """Rows (id, text) among columns whose names clash with those the operators add."""
    return spark.createDataFrame([(i, t, "en", 1, 2, 3, 4, 5, 6) for i, t in rows], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(AZ))


def prose(seed, count, vocabulary=400):
    random.seed(seed)
    return " ".join(f"w{random.randrange(vocabulary)}x" for _ in range(count))


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


# codec


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def odd_texts():
    random.seed(3)
    made = ["".join(random.choice("ab eé \n字tion.,thing'") for _ in range(80)) for _ in range(300)]
    return made + ["", " ", "  a  b   ", "\n\n a", "x" * 500, " " * 37 + "a", "字漢 字", "é‍👩", "tab\tx", "a\x00b", " "]


def test_ids_are_the_models(given, library):
    texts = [r.text for r in given.select("text").collect()] + odd_texts()
    codec = pieces.Codec(pieces.Vocabulary.read(PIECES))
    ids = codec.encode(pa.array(texts))
    assert ids.to_pylist() == library.encode(texts)
    assert codec.decode(ids).to_pylist() == texts


def test_unigram_ids_are_the_models():
    import numpy as np
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as format

    with open(PIECES, "rb") as file:
        model = format.ModelProto.FromString(file.read())
    model.trainer_spec.model_type = pieces.UNIGRAM
    random.seed(5)
    for piece in model.pieces:
        if piece.type == pieces.NORMAL:
            # multiples of 1/1024 add up exactly in the library's single precision; distinct enough to avoid ties
            piece.score = float(np.float32(-random.randrange(3 << 10, 14 << 10) / 1024))
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    vocabulary = pieces.Vocabulary.parsed(model)
    texts = odd_texts()
    ours, theirs = pieces.Codec(vocabulary).encode(pa.array(texts)).to_pylist(), library.encode(texts)
    for text, mine, other in zip(texts, ours, theirs):
        score = lambda ids: sum(model.pieces[n].score for n in ids if model.pieces[n].type == pieces.NORMAL)
        assert mine == other or score(mine) == pytest.approx(score(other)), text


def test_a_shared_prefix_is_scored_once():
    codec = pieces.Codec(pieces.Vocabulary.read(PIECES))
    steps, step = [], codec.last_by_merges
    codec.last_by_merges = lambda word, end, *rest: (steps.append(word[:end]), step(word, end, *rest))
    codec.segment(sorted(["▁there", "▁theres", "▁thereby", "▁the"]))
    assert len(steps) == len(set(steps)) == len("▁thereby") + 1


def test_a_word_beside_other_marks_is_not_segmented_again():
    codec = pieces.Codec(pieces.Vocabulary.read(PIECES))
    given, segment = [], codec.segment
    codec.segment = lambda words: (given.extend(words), segment(words))[1]
    for text in ("the house, there.", "there, the\nhouse\n\nthere.\nthe."):
        codec.encode(pa.array([text]))
    assert len(given) == len(set(given)) and {"▁the", "▁house", "▁there"} < set(given)


def test_words_met_in_most_batches_stay_known(monkeypatch, library):
    monkeypatch.setattr(pieces, "CACHED", 40)
    codec = pieces.Codec(pieces.Vocabulary.read(PIECES))
    given, segment = [], codec.segment
    codec.segment = lambda words: (given.extend(words), segment(words))[1]
    for n in range(60):
        texts = [f"often {prose(n, 12, 10**6)}", "y" * 3000 * (n % 2), f"often 字▁ {n}"]
        ids = codec.encode(pa.array(texts))
        assert ids.to_pylist()[:2] == library.encode(texts[:2]) and codec.decode(ids).to_pylist() == texts
    assert given.count("▁often") == 1 and len(codec.known) < 150
    assert codec.characters == sum(map(len, codec.known)) < 40 * pieces.LONG + 10_000


@pytest.mark.parametrize("kinds", [3, 20])
def test_characters_that_share_kinds_leave_the_ids_alone(monkeypatch, library, kinds):
    monkeypatch.setattr(pieces, "KINDS", kinds)
    texts = odd_texts()
    assert pieces.Codec(pieces.Vocabulary.read(PIECES)).encode(pa.array(texts)).to_pylist() == library.encode(texts)


def test_round_trip_of_a_frame(spark):
    rows = [(1, "a▁b ▁"), (2, None), (2, ""), (None, "x"), (3, "long " * 50_000), (3, "long " * 50_000)]
    frame = documents(spark, rows)
    vocabulary = pieces.Vocabulary.read(PIECES)
    coded, ids = pieces.encoded(frame, vocabulary)
    back, text = pieces.decoded(coded, vocabulary, ids)
    got = back.select("doc_id", "text", ids, text).collect()
    assert ids != "ids" and back.columns[: len(frame.columns)] == frame.columns
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(rows, key=repr)
    assert all(r[text] == r.text for r in got)
    assert {r.text: r[ids] for r in got}[None] is None and {r.text: r[ids] for r in got}[""] == []
    assert pieces.sentencepiece(frame.limit(0), PIECES).count() == 0


def test_one_worker_of_a_task_encodes_and_decodes(spark):
    rows = [(n, f"{prose(n, 30)}▁ {n}") for n in range(40)] + [(1, None), (2, ""), (3, "long " * 100_000)]
    frame, vocabulary = documents(spark, rows).coalesce(1), pieces.Vocabulary.read(PIECES)
    both, ids, text = pieces.encoded_and_decoded(frame, vocabulary)
    coded, _ = pieces.encoded(frame, vocabulary)
    back, _ = pieces.decoded(coded, vocabulary, ids)
    assert both.columns == back.columns and both.collect() == back.collect()
    assert both.where(~F.col(text).eqNullSafe(F.col("text"))).count() == 0
    for made in (both, pieces.sentencepiece(frame, PIECES), corpus_pipeline.to_pieces(spark, frame, FOLDER)):
        assert made._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_parts_of_a_batch_of_ids_are_decoded_alone():
    codec, given = pieces.Codec(pieces.Vocabulary.read(PIECES)), []
    texts = [f"{prose(n, 50)} {n}" for n in range(30)] + [None, "", "字" * 900, "a b"]
    ids = codec.encode(pa.array(texts))

    class Content:
        def take(self, values, content=codec.content):
            given.append(len(values))
            return content.take(values)

    codec.content = Content()
    parts = [p.column("ids") for p in slices(pa.RecordBatch.from_arrays([ids], names=["ids"]), "ids", 500)]
    assert [t for part in parts for t in codec.decode(part).to_pylist()] == texts
    assert len(parts) > 5 and sum(given) == len(ids.values)


# decontamination


def hits(text, items):
    """(words, hit words, names found), word by word."""
    cut = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(AZ).encode())
    own, hit, names = cut(text), set(), set()
    for name, item in items:
        theirs = cut(item)
        size = min(13, len(theirs))
        windows = {tuple(theirs[n : n + size]) for n in range(len(theirs) - size + 1)} if theirs else set()
        for n in range(len(own) - size + 1):
            if tuple(own[n : n + size]) in windows:
                hit |= set(range(n, n + size))
                names.add("" if name is None else str(name))
    return len(own), len(hit), names


def test_contamination_equals_brute_force(spark, given):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    items += [(900, "the"), (901, "of THE"), (902, ""), (903, None), (None, "and that"), (900, "in"), (904, "in")]
    long = " ".join(["x"] * 3000 + ["of the"] + ["y"] * 3000)
    rows = [(r.doc_id, r.text) for r in given.collect()] + [(-1, None), (-2, ""), (-3, long), (-3, long), (None, "in")]
    got = decontaminate.decontaminate(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    want = []
    for i, text in rows:
        n, hit, names = hits(text, items)
        digest = sha256(",".join(sorted(names)).encode()).hexdigest()
        want.append((i, n, hit, len(names), digest, hit > 0 and 20 * hit >= n))
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_a_large_benchmark_is_searched_in_passes(spark, given):
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    frame = given.limit(60)
    once, a = decontaminate.with_hits(frame, benchmark)
    parts, b = decontaminate.with_hits(frame, benchmark, characters=3000)
    assert sorted(map(str, once.select("doc_id", a).collect())) == sorted(map(str, parts.select("doc_id", b).collect()))


def test_clean_rows_keep_their_columns(spark):
    item = prose(1, 30)
    frame = documents(spark, [(1, f"before {item} after"), (2, prose(2, 50)), (3, None)])
    kept = decontaminate.clean(frame, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert kept.columns == frame.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.clean(frame, none).count() == 3 and decontaminate.clean(frame.limit(0), none).count() == 0


def test_shift_tables_skip_positions():
    sets = decontaminate.pattern_sets([("a", prose(7, 13))])
    assert len(sets) == 1 and sets[0].furthest == 12 and sorted(sets[0].shifts) == list(range(12))


# line removal


def test_long_lines_stay_only_in_their_first_document(given):
    got = {r.doc_id: r for r in line_dedup.line_dedup(given).collect()}
    seen = set()
    for row in given.orderBy("doc_id").collect():
        lines = row.text.split("\n")
        long = {n: line.strip(" \t\n\r\f\v") for n, line in enumerate(lines) if len(words(line)) >= line_dedup.MIN_WORDS}
        removed = set(got[row.doc_id].removed)
        assert {n for n, line in long.items() if line in seen} <= removed
        assert not {n for n, line in long.items() if line not in seen} & removed
        assert got[row.doc_id].text == "\n".join(line for n, line in enumerate(lines) if n not in removed)
        assert (got[row.doc_id].n_lines, got[row.doc_id].n_removed) == (len(lines), len(removed))
        seen |= set(long.values())


def test_blocks_moved_blocks_and_repeats(spark):
    a, b, c = (prose(n, 30) for n in (1, 2, 3))
    rows = [
        (1, f"{a}\nyes\n{b}\nno\n{c}"),
        (2, f"own words of this one\n{a}\nyes\n{b}\nfin"),  # a block with a short line inside
        (3, f"{c}\nmine\n{a}"),  # moved
        (4, f"{a}\n{a}\nalone here\n{a}"),  # repeated
        (5, f"yes\nno"),  # short lines only
        (6, None),
        (7, ""),
        (8, f"{a}\nyes\n{b}\nno\n{c}"),
        (8, f"{a}\nyes\n{b}\nno\n{c}"),
        (None, "a null id comes first and keeps it\nx"),
        (9, "a null id comes first and keeps it\ny"),
    ]
    frame = documents(spark, rows)
    kept, flags = line_dedup.deduplicated(frame)
    assert kept.columns[:-1] == frame.columns and flags == "keep_lines_"
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    want = [rows[0], (2, "own words of this one\nfin"), (3, "mine"), (4, "alone here"), rows[4], rows[5], rows[6]]
    want += [(8, ""), (8, ""), rows[9], (9, "y")]
    assert got == sorted(want, key=repr)
    assert line_dedup.line_dedup(frame.limit(0)).count() == 0


def measured(line):
    """Words, and half the letters of scripts without spaces."""
    import regex

    bare = line.strip(" \t\n\r\f\v")
    letters = len(regex.findall(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]", bare))
    return (len(words(bare)) + letters // 2) if bare else 0


def evidence(text):
    """Long lines and the shortest long-enough runs of short ones, with their places."""
    lines = [line.strip(" \t\n\r\f\v") for line in text.split("\n")]
    sizes, out = [measured(line) for line in lines], []
    filled = [n for n in range(len(lines)) if sizes[n]]
    for at, n in enumerate(filled):
        if sizes[n] >= line_dedup.MIN_WORDS:
            out.append(((lines[n],), [n]))
            continue
        run = []
        for m in filled[at:]:
            if sizes[m] >= line_dedup.MIN_WORDS:
                break
            run.append(m)
            if sum(sizes[k] for k in run) >= line_dedup.MIN_WORDS:
                out.append((tuple(lines[k] for k in run), run))
                break
    return out


def test_verse_lists_and_text_without_spaces(spark):
    random.seed(21)
    verse = [" ".join(random.choice("ab cd ef gh ij kl".split()) for _ in range(random.randrange(1, 4))) for _ in range(40)]
    signs = ["".join(chr(random.randrange(0x4E00, 0x4E40)) for _ in range(random.randrange(1, 30))) for _ in range(40)]
    part = lambda lines: lines[(a := random.randrange(30)) : a + random.randrange(1, 12)]
    own = lambda: [random.choice(["", "zz", "one two", "a longer line of six words", "字字"]) for _ in range(random.randrange(4))]
    rows = [(n, "\n".join([*own(), *part(verse), *own(), *part(signs), *own()])) for n in range(120)]
    rows += [(500, "\n".join(verse)), (501, "\n".join(verse)), (502, "\n".join(signs)), (503, "\n".join(signs))]
    got = {r.doc_id: r for r in line_dedup.line_dedup(documents(spark, rows)).collect()}
    seen = set()
    for doc_id, text in rows:
        removed, held = set(got[doc_id].removed), evidence(text)
        for name, places in held:
            assert name not in seen or removed.issuperset(places), (doc_id, name)
        covered = {n for _, places in held for n in places}
        assert not {n for name, places in held if len(places) == 1 and name not in seen for n in places} & removed
        assert all(n in covered or measured(text.split("\n")[n]) < line_dedup.MIN_WORDS for n in removed)
        seen |= {name for name, _ in held}
    assert got[501].text == got[503].text == ""


def test_patience_is_a_common_subsequence():
    random.seed(11)
    for _ in range(300):
        left, right = ([random.randrange(8) for _ in range(random.randrange(12))] for _ in range(2))
        matched = line_dedup.patience(left, right)
        assert all(left[i] == right[j] for i, j in matched)
        assert all(a < c and b < d for (a, b), (c, d) in zip(matched, matched[1:]))


# near copies


def shingles(text):
    own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(AZ))
    return Counter(tuple(own[n : n + 5]) for n in range(max(len(own) - 4, 1))) if own else Counter()


def similarity(left, right):
    """The definition: sum over x of 1 / sum over y of max(left[y] / left[x], right[y] / right[x])."""
    every = left.keys() | right.keys()
    return sum(1 / sum(max(left[y] / left[x], right[y] / right[x]) for y in every) for x in left.keys() & right.keys())


def altered(text, share, seed):
    random.seed(seed)
    return " ".join("zz" if random.random() < share else w for w in text.split(" "))


def test_classes_are_the_components_of_all_similar_pairs(spark):
    rows, n = [(None, None), (0, ""), (1, " \n"), (5, ".. !"), (2, "one two"), (3, "One,  two!"), (4, "one two three")], 10
    for base in range(12):
        text = prose(base, 60 + 5 * base)
        for copy, share in enumerate((0, 0, 0.01, 0.01, 0.02, 0.02, 0.03)):
            rows.append((n, altered(text, share, 100 * base + copy)))
            n += 1
    rows += [(n, "again and " * 400), (n + 1, "again and " * 401), (n + 1, "again and " * 401)]
    parent = {i: i for i in range(len(rows))}
    find = lambda i: i if parent[i] == i else find(parent[i])
    sets = [shingles(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and (sets[i] == sets[j] or similarity(sets[i], sets[j]) >= 0.8):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    want = Counter()
    for ids in groups.values():
        least = min((i for i in ids if i is not None), default=None)
        want.update((i, least, len(ids)) for i in ids)
    got = near_dup.near_dup(documents(spark, rows))
    assert Counter(map(tuple, got.collect())) == want
    kept = near_dup.one_of_each(documents(spark, rows))
    with_words = [ids for k, ids in groups.items() if sets[k]]
    assert kept.where(near_dup.has_words("text")).count() == len(with_words)
    assert kept.count() == len(groups) and kept.columns == documents(spark, []).columns
    assert near_dup.near_dup(documents(spark, [])).count() == 0 == near_dup.one_of_each(documents(spark, [])).count()


def test_registers_agree_with_the_probability_of_the_similarity():
    import numpy as np

    from rivermark.llm.spans import ALPHANUMERIC, Words

    random.seed(2)
    pairs = [(prose(n, 80, 60), altered(prose(n, 80, 60), 0.05, n)) for n in range(150)]
    texts = [t for pair in pairs for t in pair]
    owner, values, counts = near_dup.shingles(Words(pa.array(texts), ALPHANUMERIC))
    marks = near_dup.registers(owner, values, counts, len(texts)).reshape(len(pairs), 2, -1)
    agree = (marks[:, 0] == marks[:, 1]).mean()
    true = np.mean([similarity(shingles(a), shingles(b)) for a, b in pairs])
    assert agree == pytest.approx(true, abs=0.02)


def test_exact_similarity():
    import numpy as np

    random.seed(4)
    for _ in range(50):
        left, right = (Counter(random.randrange(12) for _ in range(random.randrange(1, 30))) for _ in range(2))
        arrays = [np.array(x) for c in (left, right) for x in (sorted(c), [c[k] for k in sorted(c)])]
        assert near_dup.probability_jaccard(*arrays) == pytest.approx(similarity(left, right))


@pytest.mark.parametrize("block", [2, 512])
def test_links_that_the_stars_miss_are_found_in_blocks(spark, monkeypatch, block):
    """Chains of small changes: neighbours are similar, the ends and the smallest node are not."""
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rows, n = [], 0
    for chain in range(3):
        own = prose(chain, 120).split(" ")
        for step in range(14):
            rows.append((n, " ".join(own)))
            n += 1
            own[(step * 17) % 120] = own[(step * 31 + 5) % 120] = f"neu{chain}x{step}"
    sets = [shingles(t) for _, t in rows]
    parent = list(range(n))
    find = lambda i: i if parent[i] == i else find(parent[i])
    for i in range(n):
        for j in range(i):
            if similarity(sets[i], sets[j]) >= 0.8:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    want = {(i, find(i)) for i in range(n)}
    found = near_dup.Candidates(documents(spark, rows), "doc_id", "text", 0.8)
    # without any star: the blocks alone find every class
    nothing = components(found.links(found.buckets.where("false").selectExpr("node as a", "node as b")))
    parts = components(found.across(nothing))
    members = found.signed.join(parts, "node").selectExpr("component", "key.id").groupBy("component").agg(
        F.sort_array(F.collect_list("id")).alias("ids")
    )
    got = {(i, r.ids[0]) for r in members.collect() for i in r.ids}
    assert got == {(i, c) for i, c in want if sum(c == d for _, d in want) > 1}
    assert {(r.doc_id, r.class_id) for r in near_dup.near_dup(documents(spark, rows)).collect()} == want


def test_components(spark):
    random.seed(8)
    links = [(random.randrange(60), random.randrange(60)) for _ in range(45)] + [(n, n + 1) for n in range(100, 140)]
    parent = {n: n for link in links for n in link}
    find = lambda n: n if parent[n] == n else find(parent[n])
    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    touched = {n for a, b in links if a != b for n in (a, b)}
    got = components(spark.createDataFrame(links, "a long, b long"))
    assert {tuple(r) for r in got.collect()} == {(n, find(n)) for n in touched}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# tables of the corpus operators


def test_no_operator_needs_more_than_its_columns(spark):
    frame = documents(spark, [(1, "a b c")]).withColumn("doc_id", F.col("doc_id"))
    assert line_dedup.line_dedup(frame).columns == ["doc_id", "n_lines", "n_removed", "removed", "text"]
