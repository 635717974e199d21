"""URL filter: rules first, then naive Bayes over segmented host names.

A rule is a host with a path (``example.com/en/``); it fits its host and all
subdomains if the url's path starts with its path, and the longest fitting rule decides (of equal
ones that with the longer host). Urls that no rule fits are judged by a
multinomial naive Bayes model learned from those that one does: its tokens are the words of the host and of the path.

Host names are concatenated words. They are split by unigram Viterbi: the best product of word
probabilities, with counts from the words of all page texts. Only pieces of a distinct host that are as long as some
word are joined with the word table. A piece that is no word costs ten times more per character, as a long
unknown string is less likely to be one word.

Every token has a weight of its own. Weights are joined to the tokens of distinct hosts and distinct paths and added up there as whole
billionths, so the order of additions does not matter; pages get the two sums. A score of exactly 0.5 is allowed.
Words are runs of ASCII letters and characters beyond ASCII, numbers are one token.

Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; path: from there up to ``? #`` or the end; both
empty if the url is null or has no ``://``. Without rules that fit some url, or with one verdict only, the
method gives the verdict of the larger class (allow if there is none). Null page texts have no words;
repeated rows are judged alike.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivermark.llm.rows import col, stored
from rivermark.llm.spans import LETTERS, Words, slices, span_hash

# fixed values: the rules of the production filter
RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]
UNIT = 10**9  # of whole numbers in a weight
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The rule that decides, and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, judged in sorted(rules, key=lambda r: (len(r[0]), r[0].index("/"))):
        name, slash, begin = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + begin))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, judged).otherwise(verdict)
    return rule, verdict


def count_words(batches):
    """(word, size, n): hash, bytes and number of the words of texts."""
    for batch in batches:
        for part in slices(batch, "text"):
            words = Words(part.column("text"), LETTERS)
            hashes, first, n = np.unique(words.hashes, return_index=True, return_counts=True)
            size = (words.ends - words.starts)[first]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(size.astype(np.int32)), pa.array(n.astype(np.int64))],
                names=["word", "size", "n"],
            )


def host_pieces(lengths: list[int]):
    """Every run of each word of a host that is as long as some word: (host, start, end, word), ``word`` the run's hash."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "host", 1 << 14):
                words = Words(part.column("host"), LETTERS)
                sizes = words.ends - words.starts
                for length in lengths:
                    count = np.where(sizes >= length, sizes - length + 1, 0)
                    owner = np.repeat(np.arange(len(words)), count)
                    if not len(owner):
                        continue
                    starts = words.starts[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                    base = words.cuts[words.text_of[owner]]
                    hashes = span_hash(words.sums, starts, starts + length)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("host").take(pa.array(words.text_of[owner])),
                            pa.array((starts - base).astype(np.int32)),
                            pa.array((starts + length - base).astype(np.int32)),
                            pa.array(hashes.view(np.int64)),
                        ],
                        names=["host", "start", "end", "word"],
                    )

    return run


def split_run(run: bytes, at: int, counts: dict[tuple[int, int], int], total: int) -> list[bytes]:
    """The best split of the run that starts at byte ``at`` of its host; ``counts`` has its known pieces."""
    known: dict[int, list[tuple[int, float]]] = {}
    for (start, end), n in counts.items():
        if at <= start and end <= at + len(run):
            known.setdefault(end - at, []).append((start - at, math.log(n / total)))
    unknown, each = math.log(10 / (total + 1)), math.log(10)
    best, back = [0.0], [0]
    open_, opened = 0.0, 0  # the best start of an unknown piece, each of whose characters costs the same
    for end in range(1, len(run) + 1):
        options = [(best[start] + cost, start) for start, cost in known.get(end, ())]
        options.append((open_ + unknown - end * each, opened))
        score, start = max(options)
        best.append(score)
        back.append(start)
        if score + end * each > open_:
            open_, opened = score + end * each, end
    words, end = [], len(run)
    while end:
        words.append(run[back[end] : end])
        end = back[end]
    return words[::-1]


def segment(total: int):
    def run(batches):
        for batch in batches:
            out = []
            for host, known in zip(batch.column("host").to_pylist(), batch.column("known").to_pylist()):
                words = Words(pa.array([host]), LETTERS)
                counts = {(k["start"], k["end"]): k["n"] for k in known or ()}
                parts = [
                    part.decode("utf-8", "replace")
                    for s, e in zip(words.starts.tolist(), words.ends.tolist())
                    for part in split_run(words.raw[s:e].tobytes(), s, counts, total)
                ]
                out.append(parts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), pa.array(out, pa.list_(pa.string()))], names=["host", "words"]
            )

    return run


def segmented_hosts(hosts: DataFrame, texts: DataFrame) -> DataFrame:
    """(host, words) of distinct ``hosts`` (host), by the words of ``texts`` (text)."""
    counts = texts.mapInArrow(count_words, "word long, size int, n long").groupBy("word", "size").agg(F.sum("n").alias("n"))
    counts = stored(counts, "word-counts")
    total = counts.agg(F.sum("n")).first()[0] or 1
    lengths = sorted(r["size"] for r in counts.select("size").distinct().collect())  # far fewer than the longest word has bytes
    pieces = hosts.mapInArrow(host_pieces(lengths), "host string, start int, end int, word long").join(counts, "word")
    known = pieces.groupBy("host").agg(F.collect_list(F.struct("start", "end", "n")).alias("known"))
    return hosts.join(known, "host", "left").select("host", "known").mapInArrow(segment(total), "host string, words array<string>")


def path_tokens(path: Column) -> Column:
    """Words of a path; numbers are one token."""
    parts = F.filter(F.split(F.translate(path, UPPER, LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda t: t != "")
    return F.transform(parts, lambda t: F.concat(F.lit("/"), F.when(t.rlike("^[0-9]+$"), "0").otherwise(t)))


def token_weights(judged: DataFrame) -> tuple[DataFrame, float]:
    """(token, weight) towards block in billionths, and the prior, from rows (words, path, verdict) with a verdict."""
    sides = {r.verdict: r.n for r in judged.groupBy("verdict").agg(F.count("*").alias("n")).collect()}
    prior = math.log(sides.get("block", 0) + 1e-9) - math.log(sides.get("allow", 0) + 1e-9)
    block = (F.col("verdict") == "block").cast("long")
    rows = judged.select(F.explode(F.concat("words", path_tokens(F.col("path")))).alias("token"), block.alias("block"))
    counts = rows.groupBy("token").agg(F.sum("block").alias("block"), F.sum(1 - F.col("block")).alias("allow"))
    counts = stored(counts, "token-counts")
    used = counts.agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"), F.count("*").alias("kinds")).first()
    if len(sides) < 2:
        return counts.select("token", F.lit(0).cast("long").alias("weight")), prior
    log = lambda side: F.log((F.col(side) + 1) / (used[side] + used.kinds))
    return counts.select("token", F.round((log("block") - log("allow")) * UNIT).cast("long").alias("weight")), prior


def summed(each: DataFrame, key: str, weights: DataFrame, name: str) -> DataFrame:
    """(key, name): the weights of the tokens of each (key, tokens) added up, stored."""
    rows = each.select(key, F.explode("tokens").alias("token")).join(weights, "token")
    return stored(rows.groupBy(key).agg(F.sum("weight").alias(name)), name)


def url_filter(pages: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, the host's words and the method's share for block."""
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"))
    host, path = host_and_path(F.col("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "verdict": verdict})
    texts = pages.select(F.regexp_replace(col("html").cast("string"), "<[^>]*>", " ").alias("text"))
    hosts = segmented_hosts(rows.select("host").distinct(), texts)
    hosts = stored(hosts, "host-words")
    known = rows.join(hosts, "host")
    weights, prior = token_weights(known.where("verdict is not null").select("words", "path", "verdict"))
    of_host = summed(hosts.select("host", F.col("words").alias("tokens")), "host", weights, "host_odds")
    paths = rows.select("path").distinct()
    of_path = summed(paths.select("path", path_tokens(F.col("path")).alias("tokens")), "path", weights, "path_odds")
    judged = known.join(of_host, "host", "left").join(of_path, "path", "left")
    odds = prior + (F.coalesce("host_odds", F.lit(0)) + F.coalesce("path_odds", F.lit(0))) / UNIT
    judged = judged.withColumn("block_score", 1 / (1 + F.exp(-F.greatest(F.least(odds, F.lit(50.0)), F.lit(-50.0)))))
    by_method = F.when(F.col("block_score") > 0.5, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", by_method).alias("verdict"), "words", "block_score"
    )
