"""URL filters: domain and path rules, and for all other urls naive Bayes over words cut out of host names and paths.

Hosts and paths consist of pieces (stretches of letters or digits). Concatenated pieces are split into words by a unigram
Viterbi search: words and their frequencies are counted over the pages' own visible text; of all splits the one with the
largest product of word probabilities wins, where an unknown stretch costs a digit per letter. Only distinct pieces are split:
their substrings meet the word counts by a join, so that neither table is broadcast or held by one task.

Multinomial naive Bayes counts words of hosts and of paths apart, smoothed towards their share of all words, so that a rare word
is no sign of the smaller class. Labels teach it; ``seeded`` derives them from hosts that
hold a word of a short list. Words are counted per distinct host (weighted by its urls) and per distinct path piece before
anything else is joined, so a host that most urls share is one row.

Rules are a table (host, path, verdict). The suffixes of distinct hosts meet the rules' hosts by equality, then each url asks
for the beginnings of its path that have the length of such a rule, again by equality: any number of rules works.

Defined results: null urls, and urls without ``://``, have an empty host and path; they fit no rule and get the verdict of the
prior. Digits are one word; a stretch of more than ``STRETCH`` letters is split in parts of that length. Words of more than
``LONGEST`` letters are never found inside a piece. Of rules of equal length the one with the longer host wins, then the
smaller in order, then ``allow``. Of splits of equal score the one with the longer last word wins. Repeated rows get a row
each; an empty table gives an empty result; columns besides the id, the url and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, small, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STRETCH, LONGEST = 255, 24
PIECE = rf"\p{{L}}{{1,{STRETCH}}}|\p{{N}}+"
#: Words whose presence in a host name labels it, unless a caller has labels of its own.
SEEDS = ("adult", "bets", "betting", "casino", "escort", "jackpot", "pills", "poker", "porn", "replica", "spam", "viagra", "xxx")


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def pieces(text: Column) -> Column:
    """Stretches of letters, lower-cased; a stretch of digits is ``0``."""
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(f"({PIECE})"), F.lit(1)), lambda p: F.when(p.rlike(r"^\p{N}"), F.lit("0")).otherwise(p))


# ---------------------------------------------------------------- words and splits


def visible(html: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), r"<[^>]*>|&\w+;", " ")


def word_counts(texts: DataFrame, column: str, known: tuple[str, ...] = ()) -> DataFrame:
    """(word, n) of all words of the texts, and of ``known`` words (once more each)."""
    words = texts.select(F.explode(F.regexp_extract_all(F.lower(column), F.lit(r"(\p{L}+)"), F.lit(1))).alias("word"))
    extra = texts.sparkSession.createDataFrame([(w,) for w in known], "word string")
    return words.where(F.length("word") <= LONGEST).unionByName(extra).groupBy("word").agg(F.count("*").alias("n"))


def best_splits(length: np.ndarray, known: list[tuple[np.ndarray, np.ndarray, np.ndarray]], total: float) -> list[list[tuple[int, int]]]:
    """Of pieces with these lengths the words (start, end) of the likeliest split. known: per piece the starts, lengths and counts
    of its substrings that are words."""
    n, w = len(length), int(length.max())
    cost = np.broadcast_to(log(max(total, 1.0)) + np.log(10.0) * (np.arange(LONGEST + 1) - 1), (n, w, LONGEST + 1)).copy()
    for i, (start, size, count) in enumerate(known):
        cost[i, start, size] = log(max(total, 1.0)) - np.log(count)
    best, last = np.full((n, w + 1), np.inf), np.zeros((n, w + 1), np.int64)
    best[:, 0] = 0
    for end in range(1, w + 1):
        for size in range(min(LONGEST, end), 0, -1):
            now = best[:, end - size] + cost[:, end - size, size]
            better = now < best[:, end] - 1e-12
            best[better, end], last[better, end] = now[better], size
    out = []
    for i, at in enumerate(length.tolist()):
        words = []
        while at:
            words.append((at - int(last[i, at]), at))
            at = words[-1][0]
        out.append(words[::-1])
    return out


def segmented(found: DataFrame, counts: DataFrame) -> DataFrame:
    """(piece, words) of distinct pieces, split by ``counts`` (word, n)."""
    total = float(counts.agg(F.sum("n")).first()[0] or 1)
    start = found.withColumn("s", F.explode(F.sequence(F.lit(0), F.length("piece") - 1)))
    parts = start.withColumn("k", F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length("piece") - F.col("s")))))
    parts = parts.select("piece", "s", "k", F.substring("piece", F.col("s") + 1, F.col("k")).alias("word")).join(counts, "word")
    known = parts.groupBy("piece").agg(F.collect_list(F.struct("s", "k", "n")).alias("known"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            known = [tuple(np.array([x[c] for x in row or ()], np.int64) for c in ("s", "k", "n")) for row in batch.column(1).to_pylist()]
            size = np.array([len(p) for p in names])
            words: list[list[str]] = [[]] * len(names)
            order = np.argsort(size)
            for part in (order[a : a + 500] for a in range(0, len(order), 500)):
                for i, spans in zip(part.tolist(), best_splits(size[part], [known[i] for i in part], total)):
                    words[i] = [names[i][a:b] for a, b in spans]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string()))], names=["piece", "words"])

    return found.join(known, "piece", "left").select("piece", "known").mapInArrow(run, "piece string, words array<string>")


# ---------------------------------------------------------------- naive Bayes


def seeded(hosts: DataFrame, splits: DataFrame, seeds: tuple[str, ...] = SEEDS) -> DataFrame:
    """(host, bad): whether a word of the host is among ``seeds``."""
    marked = splits.select("piece", F.arrays_overlap("words", F.array(*map(F.lit, seeds))).alias("hit"))
    each = hosts.select("host", F.explode_outer(F.array_distinct(pieces(F.col("host")))).alias("piece"))
    return each.join(marked, "piece", "left").groupBy("host").agg(F.coalesce(F.max("hit"), F.lit(False)).alias("bad"))


def word_odds(hosts: DataFrame, paths: DataFrame, splits: DataFrame) -> tuple[DataFrame, float]:
    """(kind, piece, odds): the log odds that naive Bayes gives each piece, and those of the prior. hosts: host, n, bad (null:
    teaches nothing). paths: piece, bad, n of path pieces."""
    of_host = hosts.select(F.explode(pieces(F.col("host"))).alias("piece"), "bad", "n")
    side = lambda df, kind: df.groupBy("piece").agg(F.lit(kind).alias("kind"), *(F.coalesce(F.sum(F.when(F.col("bad") == b, F.col("n"))), F.lit(0)).alias(name) for name, b in (("no", False), ("yes", True))))
    counts = side(of_host, "host").unionByName(side(paths, "path")).join(splits, "piece")
    words = counts.select("kind", "piece", F.explode("words").alias("word"), "no", "yes")
    words = written(words, "piece-words")
    model = words.groupBy("kind", "word").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes"))
    model = written(model, "word-classes")
    v, no, yes = model.agg(F.count("*"), F.coalesce(F.sum("no"), F.lit(0)), F.coalesce(F.sum("yes"), F.lit(0))).first()
    share = (F.col("yes") + F.col("no") + 1) / F.lit(float(yes + no + v + 1))  # of all words; each class starts with v words dealt like that
    odds = F.log((F.col("yes") + v * share) / F.lit(float(yes + v + 1))) - F.log((F.col("no") + v * share) / F.lit(float(no + v + 1)))
    if not yes or not no:  # one class only: nothing tells them apart
        odds = F.lit(0.0)
    scored = words.select("kind", "piece", "word").join(model.select("kind", "word", odds.alias("odds")), ["kind", "word"])
    urls = hosts.agg(*(F.coalesce(F.sum(F.when(F.col("bad") == b, F.col("n"))), F.lit(0)) for b in (False, True))).first()
    return scored.groupBy("kind", "piece").agg(F.sum("odds").alias("odds")), log((urls[1] + 1) / (urls[0] + 1))


# ---------------------------------------------------------------- rules


def fitting_rules(rows: DataFrame, hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(row, rule, rule_verdict) of rows (row, host, path) that a rule fits: the longest one."""
    rules = rules.select(F.translate("host", UPPER, LOWER).alias("on"), F.col("path").alias("begin"), "verdict").where("on is not null and begin is not null")
    rules = written(rules.groupBy("on", "begin").agg(F.min("verdict").alias("verdict")), "rules")
    lengths = rules.groupBy("on").agg(F.collect_set(F.length("begin")).alias("lengths"))
    labels = F.split("host", r"\.", -1)
    suffix = hosts.select("host", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("on"))
    asked = small(written(suffix.join(lengths, "on").select("host", "on", F.explode("lengths").alias("length")), "rule-hosts"))
    each = rows.join(asked, "host").where(F.length("path") >= F.col("length"))
    each = each.select("row", "on", F.substring("path", F.lit(1), F.col("length")).alias("begin"))
    best = F.max_by(F.struct(F.concat("on", "begin").alias("rule"), F.col("verdict").alias("rule_verdict")), F.struct(F.length("on") + F.length("begin"), F.length("on")))
    return each.join(small(rules), ["on", "begin"]).groupBy("row").agg(best.alias("r")).select("row", "r.*")


def judged(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", text: str = "html", seeds: tuple[str, ...] = SEEDS) -> DataFrame:
    """page_id, host, path, rule, verdict, score for every row; score is the log odds of block, whatever a rule says."""
    bounded_batches(pages.sparkSession)
    words = written(word_counts(pages.select(visible(F.col(text)).alias("text")), "text", seeds), "word-counts")
    address = F.col(url).cast("string")
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col(page_id).alias("page_id"), host_of(address).alias("host"), path_of(address).alias("path"))
    rows = written(rows, "urls")
    hosts = written(rows.groupBy("host").agg(F.count("*").alias("n")), "hosts")
    in_paths = rows.groupBy("host", "path").agg(F.count("*").alias("n")).select("host", "n", F.explode(pieces(F.col("path"))).alias("piece"))
    in_paths = written(in_paths.groupBy("host", "piece").agg(F.sum("n").alias("n")), "path-pieces")
    found = hosts.select(F.explode(pieces(F.col("host"))).alias("piece")).unionByName(in_paths.select("piece")).distinct()
    splits = written(segmented(found, words), "splits")
    hosts = written(hosts.join(seeded(hosts, splits, seeds), "host"), "labelled-hosts")
    paths = in_paths.join(small(hosts.select("host", "bad")), "host").groupBy("piece", "bad").agg(F.sum("n").alias("n"))
    odds, prior = word_odds(hosts, paths, splits)
    odds = written(odds, "piece-odds")
    of = lambda kind: small(odds.where(F.col("kind") == kind).select("piece", "odds"))
    in_host = hosts.select("host", F.explode(pieces(F.col("host"))).alias("piece")).join(of("host"), "piece").groupBy("host").agg(F.sum("odds").alias("host_odds"))
    in_path = rows.select("row", F.explode(pieces(F.col("path"))).alias("piece")).join(of("path"), "piece").groupBy("row").agg(F.sum("odds").alias("path_odds"))
    ruled = fitting_rules(rows, hosts, rules)
    every = rows.join(small(written(in_host, "host-odds")), "host", "left").join(in_path, "row", "left").join(ruled, "row", "left")
    score = F.coalesce("host_odds", F.lit(0.0)) + F.coalesce("path_odds", F.lit(0.0)) + F.lit(prior)
    verdict = F.coalesce("rule_verdict", F.when(score > 0, F.lit("block")).otherwise(F.lit("allow")))
    return every.select("page_id", "host", "path", "rule", verdict.alias("verdict"), score.alias("score"))
