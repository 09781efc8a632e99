"""Phrase collocations by SON partitioning: local mining at a proportionally lowered support, then an exact global count.

Documents are dealt into ``shards`` by a hash of their text. A phrase that occurs ``support`` times in a language reaches, in
at least one shard, the share of ``support`` that this shard has of the language's words (rounded up); so the union of what
is locally frequent holds every frequent phrase. A shard is mined level by level: a phrase can be locally frequent only if both
phrases of one word less are, and all its words are globally frequent. Mining counts 64-bit hashes of phrases, spread over
the cluster (a shard is a part of the corpus, not a task); collisions can only let more pass. The last pass counts the
phrases themselves, as text, and only these counts enter results.

What passed a level is broadcast as a bitmap of ``2**BITS`` bits, a size that doesn't depend on the data: a bit that several
phrases share lets more pass and never less. Texts above ``SLICE`` bytes are worked off in slices that end with a piece.

Defined results: null text is empty; null language is ``und``; lower-casing maps A-Z only; repeated rows count each time; a
phrase never crosses a piece, a text or a language; empty tables give an empty result; columns besides text and language are
not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, PrefixHash, bounded_batches, mixed, release, small, utf8, written

#: Fixed values of the text model: bytes that end a piece, bytes between words.
PIECE_END, BLANK = b".,;:!?\n\x0b\x0c\r", b" \t"
BITS = 26
KEPT = np.uint64(2**64 - 2**16)  # mining counts the upper 48 bits of a hash
SLICE = 2 << 20

KIND = np.zeros(256, np.int8)
KIND[list(BLANK)] = 1
KIND[list(PIECE_END)] = 2
_END = re.compile(b"[" + re.escape(PIECE_END) + b"]")


def sliced(text: bytes) -> Iterator[bytes]:
    """A long text in slices of about ``SLICE`` bytes; each ends where a piece ends."""
    at = 0
    while len(text) - at > SLICE and (end := _END.search(text, at + SLICE)):
        yield text[at : end.end()]
        at = end.end()
    yield text[at:]


def groups_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list[bytes]]]:
    """Texts of about ``SLICE`` bytes with the same language and shard; batches have columns lang, shard, text."""
    for batch in batches:
        held: dict[tuple[str, int], list[bytes]] = {}
        size: dict[tuple[str, int], int] = {}
        for key, text in zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), utf8(batch.column(2))):
            for part in sliced(text):
                if held.get(key) and size[key] + len(part) > 2 * SLICE:
                    yield *key, held.pop(key)
                held.setdefault(key, []).append(part)
                size[key] = len(part) + (size[key] if len(held[key]) > 1 else 0)
        for key, texts in held.items():
            yield *key, texts


class Words:
    """The words of some texts: ``code`` per occurrence, ``piece`` numbers, and the distinct words as an Arrow array."""

    def __init__(self, texts: list[bytes]):
        buf = LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
        kind = KIND[buf]
        inside = kind == 0
        turn = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
        start, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
        offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int32)
        array = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(buf[inside])])
        encoded = array.dictionary_encode()
        self.code = encoded.indices.to_numpy().astype(np.int64)
        self.words = encoded.dictionary
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[start] if len(start) else np.zeros(0, np.int64)

    def hashes(self, salt: np.uint64) -> np.ndarray:
        n = len(self.words)
        at = np.frombuffer(self.words.buffers()[1], np.int32)[self.words.offset : self.words.offset + n + 1].astype(np.int64)
        raw = self.words.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[: at[-1]] if raw is not None and n else np.zeros(0, np.uint8)
        return mixed(PrefixHash(data).of(at[:-1], at[1:]) + (at[1:] - at[:-1]).astype(np.uint64) + salt)


def language_salt(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode(), 12))


def in_bitmap(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys >> np.uint64(64 - BITS)
    return (bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


class Level:
    """Distinct phrases of one length: their last word's code, the phrase before it, hash, and number of occurrences."""

    def __init__(self, before: np.ndarray, last: np.ndarray, key: np.ndarray, count: np.ndarray):
        self.before, self.last, self.key, self.count = before, last, key, count


def levels(words: Words, salt: np.uint64, passed: list[np.ndarray], upto: int) -> list[Level]:
    """Phrases of 1 to ``upto`` words. A phrase of k words is formed where both phrases of k - 1 words are in bitmap k - 1."""
    h = words.hashes(salt)
    n = len(h)
    out = [Level(np.zeros(n, np.int64), np.arange(n), h, np.bincount(words.code, minlength=n))]
    ident, ok = words.code, in_bitmap(passed[0], h)[words.code] if n else np.zeros(0, bool)
    for k in range(2, upto + 1):
        if len(ok) < k:
            break
        at = np.flatnonzero(ok[: len(ok) - k + 1] & ok[1 : len(ok) - k + 2] & (words.piece[: len(ok) - k + 1] == words.piece[k - 1 :]))
        own, distinct = pd.factorize(ident[at] * n + words.code[at + k - 1])
        before, last = distinct // max(n, 1), distinct % max(n, 1)
        key = mixed(out[-1].key[before] * np.uint64(31) + h[last])
        out.append(Level(before, last, key, np.bincount(own, minlength=len(distinct))))
        if k < upto:
            ident, full = np.zeros(len(ok), np.int64), np.zeros(len(ok), bool)
            ident[at], full[at] = own, in_bitmap(passed[k - 1], key)[own]
            ok = full
    return out


def spelled(words: Words, found: list[Level], k: int, take: np.ndarray) -> list[bytes]:
    """The phrases ``take`` of level k (from 1) as text."""
    names = words.words.to_pylist()
    parts = [[names[i] for i in found[k - 1].last[take].tolist()]]
    at = take
    for j in range(k - 1, 0, -1):
        at = found[j].before[at]
        parts.append([names[i] for i in found[j - 1].last[at].tolist()])
    return [b" ".join(x) for x in zip(*reversed(parts))]


def batch_of(lang: str, shard: int | None, values: pa.Array, counts: np.ndarray, name: str) -> pa.RecordBatch:
    n = len(counts)
    return pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array([shard] * n, pa.int32()), values, pa.array(counts.astype(np.int64))], names=["lang", "shard", name, "n"])


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, shard, phrase, n): per language and word, with a null shard; per language and shard the number of all words, with a
    null phrase."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, shard, group in groups_of(batches):
            words = Words(group)
            if len(words.code):
                yield batch_of(lang, None, words.words.cast(pa.string()), np.bincount(words.code, minlength=len(words.words)), "phrase")
                yield batch_of(lang, shard, pa.array([None], pa.string()), np.array([len(words.code)]), "phrase")

    return texts.mapInArrow(run, "lang string, shard int, phrase string, n long").groupBy("lang", "shard", "phrase").agg(F.sum("n").alias("n"))


def bitmap_of(keys: DataFrame) -> np.ndarray:
    """A bit for each hash in column ``key``; the driver gets ``2**BITS`` bits at most."""
    place = F.shiftrightunsigned("key", 64 - BITS)
    bits = keys.select(F.shiftright(place, 6).alias("w"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - BITS}) & 63 AS int))").alias("b"))
    t = bits.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[t.column("w").to_numpy()] = t.column("b").to_numpy().view(np.uint64)
    return out


def word_keys(words: DataFrame) -> DataFrame:
    """The hashes of words (lang, phrase), as mining computes them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = np.array(batch.column(0).to_pylist(), object)
            for one in set(lang.tolist()):
                words = Words([b"\n".join(utf8(batch.column(1).filter(pa.array(lang == one))))])
                yield pa.RecordBatch.from_arrays([pa.array(words.hashes(language_salt(one)).view(np.int64))], names=["key"])

    return words.select("lang", "phrase").mapInArrow(run, "key long")


def locally_frequent(texts: DataFrame, least: DataFrame, passed: Broadcast, k: int) -> DataFrame:
    """Hashes (key) of phrases of k words that reach their shard's support ``least`` (lang, shard, least)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, shard, group in groups_of(batches):
            found = levels(Words(group), language_salt(lang), passed.value, k)
            if len(found) == k:
                yield batch_of(lang, shard, pa.array((found[-1].key & KEPT).view(np.int64)), found[-1].count, "key")

    mined = texts.mapInArrow(run, "lang string, shard int, key long, n long").groupBy("lang", "shard", "key").agg(F.sum("n").alias("n"))
    return mined.join(least, ["lang", "shard"]).where("n >= least").select("key")


def counted(texts: DataFrame, passed: Broadcast, most: int) -> DataFrame:
    """(lang, phrase, words, n): exact counts of all phrases of 2 to ``most`` words whose hash passed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, _, group in groups_of(batches):
            words = Words(group)
            found = levels(words, language_salt(lang), passed.value, most)
            for k in range(2, len(found) + 1):
                take = np.flatnonzero(in_bitmap(passed.value[k - 1], found[k - 1].key))
                if len(take):
                    phrases = pa.array(spelled(words, found, k, take), pa.binary()).cast(pa.string())
                    yield batch_of(lang, k, phrases, found[k - 1].count[take], "phrase")

    out = texts.withColumn("shard", F.lit(0)).mapInArrow(run, "lang string, shard int, phrase string, n long")
    return out.groupBy("lang", "phrase", F.col("shard").alias("words")).agg(F.sum("n").alias("n"))


def frequent_phrases(docs: DataFrame, text: str, lang: str, most: int, support: int, shards: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases of 1 to ``most`` words that occur ``support`` times, and (lang, n) of all words."""
    spark = docs.sparkSession
    bounded_batches(spark)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.pmod(F.xxhash64(body), F.lit(shards)).cast("int").alias("shard"), body.alias("text")).where("text <> ''")
    ones = written(word_counts(texts).where((F.col("n") >= support) | F.col("phrase").isNull()), "frequent-words")
    held = ones.where("phrase is null").select("lang", "shard", "n")
    totals = held.groupBy("lang").agg(F.sum("n").alias("n"))
    least = held.join(totals.withColumnRenamed("n", "whole"), "lang").select("lang", "shard", F.expr(f"({support} * n + whole - 1) div whole").alias("least"))
    least = small(written(least, "local-support"))
    ones = ones.where("phrase is not null")
    passed = [bitmap_of(word_keys(ones))]
    for k in range(2, most + 1):
        passed.append(bitmap_of(locally_frequent(texts, least, spark.sparkContext.broadcast(list(passed)), k)))
        release(spark)
    more = counted(texts, spark.sparkContext.broadcast(passed), most).where(F.col("n") >= support)
    every = ones.select("lang", "phrase", F.lit(1).alias("words"), F.col("n").alias("f")).unionByName(more.withColumnRenamed("n", "f"))
    return written(every, "frequent-phrases"), totals


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", most: int = 3, support: int = 10, inside: int = 50, top: int = 2000, shards: int = 2) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: of each language the ``top`` phrases of 2 to ``most`` words.

    a, l, r are the occurrences of the phrase and of the two parts of its weakest cut, score is floor(1000000 a a / (l r)).
    A phrase goes if a longer frequent one that contains it has at least ``inside`` percent of its occurrences."""
    every, totals = frequent_phrases(docs, text, lang, most, support, shards)
    f = every.select("lang", "phrase", "f")
    several = every.where("words > 1").select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    joined = lambda start, length: F.array_join(F.slice("w", start, length), " ")
    cuts = several.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("left"), joined(F.col("k") + 1, F.size("w") - F.col("k")).alias("right"))
    cuts = cuts.join(f.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(f.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    whole = lambda name: F.col(name).cast("decimal(18,0)")
    cuts = cuts.withColumn("square", whole("a") * whole("a")).withColumn("product", whole("l") * whole("r"))
    score = F.expr("(square * cast(1000000 as decimal(7,0))) div product")  # decimals of 38 digits: a up to 10 ** 15 is exact
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c"))
    # what stands inside a longer phrase
    longer = several.where(F.size("w") > 2).withColumn("k", F.explode(F.sequence(F.lit(2), F.size("w") - 1)))
    longer = longer.withColumn("i", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("k") + 1)))
    longer = longer.select("lang", joined(F.col("i"), F.col("k")).alias("phrase"), F.col("a").alias("around")).groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    kept = best.join(longer, ["lang", "phrase"], "left").where(F.col("around").isNull() | (100 * F.col("around") < inside * F.col("a")))
    kept = kept.select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)  # each task hands on its own first ones only
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
