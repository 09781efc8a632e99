"""Token counts of a BPE piece model by a map-side two-tier lookup.

No piece of the model holds a blank after another character, nor a line feed, so that merges never cross a pre-token: a
run of blanks and what follows up to the next blank or line feed, or a line feed. (Both facts are checked when a worker
loads the model.) The first tier is a broadcast table of the lengths of frequent pre-tokens, of at most ``entries``
entries, learned from at most ``sample`` texts; it saves time and never changes a count. Misses go to a cache in each
Python worker, and from there to the library. Nothing is shuffled.

Defined results: null text is empty; an empty text has no tokens; very long texts are counted whole, very long pre-tokens
without the cache; ids pass through untouched, other columns are dropped; repeated rows are counted each; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, hash_bound, utf8

BLANK = "▁"
SPLIT = re.compile(r"\n| +[^ \n]*|[^ \n]+")
#: Worker caches are emptied above this many pre-tokens; longer pre-tokens aren't kept.
CACHE, LONGEST = 200_000, 64

_models: dict[str, PieceCounter] = {}


class PieceCounter:
    """Counts the pieces of a text from those of its pre-tokens."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if not self.model.is_byte(i) and (BLANK in piece.lstrip(BLANK) or "\n" in piece):
                raise ValueError(f"pieces of this model cross pre-tokens: {piece!r}")
        self.cache: dict[str, int] = {}

    def library(self, text: str) -> int:
        return len(self.model.encode(text, num_threads=1))

    def encoded(self, token: str) -> int:
        """Pieces of one pre-token; the library itself puts a blank before a text."""
        if token == "\n":
            return self.library("\n") - 1
        if token == " ":
            return 1
        if token[0] == " ":
            return self.library(token[1:])
        return self.library("\n" + token) - self.library("\n")

    def miss(self, token: str) -> int:
        n = self.cache.get(token)
        if n is None:
            n = self.encoded(token)
            if len(token) <= LONGEST:
                if len(self.cache) >= CACHE:
                    self.cache.clear()
                self.cache[token] = n
        return n


def pre_tokens(text: str) -> list[str]:
    return SPLIT.findall(" " + text.replace(BLANK, " ")) if text else []


def counter(model_file: str) -> PieceCounter:
    """One per Python worker and model."""
    if model_file not in _models:
        _models[model_file] = PieceCounter(model_file)
    return _models[model_file]


def frequent(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text", sample: int = 4000, entries: int = 20_000) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of ``sample`` whole texts, chosen by a hash of the id."""
    bound = hash_bound(docs, doc_id, sample)
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = Counter()
            for raw in utf8(batch.column(0)):
                seen.update(t for t in pre_tokens(raw.decode("utf-8", "replace")) if len(t) <= LONGEST)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["token", "n"])

    chosen = docs.where(F.xxhash64(doc_id) <= F.lit(bound)).select(F.col(text).cast("string").alias("t"))
    counts = chosen.mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    own = counter(model_file)
    return {r.token: own.encoded(r.token) for r in counts.orderBy(F.desc("n"), "token").limit(entries).collect()}


def count_tokens(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text", limit: int = 4096, entries: int = 20_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row."""
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(frequent(docs, model_file, doc_id, text, entries=entries))
    bounded_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = counter(model_file), table.value
        for batch in batches:
            raw = utf8(batch.column(1))
            counts = []
            for t in raw:
                n = 0
                tokens = pre_tokens(t.decode("utf-8", "replace"))
                for got, token in zip(map(known.get, tokens), tokens):
                    n += own.miss(token) if got is None else got
                counts.append(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, raw), pa.int64()), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
