import random
import re
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from kinelake.llm import phrases

SCHEMA = "doc_id long, text string, lang string, n long, phrase string, shard int, key long"


def plain(rows, most=3, support=10, inside=50, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, most + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    out = []
    around = Counter()
    for (lang, p), a in f.items():
        if a >= support:
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    around[lang, p[i : i + k]] = max(around[lang, p[i : i + k]], a)
    for (lang, p), a in f.items():
        if a < support or len(p) < 2 or 100 * around[lang, p] >= inside * a and around[lang, p]:
            continue
        cuts = [(int(Fraction(1000000 * a * a, f[lang, p[:k]] * f[lang, p[k:]])), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        out.append((lang, " ".join(p), a, left, right, n[lang], score))
    ranked = []
    for lang in {x[0] for x in out}:
        mine = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:top]
        ranked += [(lang, i + 1, *x[1:]) for i, x in enumerate(mine)]
    return sorted(ranked)


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, t, lang, 1, "x", 2, 3) for i, (t, lang) in enumerate(rows)], SCHEMA)
    out = phrases.collocations(df, **options)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in out.collect())


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = ["the", "of", "Big", "bang", "é", "naïve", "x-1", "ÄB", "a\u00a0b", "0", "<b>"] + [f"w{i}" for i in range(12)]
    sign = [" ", " ", " ", " ", "\t", "  ", ". ", ", ", "\n", "\r\n", "\x0b", "? "]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words[: rng.choice([3, 8, len(words)])]) + rng.choice(sign) for _ in range(rng.choice([0, 1, 3, 40, 90])))
        rows.append((text, rng.choice(["en", "en", "en", "de", None])))
    return rows + [(None, "en"), ("", "fr"), (None, None), ("\x0c..", "en")] + [("the big bang theory, The Big Bang", "en")] * 7


@pytest.mark.parametrize("seed, shards", [(0, 1), (1, 3), (2, 9)])
def test_equals_plain_counts(spark, seed, shards):
    rows = corpus(seed)
    assert found(spark, rows, shards=shards) == plain(rows)


def test_longer_phrases_lower_support_and_few_rows(spark):
    rows = corpus(7, 60)
    options = {"most": 5, "support": 3, "inside": 80, "top": 9}
    assert found(spark, rows, shards=2, **options) == plain(rows, **options)


def test_ties_keep_the_order_of_bytes(spark):
    rows = [("b a\nz é\nz ê\nz e\nZ \U0001f600\nz \uffff", "en")] * 10
    got = found(spark, rows)
    assert got == plain(rows) and [r[2] for r in got] == ["b a", "z e", "z é", "z ê", "z \uffff", "z \U0001f600"]


def test_slices_of_a_very_long_text(spark, monkeypatch):
    rows = corpus(3, 20)
    long = "\n".join(t or "" for t, _ in rows) * 30
    assert b"".join(phrases.sliced(long.encode())) == long.encode()
    monkeypatch.setattr(phrases, "SLICE", 50)
    parts = list(phrases.sliced(long.encode()))
    assert len(parts) > 100 and b"".join(parts) == long.encode() and all(p[-1:] in [bytes([c]) for c in phrases.PIECE_END] for p in parts[:-1])
    monkeypatch.undo()
    assert found(spark, [(long, "en"), ("no end " * 50_000, "en")]) == plain([(long, "en"), ("no end " * 50_000, "en")])


def test_local_mining_keeps_all_frequent_phrases_and_drops_rare_ones(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abcdefghij") + rng.choice("klmnopq") for _ in range(50)), "en") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("shard", F.pmod(F.xxhash64("text"), F.lit(4)).cast("int"))
    every, _ = phrases.frequent_phrases(df, "text", "lang", 2, 10, 4)
    assert {tuple(r.phrase.split()): r.f for r in every.where("words = 2").collect()} == {
        k: v for k, v in Counter(p for _, t, _ in rows for p in zip(t.split(), t.split()[1:])).items() if v >= 10
    }
    ones = phrases.word_counts(df.select("lang", "shard", "text")).where("phrase is not null and n >= 10")
    totals = df.groupBy("lang", "shard").agg(F.sum(F.size(F.split("text", " "))).alias("m"))
    least = totals.select("lang", "shard", F.ceil(10 * F.col("m") / 10_000).alias("least"))
    passed = spark.sparkContext.broadcast([phrases.bitmap_of(phrases.word_keys(ones))])
    local = phrases.locally_frequent(df.select("lang", "shard", "text"), least, passed, 2).distinct().count()
    everything = len({p for _, t, _ in rows for p in zip(t.split(), t.split()[1:])})
    assert every.where("words = 2").count() <= local < everything


def test_large_counts_stay_exact(spark):
    big = spark.range(1).selectExpr("cast(123456789012 as decimal(18,0)) a", "cast(987654321098 as decimal(18,0)) b")
    got = big.selectExpr("((a * a) * cast(1000000 as decimal(7,0))) div (b * b) x").first().x
    assert got == 1000000 * 123456789012**2 // 987654321098**2


def test_empty_table(spark):
    assert found(spark, []) == []
