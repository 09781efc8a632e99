import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from kinelake.llm import suffixes
from kinelake.llm.queries import QUERIES


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    for t in raw:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        yield len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()


def same(rows, texts, length, ids):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}
    for i, want in zip(ids, brute(texts, length), strict=True):
        assert got[i] == want, i


def test_query_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    same(QUERIES["op9_suffix_dedup"](spark, sf).collect(), [r.text for r in docs], 200, [r.doc_id for r in docs])


@pytest.mark.parametrize("hot", [20000, 4, 1])
@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh "])
def test_random_texts(spark, hot, alphabet, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 300)
    rng = random.Random(len(alphabet) + hot)
    word = lambda n: "".join(rng.choices(alphabet, k=n))
    shared = [word(n) for n in (20, 25, 40, 90)]
    texts = ["".join(rng.choice([*shared, word(rng.randint(1, 30))]) for _ in range(rng.randint(0, 12))) for _ in range(60)]
    texts += ["", None, "é" * 50, "a" * 400, "xy" * 100, texts[3], word(900)]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, digest string")
    same(suffixes.without_repeats(df, length=20, gram=8, hot=hot).collect(), texts, 20, range(len(texts)))


def test_keep_first_leaves_one_copy(spark):
    rng = random.Random(1)
    word = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    passage = word(120)
    texts = [word(50) + passage + word(50) if i % 3 else word(150) for i in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in suffixes.without_repeats(df, length=40, gram=16, keep_first=True).collect()}
    assert kept[1] == texts[1] and sum(passage in t for t in kept.values()) == 1
    assert all(kept[i] == texts[i] for i in range(0, 30, 3))
    seen = Counter(t[i : i + 40] for t in kept.values() for i in range(len(t) - 39))
    assert sum(n > 1 for n in seen.values()) <= 80  # only across the joints


def test_collisions_are_found_and_sorted_again(monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choices("ab", k=30)).encode() for _ in range(50)]
    buf = np.frombuffer(b"".join(texts), np.uint8)
    start, size, at = np.arange(50) * 30, np.full(50, 30), np.array([0, 20, 50])
    monkeypatch.setattr(suffixes, "BASE", 1)  # with base 1 any two strings of equal byte sums collide
    order, common = suffixes.neighbours(buf, start, size, at)
    for a, b in ((0, 20), (20, 50)):
        assert [texts[i] for i in order[a:b]] == sorted(texts[a:b])
    for k in range(1, 50):
        x, y = texts[order[k - 1]], texts[order[k]]
        want = next((i for i in range(30) if x[i] != y[i]), 30)
        assert common[k] == (-1 if k in (20,) else want)


def test_empty_table_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, "x" * 100), (4, "y z" * 100), (4, "y z" * 100)], "doc_id long, text string")
    assert suffixes.without_repeats(df.limit(0)).count() == 0
    got = suffixes.without_repeats(df).collect()
    assert sorted(r.n_removed for r in got) == [0, 300, 300]


def letters(rng, n):
    return "".join(rng.choices("abcdefgh ", k=n))


def test_texts_of_few_windows_alone_in_their_tasks(spark):
    rng = random.Random(31)
    texts = [t for n in (199, 200, 201, 215, 229, 230, 231, 232, 233, 259, 260) for t in [letters(rng, n)] * 2]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(len(rows), "doc_id")
    same(suffixes.without_repeats(df).collect(), texts, 200, range(len(texts)))


def test_the_last_piece_of_a_very_long_text(spark):
    rng = random.Random(32)
    step = suffixes.PIECE - 199
    tail = letters(rng, 230)
    texts = [letters(rng, step) + tail, letters(rng, 300) + tail + letters(rng, 50), letters(rng, 2 * step + 215)]
    got = {r.doc_id: r.n_removed for r in suffixes.without_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {0: 230, 1: 230, 2: 0}


def test_ids_that_repeat_or_are_null_are_rows_of_their_own(spark):
    rng = random.Random(33)
    one, other = letters(rng, 320), letters(rng, 320)
    rows = [(None, one), (None, other), (5, one), (7, letters(rng, 600)), (7, letters(rng, 500)), (-(1 << 63), letters(rng, 400))]
    got = suffixes.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), keep_first=False).collect()
    assert sorted(r.n_removed for r in got) == [0, 0, 0, 0, 320, 320]
    twice = spark.createDataFrame([(7, one * 2), (7, one * 2)], "doc_id long, text string")
    kept = suffixes.without_repeats(twice, keep_first=True).collect()
    assert sorted(r.n_removed for r in kept) == [320, 640]  # the first row keeps one copy of each window


def test_contexts_of_a_hot_anchor_are_split_and_sorted(spark):
    rng = random.Random(34)
    line = letters(rng, 190)
    near = letters(rng, 15)
    texts = [letters(rng, 250) + (near if i % 3 else letters(rng, 15)) + line + (near if i % 2 else letters(rng, 15)) + letters(rng, 240) for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for hot in (30, 8):
        same(suffixes.without_repeats(df, hot=hot).collect(), texts, 200, range(len(texts)))
