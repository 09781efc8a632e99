import random
import re

import numpy as np

from kinelake.llm import decontam
from kinelake.llm.queries import QUERIES


def smith_waterman(x, y):
    h = np.zeros((len(x) + 1, len(y) + 1), int)
    for i in range(1, len(x) + 1):
        for j in range(1, len(y) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if x[i - 1] == y[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return int(h.max())


def words(t):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), t or ""))


def test_alignment_is_smith_waterman():
    rng = random.Random(2)
    for _ in range(60):
        x = np.array([rng.randrange(5) for _ in range(rng.randint(1, 12))])
        y = np.array([rng.randrange(5) for _ in range(rng.randint(1, 20))])
        assert decontam.aligned(x, y[None])[0] == smith_waterman(x, y)


def test_query_against_brute_force(spark, sf):
    docs = [(r.doc_id, words(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, words(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {}
    for d, w in docs:
        seeds = {tuple(w[i : i + 4]) for i in range(len(w) - 3)}
        for i, v in items:
            if any(tuple(v[k : k + 4]) in seeds for k in range(len(v) - 3)):
                score = smith_waterman(v, w) / (2 * len(v))
                if score >= 0.5:
                    want[d, i] = score
    got = {(r.doc_id, r.item_id): r.score for r in QUERIES["op1_decontaminate"](spark, sf).collect()}
    assert got == want and want


def test_edited_copies_nulls_ties_blocks(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    passage = [word() for _ in range(40)]
    edited = [word() if i % 9 == 4 else w for i, w in enumerate(passage) if i % 13 != 6]
    filler = lambda n: [word() for _ in range(n)]
    texts = {1: filler(500) + edited + filler(300), 2: filler(900), 3: [w.upper() + "," for w in passage], 4: passage[:8], 5: []}
    rows = [(i, " ".join(w), "x") for i, w in texts.items()] + [(6, None, "x"), (None, " ".join(passage), "x"), (3, " ".join(passage), "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(7, " ".join(passage)), (8, " ".join(passage)), (9, None), (10, ""), (11, "the of")], "item_id long, text string")
    for block in (20000, 2):
        got = decontam.contaminated(docs, items, block=block).collect()
        assert sorted((r.doc_id or 0, r.item_id) for r in got) == [(0, 7), (0, 8), (1, 7), (1, 8), (3, 7), (3, 8)]
        assert all(0.5 < r.score < 1 if r.doc_id == 1 else r.score == 1 for r in got)
    assert decontam.contaminated(docs.limit(0), items).count() == 0
    assert decontam.contaminated(docs, items.limit(0)).count() == 0


def test_a_passage_in_a_third_of_all_documents(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    passage = " ".join(word() for _ in range(30))
    rows = [(i, " ".join(word() for _ in range(20)) + (f" {passage}" if i % 3 == 0 else "")) for i in range(600)]
    got = decontam.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, passage)], "item_id long, text string"))
    assert sorted(r.doc_id for r in got.collect()) == list(range(0, 600, 3))


def test_rare_and_common_copies_without_any_seed_condition(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    passage = [word() for _ in range(40)]
    hot = [word() if i in (3, 10, 17, 24, 31) else w for i, w in enumerate(passage)]
    thin = [word() if i % 4 == 3 else w for i, w in enumerate(passage)]  # no four words in a row
    spread = [x for w in passage for x in (w, word())]  # no two words in a row
    texts = [passage, *[hot] * 120, thin, spread, *([word() for _ in range(300)] for _ in range(20))]
    texts = [[word() for _ in range(rng.randint(0, 90))] + t + [word() for _ in range(30)] for t in texts]
    want = {i: smith_waterman(passage, t) / 80 for i, t in enumerate(texts)}
    want = {i: s for i, s in want.items() if s >= 0.5}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = decontam.contaminated(docs, spark.createDataFrame([(1, " ".join(passage))], "item_id long, text string"))
    assert {r.doc_id: r.score for r in got.collect()} == want and len(want) == 123


def test_items_of_every_shape_against_brute_force(spark):
    """Repeated words, items above 64 words, copies without seeds, passages over the ends of texts."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choices("abcdefgh", k=3))
    common = [word() for _ in range(30)]
    some = lambda n: [rng.choice(common) if rng.random() < 0.5 else word() for _ in range(n)]
    items = [some(rng.choice([4, 5, 9, 20, 40, 64, 65, 100])) for _ in range(16)] + [["a"] * 12, ["a", "b"] * 9, ["a", "a", "a", "a", "b", "c"]]
    texts = []
    for _ in range(40):
        t = some(rng.choice([0, 3, 60, 200]))
        for v in rng.sample(items, 2):
            share = rng.choice([0.0, 0.1, 0.25, 0.35])
            t += [x for w in v for x in ([] if rng.random() < share / 3 else [word()] if rng.random() < share else [w, word()] if rng.random() < share else [w])][: rng.choice([len(v), 10**6])]
            t += some(rng.choice([0, 1, 30]))
        texts.append(t)
    want = {(d, i): smith_waterman(v, t) / (2 * len(v)) for d, t in enumerate(texts) for i, v in enumerate(items) if t}
    want = {k: s for k, s in want.items() if s >= 0.5}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    table = spark.createDataFrame([(i, " ".join(v)) for i, v in enumerate(items)], "item_id long, text string")
    for block in (20_000, 9):
        got = decontam.contaminated(docs, table, block=block).collect()
        assert {(r.doc_id, r.item_id): r.score for r in got} == want
        assert any(r.by_seed for r in got) and any(not r.by_seed for r in got)


def test_a_very_long_text(spark):
    rng = random.Random(22)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    item = [word() for _ in range(25)]
    long = [word() for _ in range(300_000)]
    long[200_000:200_000] = item
    got = decontam.contaminated(spark.createDataFrame([(1, " ".join(long))], "doc_id long, text string"), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.score, r.by_seed) for r in got] == [(1, 1, 1.0, True)]


def test_work_grows_with_places_not_with_documents_times_items():
    rng = np.random.default_rng(5)
    text_of = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 5000, n).tolist()).encode()
    items = decontam.Items([(i, text_of(30)) for i in range(3000)], 4, 0.5)
    h, at = decontam.words_of([text_of(1000) for _ in range(100)])
    found = sum(len(w) for w in decontam.Places(items, h, at).completed())
    assert found < 0.01 * 3000 * len(h) / 30  # of all windows of all items
