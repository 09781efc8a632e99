import random
from collections import defaultdict

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STAGE = dict(corpus_pipeline.STAGES)


def shingles(text, n=5):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def groups(texts):
    """Connected components of similarity 0.8 by brute force."""
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b:
                both = len(sets[a] & sets[b])
                if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    out = defaultdict(set)
    for i in ids:
        out[root(i)].add(i)
    return list(out.values())


def kept_one_of_each(texts, kept):
    wrong = [g for g in groups(texts) if len(g & kept) != 1 or min(g) not in kept]
    assert not wrong


def test_stages_over_a_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        rows = docs.collect()
        if name != "mixture":
            assert docs.columns == COLUMNS
        now = {r.doc_id: r.text for r in rows}
        assert set(now) <= set(texts)
        if name == "mixture":
            assert all(now[i] == texts[i] for i in now)
        if name == "quality":
            assert sum(labels[i] == 1 for i in now if i in labels) >= 0.97 * sum(labels.values())
            assert not any(labels.get(i) == 0 for i in now)
        if name == "near_duplicates":
            kept_one_of_each(texts, set(now))
        if name == "repeats":
            first = {}
            for i in sorted(texts):
                t = texts[i].encode()
                if all(first.setdefault(t[k : k + 200], i) == i for k in range(len(t) - 199)):
                    assert now[i] == texts[i]  # nothing in it occurred before
            assert set(now) == set(texts)
        texts = now
    assert rows and all(r.copies in (1, 2) and r.taken == r.copies * r["size"] for r in rows)
    again = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r.doc_id, r.copies) for r in again) == sorted((r.doc_id, r.copies) for r in rows)


def test_near_copies_of_every_kind(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    texts, n = {}, 0
    for base in range(12):
        w = [word() for _ in range(rng.choice([80, 300, 900]))]
        for edits in (0, 0, 0.005, 0.01, 0.015, 0.06):
            texts[n] = " ".join(word() if rng.random() < edits else x for x in w)
            n += 1
    rows = [(i, t, "en", "s", len(t)) for i, t in texts.items()]
    kept = {r.doc_id for r in STAGE["near_duplicates"](spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    kept_one_of_each(texts, kept)


def test_nulls_repeated_ids_and_empty_tables(spark):
    sf = "/root/testdata/sf0.001"
    text = "one two three four five six seven eight nine ten " * 3
    rows = [(None, text, None, None, None), (7, text, "en", "s", 1), (7, text + " more words here to differ", "en", "s", 1), (8, None, "en", "s", None), (9, "", None, "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0, name
        assert stage(spark, docs, sf).count() <= len(rows), name
    kept = STAGE["near_duplicates"](spark, docs, sf).collect()
    assert sum(r.doc_id is None for r in kept) == 0 and any(r.doc_id == 7 for r in kept)
    assert sorted(r.doc_id or 0 for r in STAGE["repeats"](spark, docs, sf).collect()) == [0, 7, 7, 8, 9]


def test_contaminated_documents_go_even_without_an_id(spark, sf):
    item = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(None, f"before {item} after", "en", "s", 1), (1, item, "en", "s", 1), (2, "clean words only in this one here", "en", "s", 1), (None, "also clean words without any id", "en", "s", 1)]
    kept = STAGE["decontamination"](spark, spark.createDataFrame(rows, SCHEMA), sf).collect()
    assert sorted(r.text for r in kept) == ["also clean words without any id", "clean words only in this one here"]


def kept_exactly(spark, texts):
    rows = [(i, t, "en", "s", len(t)) for i, t in texts.items()]
    kept = {r.doc_id for r in STAGE["near_duplicates"](spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    assert kept == {min(g) for g in groups(texts)}


def new_word(rng):
    return "".join(rng.choices("abcdefghij", k=6))


def test_a_text_similar_only_to_the_last_of_many_close_copies(spark):
    rng, texts = random.Random(11), {}
    for base in range(25):
        w = [new_word(rng) for _ in range(300)]
        for k in range(12):  # one word after the other changes: close neighbours, the last one is far from the first
            w[12 + 20 * k] = new_word(rng)
            texts[len(texts)] = " ".join(w)
        for p in range(5):  # a similarity of 0.84 to the last copy, below 0.8 to all but the last ones
            w[292 - 8 * p] = new_word(rng)
        texts[len(texts)] = " ".join(w)
    kept_exactly(spark, texts)


def test_every_pair_just_above_the_similarity(spark):
    rng, texts = random.Random(12), {}
    for base in range(150):
        w = [new_word(rng) for _ in range(204)]
        texts[len(texts)] = " ".join(w)
        for p in range(4):  # 200 shingles each, 180 in common: 0.82
            w[20 + 40 * p] = new_word(rng)
        texts[len(texts)] = " ".join(w)
        for p in range(5 if base % 2 else 3):
            w[35 + 20 * p] = new_word(rng)
        texts[len(texts)] = " ".join(w)
    kept_exactly(spark, texts)


def test_texts_of_one_repeated_line_are_not_copies(spark):
    rng = random.Random(13)
    line = " ".join(new_word(rng) for _ in range(13))
    texts = {i: " ".join([*[line] * 80, *(new_word(rng) for _ in range(100))]) for i in range(10)}
    kept_exactly(spark, texts)


def test_a_large_group_of_edited_copies(spark, monkeypatch):
    """Copies of one text with few to many edits: some join, others are just too far; in blocks too."""
    from kinelake.llm import setjoin

    rng = random.Random(21)
    base = [new_word(rng) for _ in range(150)]
    texts = {}
    for i in range(400):
        share = rng.choice([0.0, 0.005, 0.01, 0.02, 0.03, 0.06])
        texts[i] = " ".join(new_word(rng) if rng.random() < share else w for w in base)
    kept_exactly(spark, texts)
    rows = spark.createDataFrame(list(texts.items()), "id long, text string")
    links = spark.createDataFrame([], "a long, b long")
    found = {r.node: r.component for r in setjoin.similar_components(rows, links, 5, 0.8, bucket=40).collect()}
    want = {i: min(g) for g in groups(texts) for i in g}
    assert {i: found.get(i, i) for i in texts} == want


@pytest.mark.parametrize("ordered", [True, False])
def test_long_unrelated_texts_that_share_a_passage_are_not_handed_on(spark, ordered):
    """With the passage known as frequent they don't meet; without any order they meet, and their bitmaps part them."""
    import numpy as np

    from kinelake.llm import setjoin
    from kinelake.llm.common import Scratch

    rng = random.Random(31)
    passage = [new_word(rng) for _ in range(80)]
    texts = []
    for i in range(400):
        w = [new_word(rng) for _ in range(rng.randrange(2700, 3100))]
        w[40 * (i % 50) : 40 * (i % 50)] = passage
        texts.append((i, " ".join(w)))
    df = spark.createDataFrame(texts, "id long, text string").repartition(8)
    weights = setjoin.bucket_weights(setjoin.described(df, 5).where("block is not null").select("block", "counts"))
    if not ordered:
        weights = np.zeros_like(weights)
    shared, maps = setjoin.shared_prefixes(df, 5, 0.8, weights, None, Scratch(spark))
    rows = shared.withColumn("c", shared.id).join(maps, "id")
    assert rows.count() < 20 if ordered else rows.count() > 400
    assert setjoin.meetings(rows, ["h"], 0.8, None).count() < 0.01 * 400 * 399 / 2


def test_bitmaps_bound_the_difference_at_every_pair_of_lengths():
    import numpy as np

    from kinelake.llm import setjoin

    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)) for n in (1, 5, 400, 500, 530, 1000, 1100, 5000)]
    sets += [np.unique(np.concatenate([s[: len(s) * 9 // 10], rng.integers(0, 2**64, len(s) // 8 + 1, dtype=np.uint64)])) for s in sets]
    sketches = setjoin.Sketches(np.array([len(s) for s in sets]), [setjoin.bitmap(s).tobytes() for s in sets])
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    apart = sketches.apart(i, j)
    for a, b, n in zip(i, j, apart):
        assert n <= len(np.setxor1d(sets[a], sets[b]))
        if a != b and len(np.intersect1d(sets[a], sets[b])) == 0 and min(len(sets[a]), len(sets[b])) >= 0.8 * max(len(sets[a]), len(sets[b])):
            assert n > (len(sets[a]) + len(sets[b])) / 9


def test_weights_count_all_texts(spark):
    import numpy as np

    from kinelake.llm import setjoin

    df = spark.createDataFrame([(i, f"a b c d e {i}" if i % 2 else None) for i in range(1000)], "id long, text string").repartition(5)
    weights = setjoin.bucket_weights(setjoin.described(df, 5).where("block is not null").select("block", "counts"))
    hot = setjoin.shingle_set(b"a b c d e", 5)[0]
    assert weights[int(hot >> np.uint64(64 - setjoin.ORDER_BITS))] == int(8 * np.log2(501)) and (weights > 0).sum() == 501


def test_stages_with_columns_of_clashing_names_and_a_very_long_text(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(40)
    long = spark.createDataFrame([(10_000, "word after word of a long text " * 40_000, "en", "s", 1)], SCHEMA)
    docs = docs.unionByName(long)
    extra = docs.selectExpr("*", *(f"doc_id AS {c}" for c in ("row", "key", "o", "component_id", "id", "h", "size", "bits", "score", "kept", "original", "copies", "held")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        a, b = stage(spark, docs, sf), stage(spark, extra, sf)
        assert a.columns == b.columns == COLUMNS, name
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())), name
    a, b = (sorted((r.doc_id, r.taken) for r in STAGE["mixture"](spark, x, sf).collect()) for x in (docs, extra))
    assert a == b
