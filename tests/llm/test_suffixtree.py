import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinelake.llm import suffixtree
from kinelake.llm.queries import QUERIES


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), t or ""))


def test_base_against_brute_force_and_gain(spark, sf):
    docs = {r.doc_id: words(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    apart = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    c = Counter(w for i, ws in docs.items() if not apart[i] for w in ws)
    ends = sum(not a for a in apart.values())
    n, v = sum(c.values()) + ends, len(c) + 1
    got = {r.doc_id: r for r in QUERIES["op8_suffix_tree"](spark, sf).collect()}
    assert got.keys() == docs.keys()
    for i, ws in docs.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (apart[i], len(ws) + 1, n)
        assert r.n_known == sum(w in c for w in ws) + 1
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws) + math.log10((ends + 1) / (n + v + 1))
        assert abs(base - r.base_score) < 1e-6 * abs(base)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("tier", [4, 1 << 17])
def test_probabilities_sum_to_one_and_match_a_plain_tree(spark, tier):
    rng = np.random.default_rng(5)
    names = [f"w{k}" for k in range(12)]
    texts = []
    for _ in range(80):
        t, k = [], 0
        for _ in range(rng.integers(0, 40)):
            k = (k + 1) % 12 if rng.random() < 0.7 else int(rng.integers(0, 12))
            t.append(names[k])
        texts.append(" ".join(t))
    train = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    # every one-word continuation of one history, and an unknown word: scores of "h x" minus the end are p(x | h)
    probe = [(1000 + k, f"w3 w4 {w}") for k, w in enumerate([*names, "never"])]
    both = train.union(spark.createDataFrame(probe, "doc_id long, text string"))
    seq = [["^", "^", *t.split(), "$"] for t in texts]
    c1 = Counter(w for s in seq for w in s[2:])
    n, v = sum(c1.values()), len(c1)
    args = dict(depth=2, times=max(2, math.ceil(0.01 * n)), tier=tier, weight=3.0, deep=False)
    got = {r.doc_id: r for r in suffixtree.scored(both, F.col("doc_id") < 1000, **args).collect()}
    keep = [w for w in names if c1[w] >= max(2, 0.01 * n)] if tier > 12 else None
    if keep is not None:
        p0 = {w: (c1[w] + 1) / (n + v + 1) for w in [*keep, "$"]}
        p0["*"] = 1 - sum(p0.values())
        sym = lambda w: w if w in keep or w in "^$" else "*"
        trees = [Counter(), Counter()]
        for s in seq:
            s = list(map(sym, s))
            for i in range(2, len(s)):
                trees[0][(s[i - 1],), s[i]] += 1
                trees[1][(s[i - 2], s[i - 1]), s[i]] += 1
        total = [Counter(), Counter()]
        for t, m in zip(trees, total):
            for (h, _), k in t.items():
                m[h] += k
        kept: set = set()

        def p(h, x, among):
            while h and h not in among:
                h = h[1:]
            if not h:
                return p0[x]
            k = len(h) - 1
            return (trees[k][h, x] + 3.0 * p(h[1:], x, among)) / (total[k][h] + 3.0)

        often = [{h for h, m in t.items() if m >= max(2, 0.01 * n)} for t in total]
        often[1] = {h for h in often[1] if trees[0].get(((h[0],), h[1]), 0) >= max(2, 0.01 * n)}
        every = often[0] | often[1]
        for k in (1, 0):
            for h in often[k]:
                seen = [(x, m) for (g, x), m in trees[k].items() if g == h]
                gain = sum(m * math.log(m / total[k][h] / p(h[1:], x, every)) for x, m in seen)
                if gain > len(seen) or any(g[1:] == h for g in kept):
                    kept.add(h)
        assert kept
        for i, t in list(enumerate(texts))[:40]:
            s = list(map(sym, seq[i]))
            want = sum(math.log10(p((s[j - 2], s[j - 1]), s[j], kept) * ((c1[seq[i][j]] + 1) / (n + v + 1) / p0[s[j]])) for j in range(2, len(s)))
            assert abs(got[i].score - want) < 1e-6


def test_longer_contexts_predict_unseen_texts_better(spark):
    rng = np.random.default_rng(8)
    follow = {}

    def text():  # the next word is settled by the three before it, most of the time
        t = ["a", "b", "c"]
        for _ in range(rng.integers(30, 60)):
            k = tuple(t[-3:])
            t.append(follow.setdefault(k, str(rng.choice(list("abcdefgh")))) if rng.random() < 0.9 else str(rng.choice(list("abcdefgh"))))
        return " ".join(t)

    docs = spark.createDataFrame([(i, text()) for i in range(300)], "doc_id long, text string")
    totals = {}
    for name, args in {"deep": {"deep": False}, "two": {"depth": 2, "deep": False}, "few": {"contexts": 20}, "whole": {}}.items():
        held = suffixtree.scored(docs, F.col("doc_id") < 250, **args).where("not learns")
        totals[name], base = held.agg(F.sum("score"), F.sum("base_score")).first()
    assert totals["deep"] > 0.8 * totals["two"] and totals["two"] > base and totals["few"] > base
    assert totals["whole"] >= totals["deep"] - 1e-6 * abs(totals["deep"])


@pytest.mark.parametrize("depth", [0, 1, 2])
def test_distributed_contexts_match_a_plain_tree(spark, depth):
    """Contexts up to ``depth`` are the tree's, those up to three words beyond it the distributed ones."""
    rng = np.random.default_rng(11)
    names = [f"w{k}" for k in range(9)]
    texts = []
    for _ in range(90):
        t, k = [], 0
        for _ in range(rng.integers(0, 30)):
            k = (2 * k + len(t) % 2 + 1) % 9 if rng.random() < 0.6 else int(rng.integers(0, 9))
            t.append(names[k])
        texts.append(" ".join(t))
    texts += [f"{texts[3]} never w1 w2 seen w1 w2 w4", "never", texts[5] + " " + texts[6]]  # not learned
    train, weight = 90, 3.0
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in suffixtree.scored(df, F.col("doc_id") < train, depth=depth, weight=weight).collect()}
    seq = [["^"] * 3 + t.split() + ["$"] for t in texts]
    c1 = Counter(w for s in seq[:train] for w in s[3:])
    n, v = sum(c1.values()), len(c1)
    trees = [Counter() for _ in range(3)]
    for s in seq[:train]:
        for i in range(3, len(s)):
            for k in (1, 2, 3):
                trees[k - 1][tuple(s[i - k : i]), s[i]] += 1
    total = [Counter() for _ in range(3)]
    for t, m in zip(trees, total):
        for (h, _), k in t.items():
            m[h] += k

    def p(h, x, among):
        while h and h not in among:
            h = h[1:]
        if not h:
            return (c1[x] + 1) / (n + v + 1)
        k = len(h) - 1
        return (trees[k][h, x] + weight * p(h[1:], x, among)) / (total[k][h] + weight)

    def passes(h, among):
        seen = [(x, m) for (g, x), m in trees[len(h) - 1].items() if g == h]
        return sum(m * math.log(m / total[len(h) - 1][h] / p(h[1:], x, among)) for x, m in seen) > len(seen)

    tree = [{h for h, m in total[k].items() if m >= 2} for k in range(depth)]
    if depth == 2:  # extensions of a context by a word that follows it twice or more
        tree[1] = {h for h in tree[1] if trees[0][(h[0],), h[1]] >= 2}
    kept: set = set()
    for k in reversed(range(depth)):
        kept |= {h for h in tree[k] if passes(h, set().union(*tree)) or any(g[1:] == h for g in kept)}
    for k in range(max(1, depth), 3):
        # the tree holds contexts at the start of a text, the distributed part words only
        kept |= {h for h, m in total[k].items() if m >= 2 and "^" not in h and passes(h, kept)}
    assert {len(h) for h in kept} == {1, 2, 3} - ({1} if depth == 0 else set())
    for i, s in enumerate(seq):
        want = sum(math.log10(p(tuple(s[j - 3 : j]), s[j], kept)) for j in range(3, len(s)))
        assert abs(got[i].score - want) < 1e-5 * max(1, len(s)), (i, got[i].score, want)


def test_nulls_and_nothing_learned(spark):
    rows = [(1, None, 5), (2, "", 5), (3, "A a  a", 5), (3, "A a  a", 5), (None, "b " * 50000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int")
    none = suffixtree.scored(df, F.lit(False)).collect()
    assert sorted(r.n_tokens for r in none) == [1, 1, 4, 4, 50001]
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score == 0 and r.base_score == 0 for r in none)
    some = suffixtree.scored(df, F.col("doc_id") == 3).collect()
    assert [r.train_tokens for r in some] == [8] * 5
    assert suffixtree.scored(df.limit(0), F.lit(True)).count() == 0


def test_sorted_codes_pack_as_differences():
    rng = np.random.default_rng(2)
    one, two = (rng.zipf(1.3, 50_000).astype(np.uint64) % np.uint64(1 << 17) for _ in range(2))  # frequent words and rare ones
    codes = np.sort(one * np.uint64((1 << 17) + 2) + two)
    plain, steps = (len(suffixtree.packed([x])) for x in (codes, suffixtree.steps(codes)))
    assert steps < 0.8 * plain
    for some in (codes, codes[:1], codes[:0]):
        (back,) = suffixtree.unpacked(suffixtree.packed([suffixtree.steps(some)]), len(some), ["<u8"])
        assert np.array_equal(np.cumsum(back), some)


@pytest.mark.parametrize("tier", [3, 1 << 17])
def test_contexts_of_any_words_up_to_the_depth_match_a_plain_tree(spark, tier):
    """Contexts of four words, of words outside the tier and of the start of a text; every next word counts on its own."""
    rng = np.random.default_rng(12)
    names = [f"w{k}" for k in range(7)]
    texts = []
    for _ in range(80):
        t = [f"open{rng.integers(0, 4)}"]
        while rng.random() < 0.94:
            k = (len("".join(t[-3:])) + sum(map(ord, "".join(t[-4:])))) % 7 if rng.random() < 0.7 else int(rng.integers(0, 7))
            t.append(f"rare{rng.integers(0, 9)}" if rng.random() < 0.15 else names[k])
        texts.append(" ".join(t))
    texts += ["open1 once w1 w2 w3 only", "open1 once w1 w2 w3 other"]
    train, weight, depth = len(texts), 3.0, 4
    texts += [f"{texts[3]} never w1 w2 rare1 w4", "never", texts[5] + " " + texts[6], "open1 once w1 w2 w3 only", "w5 never rare2"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in suffixtree.scored(df, F.col("doc_id") < train, symbols=0, tier=tier, depth=depth, weight=weight).collect()}
    seq = [["^"] * depth + t.split() + ["$"] for t in texts]
    c1 = Counter(w for s in seq[:train] for w in s[depth:])
    n, v = sum(c1.values()), len(c1)
    base = lambda x: (c1[x] + 1) / (n + v + 1)
    # the broadcast part has no words: what follows any word, and the start of a text, is a word or the end
    top = {h: Counter() for h in "*^"}
    trees = [Counter() for _ in range(depth)]
    for s in seq[:train]:
        for i in range(depth, len(s)):
            top["^" if s[i - 1] == "^" else "*"]["$" if s[i] == "$" else "*"] += 1
            for k in range(1, depth + 1):
                if "^" not in s[i - k + 1 : i]:
                    trees[k - 1][tuple(s[i - k : i]), s[i]] += 1
    follow: dict = {}
    for t in trees:
        for (h, x), m in t.items():
            follow.setdefault(h, {})[x] = m
    total = {h: sum(f.values()) for h, f in follow.items()}
    states: set = set()

    def class_p(h, x, among):
        p0, m = base("$") if x == "$" else 1 - base("$"), sum(top[h].values())
        return (top[h]["$" if x == "$" else "*"] + weight * p0) / (m + weight) if h in among else p0

    kept_top = {h for h, f in top.items() if sum(f.values()) >= 2 and sum(m * math.log(m / sum(f.values()) / class_p(h, x, ())) for x, m in f.items()) > len(f)}

    def p(h, x):
        g = next((h[-k:] for k in range(len(h), 0, -1) if h[-k:] in states), None)
        return (follow[g].get(x, 0) + weight * before(g, x)) / (total[g] + weight) if g else root(h[-1], x)

    def root(last, x):
        return class_p("^" if last == "^" else "*", x, kept_top) * (1 if x == "$" else base(x) / (1 - base("$")))

    def before(h, x):  # by the shorter states
        return p(h[1:], x) if len(h) > 1 else root(h[0], x)

    for k in range(1, depth + 1):
        for h in [h for h in follow if len(h) == k and h != ("^",) and total[h] >= 2]:
            if sum(m * math.log(m / total[h] / before(h, x)) for x, m in follow[h].items()) > len(follow[h]):
                states.add(h)
    assert {len(h) for h in states} == {1, 2, 3, 4} and any(h[0] == "^" for h in states) and any("rare" in "".join(h) for h in states if len(h) > 1)
    for i, s in enumerate(seq):
        want = sum(math.log10(p(tuple(s[j - depth : j]), s[j])) for j in range(depth, len(s)))
        assert abs(got[i].score - want) < 1e-5 * len(s), (i, got[i].score, want)
