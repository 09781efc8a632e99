import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from kinelake.llm import trie
from kinelake.llm.queries import op13_prefix_trie

SCHEMA = "conv_id long, turn int, role string, text string, id long, path string, number long, code string, w int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def tie(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def ordered(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", tie(role or "", text or ""), text or ""))
    return {c: [(x[2], x[4]) for x in sorted(t)] for c, t in convs.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + turns[h:]
    return out


def plain(convs):
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                kids[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        own = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += own
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(kids[p]), leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


def got(df):
    assert sorted(df.columns) == sorted(COLUMNS)
    return sorted(tuple(-1 if x is None else x for x in r) for r in df.select(*COLUMNS).collect())


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, "y", 3) for r in rows], SCHEMA)


def random_rows(seed, n=150):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(400), n) + [0, 20, 40]:
        for t in range(rng.choice([1, 1, 2, 3, 5, 8])):
            rows.append((c, rng.choice([t, t, t, None, 0]), rng.choice(["user", "assistant", "", None]), rng.choice(["", None, "a b", "a  b\u00a0c\n", "é", "hello there"])))
    return rows + rows[:20] + [(None, 0, "user", "lost")]


@pytest.mark.parametrize("seed", range(2))
def test_query_equals_a_plain_trie(spark, tmp_path, seed):
    rows = random_rows(seed)
    table(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    assert got(op13_prefix_trie(spark, str(tmp_path))) == plain(rebuilt(ordered(rows)))


@pytest.mark.parametrize("shards", ["1", "7", "40"])
def test_any_number_of_shards_gives_the_same_nodes(spark, shards):
    rows = random_rows(11) + [(1000 + i, t, "user", x) for i in range(60) for t, x in enumerate("abc")]  # one conversation 60 times
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        paths = trie.encoded(trie.hashed_turns(table(spark, rows)))
        assert got(trie.prefix_trie(paths)) == plain(ordered(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_turnless_conversations_end_at_the_root(spark, tmp_path):
    rows = [(c, 0, "user", "hi") for c in range(21, 40)]  # no conversation 20
    table(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    out = got(op13_prefix_trie(spark, str(tmp_path)))
    assert out == plain(rebuilt(ordered(rows))) and any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in out)


def test_very_long_conversation_and_text(spark):
    rows = [(1, t, "user", f"turn {t}") for t in range(400)] + [(2, t, "user", f"turn {t}") for t in range(300)] + [(3, 0, "user", "word " * 300_000)] * 2
    assert got(trie.prefix_trie(trie.encoded(trie.hashed_turns(table(spark, rows))))) == plain(ordered(rows))


def test_ids_are_hashed_over_many_chunks(spark, monkeypatch):
    ids = random.Random(4).sample(range(10**6), 30_000)
    ends = spark.createDataFrame([(i % 3, c) for i, c in enumerate(ids)], "number long, conv_id long")
    out = {r.number: r.ends_sha256 for r in trie.id_hashes(ends).collect()}
    assert out == {n: hashlib.sha256(",".join(map(str, sorted(ids[n::3]))).encode()).hexdigest() for n in range(3)}


def test_tree_is_balanced_and_finds_children():
    tree = trie.Tree()
    rows = [([k], [1], 1, k, k) for k in range(1023)]
    for i in trie.balanced(len(rows)):
        tree.insert(*rows[i])

    def depth(at):
        level, deepest = [at], 0
        while level:
            deepest += 1
            level = [c for x in level for c in (tree.less[x], tree.more[x]) if c]
        return deepest

    assert depth(tree.next[0]) == 10 and sorted(tree.key[c] for c in tree.children(0)) == list(range(1023))


def test_empty_table(spark, tmp_path):
    table(spark, []).write.parquet(f"{tmp_path}/conversations.parquet")
    assert got(op13_prefix_trie(spark, str(tmp_path))) == []
    assert trie.encoded(trie.hashed_turns(table(spark, []))).agg(F.count("*")).first()[0] == 0
