import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from kinelake.llm import simhash
from kinelake.llm.queries import QUERIES


def brute_print(text, words=4):
    low = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    sh = [" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))] if w else []
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, prints, distance):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = root(ids[a]), root(ids[b])
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_query_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    prints = [brute_print(r.text) for r in docs]
    want = brute_components([r.doc_id for r in docs], prints, 4)
    got = {r.doc_id: r for r in QUERIES["op10_simhash"](spark, sf).collect()}
    for r, p in zip(docs, prints):
        assert got[r.doc_id].fingerprint == f"{p:016x}"
        assert got[r.doc_id].component_id == want[r.doc_id]


def test_links_hold_for_any_plan_and_blocks(spark):
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(12)]
    prints = list({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))) for c in centres for _ in range(25)})
    want = brute_components(list(range(len(prints))), prints, 4)
    nodes = spark.createDataFrame([(i, int(np.uint64(p).astype(np.int64))) for i, p in enumerate(prints)], "node long, f0 long")
    sample = np.array(prints, np.uint64).reshape(-1, 1)
    bits = simhash.bits_of(sample)
    for parts, bucket in ((2, 20000), (3, 20000), (5, 20000), (5, 8)):
        groups = simhash.partitioned(bits, parts)
        assert sorted(x for g in groups for x in g) == list(range(64))
        _, t = simhash.allocated(bits, groups, 4, 10**6)
        assert sum(x + 1 for x in t) == 5
        plan = [(g, x) for g, x in zip(groups, t) if x >= 0]
        found = {r.node: r.component for r in simhash.components(simhash.links(nodes, 4, 1, plan, bucket)).collect()}
        assert {i: found.get(i, i) for i in want} == want


def test_nulls_empty_ties_extra_columns(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "  \n", "c"), (4, "Only Two", "d"), (5, "only two", "e"), (5, "only two", "e"), (None, "only two", "f"), (9, "word " * 30000, "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, f0 string")
    got = sorted((r.doc_id or -1, r.component_id) for r in simhash.near_duplicates(df).collect())
    assert got == [(-1, 4), (1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (5, 4), (9, 9)]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_rows_without_an_id_link_others(spark, monkeypatch):
    """Documents 1 and 2 are each within the distance of a text that only a row with a null id has."""
    prints = {"left": 0b1111, "middle": 0, "right": 0b11110000, "far": 0xFFFF << 40, "lost": 0xF0F0F0F0F0}

    def planted(docs, doc_id="doc_id", text="text", words=4, lanes=1, sets=False):
        pick = F.create_map(*[F.lit(x) for k, v in prints.items() for x in (k, v)])
        return docs.select(F.col(doc_id).alias("doc_id"), pick[F.col(text)].alias("f0"))

    monkeypatch.setattr(simhash, "fingerprints", planted)
    rows = [(1, "left"), (None, "middle"), (2, "right"), (9, "far"), (None, "far"), (None, "lost")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), distance=4).collect()
    assert sorted((str(r.doc_id), r.component_id) for r in got if r.f0 != prints["lost"]) == [("1", 1), ("2", 1), ("9", 9), ("None", 1), ("None", 9)]
    assert [r.component_id for r in got if r.f0 == prints["lost"]] == [None]
