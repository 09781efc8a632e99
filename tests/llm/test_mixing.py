import re
from collections import defaultdict

from kinelake.llm import mixing
from kinelake.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, source string, size string"


def targets(sizes: dict, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, cut, out = share * sum(sizes.values()), {}, {}
    while True:
        free = [s for s in names if s not in cut]
        level = (total - sum(cut.values())) / max(1e-9, sum(w[s] for s in free)) if free else 0
        out = {s: cut[s] if s in cut else w[s] * level for s in names}
        over = [s for s in free if out[s] > most * sizes[s]]
        if not over:
            return out
        cut |= {s: most * sizes[s] for s in over}


def checked(rows, tolerance):
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.source_size >= r.size
    want = targets(sizes)
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 * max(1, want[s])
        assert abs(taken[s] - want[s]) <= tolerance * max(1, want[s])


def test_whole_table(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    first = mixing.mix(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    assert sorted(r.doc_id for r in first) == sorted(docs)
    for r in first:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id].text))
    checked(first, 0.05)
    again = QUERIES["op7_mix_sources"](spark, sf).collect()
    assert sorted((r.doc_id, r.taken) for r in first) == sorted((r.doc_id, r.taken) for r in again)


def test_hot_source_nulls_ties_and_slices(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE", 7)
    rows = [(i, "w " * (10 + (i % 3 == 0)), "hot", "x") for i in range(300)]
    rows += [(i, "a b c", None, "x") for i in range(1000, 1040)] + [(5, None, "b", "x"), (6, "", "b", "x"), (None, "one two", "b", None)]
    rows += [(7, "word " * 50, "c", "x"), (7, "word " * 50, "c", "x")] + [(i, "p q r s", "é", "x") for i in range(2000, 2060)]
    out = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == len(rows)
    checked(out, 0.05)


def test_kept_columns_stay_with_their_row(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE", 7)
    rows = [(i % 90, f"{'w ' * (3 + i % 2)}t{i}", "hot" if i % 4 else None, str(i)) for i in range(400)] + [(None, None, "b", None), (None, "x", "b", "extra")]
    frame = spark.createDataFrame([(*r, "z") for r in rows], SCHEMA + ", row string").repartition(5)
    out = mixing.mix(frame, keep=("text",)).collect()
    assert sorted((r.doc_id or -1, r.text or "", r.source or "") for r in out) == sorted((r[0] or -1, r[1] or "", r[2] or "") for r in rows)
    assert all(r["size"] == len((r.text or "").split()) for r in out)
    checked(out, 0.05)
    plain = mixing.mix(frame).collect()
    assert sorted((r.doc_id or -1, r["size"], r.copies) for r in out) == sorted((r.doc_id or -1, r["size"], r.copies) for r in plain)


def test_empty(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0


def test_texts_of_equal_id_source_and_size_share_copies_alike_in_every_run(spark):
    rows = [(7 if i % 2 else None, f"w{i:03d}", "s") for i in range(401)] + [(9, "a b c d e f g h", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    path = scratch_path(spark)
    docs.write.parquet(path)
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), set()
    try:
        for parts in ("1", "3", "13"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            seen.add(tuple(sorted((r.text, r.copies) for r in mixing.mix(spark.read.parquet(path), keep=("text",)).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(seen) == 1 and len(next(iter(seen))) == len(rows)


def scratch_path(spark):
    import uuid

    from kinelake.llm.common import checkpoint_dir

    return f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"
