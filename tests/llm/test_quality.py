import numpy as np
from pyspark.sql import functions as F

from kinelake.llm import quality
from kinelake.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op4_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    good, bad = got.score[got.quality == 1].to_numpy(), got.score[got.quality == 0].to_numpy()
    assert (good[:, None] > bad).mean() > 0.97
    assert (got.predicted == got.quality).mean() > 0.95
    assert ((got.score >= 0.3) == (got.predicted == 1)).all()


def test_pairwise_term_is_the_double_sum():
    rng = np.random.default_rng(1)
    m = quality.fitted(quality.features([b"a b c", b"D!! E!!"], np.zeros(2)), np.array([1, 0], np.float32))
    b = quality.features([b"a b c d e 12 !", b"", b"x " * 50], np.zeros(3))
    margin, value, _ = m.margin(b)
    for r in range(3):
        i, x = b.index[b.at[r] : b.at[r + 1]], value[b.at[r] : b.at[r + 1]]
        pair = sum(float(m.factor[i[p]] @ m.factor[i[q]]) * x[p] * x[q] for p in range(len(i)) for q in range(p))
        assert abs(m.bias + m.weight[i] @ x + pair - margin[r]) < 1e-3
    assert rng is not None


def test_gradient_against_differences():
    texts, label = [b"a b c 1", b"D!! E!! a", b"a a a"], np.array([1, 0, 1], np.float32)
    b = quality.features(texts, np.array([3.0, 9.0, -1.0]))
    m = quality.fitted(b, label, epochs=2)
    m = m._replace(weight=m.weight.astype(np.float64), factor=m.factor.astype(np.float64))

    def loss(m):
        z = m.margin(b)[0].astype(np.float64)
        return float(np.mean(np.log1p(np.exp(-z)) * label + np.log1p(np.exp(z)) * (1 - label)))

    db, touched, dw, dv = quality.gradient(m, b, label)
    assert abs((loss(m._replace(bias=m.bias + 1e-4)) - loss(m)) / 1e-4 - db) < 1e-3
    for k in (0, 2, len(touched) - 9, len(touched) - 5):
        weight, factor = m.weight.copy(), m.factor.copy()
        weight[touched[k]] += 1e-4
        factor[touched[k], 3] += 1e-4
        assert abs((loss(m._replace(weight=weight)) - loss(m)) / 1e-4 - dw[k]) < 1e-3
        assert abs((loss(m._replace(factor=factor)) - loss(m)) / 1e-4 - dv[k, 3]) < 1e-3


def test_learned_model_separates_unseen_texts_of_its_kinds(spark):
    rng = np.random.default_rng(2)
    kind = {1: "the quiet river runs under old stone bridges".split(), 0: "buy now!!! $$$ click here WIN 100 %%".split()}
    rows = [(i, " ".join(rng.choice(kind[i % 2], 40)), None) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    got = quality.scored(docs, quality.learned(docs.union(docs), labels, F.col("doc_id") < 60, sample=50)).collect()
    assert all((r.score > 0.5) == (r.doc_id % 2 == 1) for r in got)


def test_nulls_empty_and_no_labels(spark):
    docs = spark.createDataFrame([(1, None, None, 0.5), (2, "", 0, 0.5), (2, "", 0, 0.5), (None, "word " * 40000, 7, 0.5)], "doc_id long, text string, n_chars int, score double")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    none = quality.learned(docs, labels, F.lit(True))
    assert [r.score for r in quality.scored(docs, none).collect()] == [0.5] * 4
    some = quality.learned(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int"), F.lit(True))
    got = quality.scored(docs, some, keep=("text",)).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got) and sum(r.text is None for r in got) == 1
    assert quality.scored(docs.limit(0), some).count() == 0


def test_sample_of_little_more_than_half(spark):
    from kinelake.llm.common import hash_sample

    ids = spark.range(2050)  # twice the sample, and less than a hundred more
    assert hash_sample(ids, ["id"], 1000).count() == 1000
