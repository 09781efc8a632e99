import numpy as np
from pyspark.sql import functions as F

from kinelake.llm import langid
from kinelake.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op5_language"](spark, sf).join(docs, "doc_id").where("held_out").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_network_gradient_and_windows():
    x, of = langid.windows(["a" * 600, "", "É"])
    assert x.shape == (5, langid.WINDOW) and of.tolist() == [0, 0, 0, 1, 2]
    assert bytes(x[2][:88]) == b"a" * 88 and bytes(x[4][:2]) == "é".encode()
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 300)
    lines = np.where(y[:, None] == 1, *(np.frombuffer(b.ljust(langid.WINDOW), np.uint8) for b in (b"the and of", b"der und von")))
    net = langid.fitted(lines, y, ["x", "y"], epochs=3)
    assert (net.probabilities(lines).argmax(1) == y).mean() == 1


def test_gradient_and_forward_pass_against_plain_loops():
    rng = np.random.default_rng(3)
    f, wide = langid.FILTERS * len(langid.WIDTHS), max(langid.WIDTHS) * langid.EMBED
    mask = np.zeros((wide, f))
    for k, w in enumerate(langid.WIDTHS):
        mask[: w * langid.EMBED, k * langid.FILTERS : (k + 1) * langid.FILTERS] = 1
    p = {"embed": rng.normal(0, 0.5, (256, langid.EMBED)), "filters": rng.normal(0, 0.3, mask.shape) * mask, "bias": rng.normal(0, 0.1, f), "dense": rng.normal(0, 0.3, (f, 3)), "dense_bias": rng.normal(0, 0.1, 3)}
    x, y = rng.integers(97, 123, (4, langid.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 1])

    def loss(p):
        total = 0.0
        for row, label in zip(x, y):
            h = np.zeros(f)
            for k in range(f):
                places = [sum(p["embed"][row[i + j]] @ p["filters"][j * langid.EMBED : (j + 1) * langid.EMBED, k] for j in range(max(langid.WIDTHS))) for i in range(langid.WINDOW - max(langid.WIDTHS) + 1)]
                h[k] = max(0.0, max(places) + p["bias"][k])
            z = h @ p["dense"] + p["dense_bias"]
            total -= z[label] - np.log(np.exp(z).sum())
        return total / len(x)

    net = langid.Network(["a", "b", "c"], **p)
    want = -np.log(net.probabilities(x)[np.arange(4), y]).mean()
    assert abs(loss(p) - want) < 1e-9
    grad = langid.gradient(net, x, y, mask)
    for name, at in (("embed", (int(x[0, 0]), 2)), ("embed", (int(x[1, 7]), 0)), ("filters", (3, 5)), ("filters", (7, 30)), ("bias", (4,)), ("dense", (9, 1)), ("dense_bias", (2,))):
        moved = {k: v.copy() for k, v in p.items()}
        moved[name][at] += 1e-6
        assert abs((loss(moved) - want) / 1e-6 - grad[name][at]) < 1e-4, name


def test_texts_that_open_alike_are_told_by_their_bodies(spark):
    rng = np.random.default_rng(5)
    opening = "common header words everywhere " * 100
    body = {"xx": "kalo mira tusi pane", "yy": "schro eindt wurtz zwelk"}
    rows = [(i, opening + " ".join(rng.choice(body[k].split(), 900)), k, "extra", 0.1) for i, k in enumerate(["xx", "yy"] * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score double")
    got = langid.identified(docs, langid.learned(docs, F.col("doc_id") < 40)).collect()
    assert all(r.lang_pred == ["xx", "yy"][r.doc_id % 2] for r in got)


def test_nulls_and_no_letters(spark):
    rows = [(1, None, "de"), (2, "123 !?", "de"), (3, "der die das und", "de"), (3, "der die das und", "de"), (4, "the and of this " * 9000, "en"), (None, "the of", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = langid.learned(docs, F.lit(True))
    got = langid.identified(docs, net).collect()
    assert [r.lang_pred == "und" for r in got] == [True, True, False, False, False, False]
    assert all(r.lang_pred in ("de", "en", "und") for r in got)
    assert langid.learned(docs.where("lang is null"), F.lit(True)) is None
    assert {r.lang_pred for r in langid.identified(docs, None).collect()} == {"und"}
    assert langid.identified(docs.limit(0), net).count() == 0


def test_numerals_are_no_letters():
    from kinelake.llm.langid import has_letter

    assert not any(map(has_letter, ("", "½ ²", "Ⅷ", "१२ ٣", "12_3 ---", "①㊿", "\u0301")))
    assert all(map(has_letter, ("a", "½é", "Ⅷ 中", "_ж_", "1ª")))
