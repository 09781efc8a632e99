import re
from collections import Counter
from math import isclose, log

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinelake.llm import urlfilter
from kinelake.llm.queries import URL_RULES, op11_url_filter

SCHEMA = "page_id long, url string, html string, row long, host string, path string, n int, piece string, bad boolean, score string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, "h", "p", 2, "q", True, "s") for i, (u, h) in enumerate(rows)], SCHEMA)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule_of(host, path, rules):
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


def rules_table(spark, rules=URL_RULES):
    return spark.createDataFrame(rules, "host string, path string, verdict string")


URLS = [
    None, "", "no scheme/a", "http://", "://x", "http://org", "http://org/", "http://Example.ORG/es/1?x", "https://a.example.org/en/12#t", "https://a.example.org/en/2",
    "https://notexample.org/es/", "https://b.com/fr/", "https://b.com/FR/", "ftp://com/de/x", "https://b.com.net/de/", "http://u@a.org:80/x", "http://a.org:80/de", "x://y://z.com/fr/", "http://É.org/é?ö",
    "http://a.com?/fr/", "http://a.com#/fr/", "http://a.com/fr", "http://a..com/de/", "http://.com/fr/a\nb", "https://example.org/en/1", "https://example.org/en/", "http://example.org/es",
]


def test_hosts_paths_and_rules_equal_plain_loops(spark):
    rules = [*URL_RULES, ("a.example.org", "/", "block"), ("example.org", "/en/12", "allow"), ("", "/only", "block")]
    out = urlfilter.judged(pages(spark, [(u, "<p>a</p>") for u in URLS] * 2), rules_table(spark, rules)).collect()
    assert len(out) == 2 * len(URLS)
    for r in out:
        host, path = parts((URLS * 2)[r.page_id])
        rule, verdict = rule_of(host, path, rules)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.score > 0 else "allow"))


def test_any_number_of_rules(spark):
    rules = [(f"h{i}.net", f"/{'x' * (i % 7)}{i}", "block" if i % 2 else "allow") for i in range(3000)]
    urls = [f"http://sub.h{i}.net/{'x' * (i % 7)}{i}/{'y' * (i % 3)}" for i in range(0, 3000, 97)] + ["http://h5.net/other"]
    for r in urlfilter.judged(pages(spark, [(u, None) for u in urls]), rules_table(spark, rules)).collect():
        assert (r.rule, r.verdict if r.rule else None) == rule_of(r.host, r.path, rules)


def every_split(word):
    if not word:
        yield []
    for k in range(1, min(len(word), urlfilter.LONGEST) + 1):
        for rest in every_split(word[k:]):
            yield [word[:k], *rest]


def test_splits_are_the_likeliest(spark):
    counts = {"free": 50, "bet": 30, "bets": 20, "sand": 9, "s": 4, "and": 90, "more": 11, "mo": 3, "e": 60, "fr": 2, "é": 5, "tée": 1}
    total = sum(counts.values())
    cost = lambda words: sum(log(total) - log(counts[w]) if w in counts else log(total) + log(10) * (len(w) - 1) for w in words)
    names = ["freebetsandmore", "betsand", "xyz", "freexbets", "étée", "s", "mmore", "freefreefree"]
    got = {r.piece: r.words for r in urlfilter.segmented(spark.createDataFrame([(n,) for n in names], "piece string"), spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert set(got) == set(names) and got["freebetsandmore"] == ["free", "bets", "and", "more"]
    for n in names:
        assert "".join(got[n]) == n and isclose(cost(got[n]), min(cost(s) for s in every_split(n)), abs_tol=1e-9)


def test_pieces_of_very_long_urls(spark):
    long = "http://" + "a" * 1000 + ".net/" + "b" * 100_000
    out = urlfilter.judged(pages(spark, [(long, "a b " * 100_000), ("http://x.net/b", "")]), rules_table(spark)).collect()
    assert {len(r.host) for r in out} == {1004, 5} and {r.verdict for r in out} == {"allow"}
    got = spark.range(1).select(urlfilter.pieces(F.lit("Ab12-" + "c" * 600)).alias("p")).first().p
    assert [len(x) for x in got] == [2, 1, 255, 255, 90] and got[:2] == ["ab", "0"]


def test_odds_equal_plain_naive_bayes(spark):
    html = "<script>var free='x'</script><p>free bets free farm</p><!-- no --> good news &amp; bets good"
    urls = ["http://freebets.com/a/free", "http://goodnews.com/a", "http://good.com/a/free/9", "http://goodfarm.com/b7", "http://free-farm.com/b"] + ["http://good.com/"] * 3
    rows = [(u, html if i == 0 else None) for i, u in enumerate(urls)]
    out = {r.page_id: r.score for r in urlfilter.judged(pages(spark, rows), rules_table(spark), seeds=("free", "com-no")).collect()}
    words = Counter("free bets free farm good news bets good".split()) + Counter(["free", "com-no"])
    total = sum(words.values())
    cost = lambda ws: sum(log(total) - log(words[w]) if w in words else log(total) + log(10) * (len(w) - 1) for w in ws)
    split = lambda p: min(every_split(p), key=lambda s: (round(cost(s), 9), -len(s[-1])))
    pieces = lambda text: ["0" if x[0].isdigit() else x for x in re.findall(r"[a-z]+|\d+", text)]
    each = [[(kind, w) for kind, text in zip(("host", "path"), parts(u)) for p in pieces(text) for w in split(p)] for u in urls]
    bad = [any(kind == "host" and w == "free" for kind, w in e) for e in each]
    count = {b: Counter(x for e, is_bad in zip(each, bad) if is_bad == b for x in e) for b in (True, False)}
    v = len(set(count[True]) | set(count[False]))
    size = {b: sum(count[b].values()) + v + 1 for b in count}
    share = lambda x: (count[True][x] + count[False][x] + 1) / (size[True] + size[False] - v - 1)
    for i, e in enumerate(each):
        score = log((sum(bad) + 1) / (len(bad) - sum(bad) + 1)) + sum(log((count[True][x] + v * share(x)) / size[True]) - log((count[False][x] + v * share(x)) / size[False]) for x in e)
        assert isclose(out[i], score, abs_tol=1e-9)


@pytest.mark.parametrize("scale", ["sf0.01"])
def test_spam_hosts_go_and_others_stay(spark, scale):
    out = op11_url_filter(spark, f"/root/testdata/{scale}").toPandas()
    free = out[out.rule.isna()]
    spam = free.host.str.contains("spam|casino|pills|bets")
    assert spam.sum() >= 5 and (free[spam].verdict == "block").mean() == 1 and (free[~spam].verdict == "allow").mean() == 1
    assert np.isfinite(out.score).all()


def test_rare_words_are_no_sign_of_the_smaller_class(spark):
    urls = [f"http://shop{i}.net/{'abcdefgh'[i % 8]}{'ijklmnop'[i // 8 % 8]}{'qrstuvwx'[i // 64]}" for i in range(300)] + ["http://free-pills.net/buy", "http://pills-now.net/buy", "http://free-stuff.net/x"]
    out = urlfilter.judged(pages(spark, [(u, "free stuff now buy shop pills") for u in urls]), rules_table(spark, [])).collect()
    blocked = {r.host for r in out if r.verdict == "block"}
    assert blocked == {"free-pills.net", "pills-now.net"}


def test_empty_table_and_null_texts(spark):
    assert urlfilter.judged(pages(spark, []), rules_table(spark)).collect() == []
    assert [r.verdict for r in urlfilter.judged(pages(spark, [(None, None)]), rules_table(spark, [])).collect()] == ["allow"]
