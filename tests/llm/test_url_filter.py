import math
import re

import pytest
from pyspark.sql import functions as F

from basketry.llm.queries import URL_RULES
from basketry.llm.url_filter import GRAMS, PLACES, Rules, features, fit, judge_urls, labelled_urls, learn, margins
from basketry.llm.url_labels import ALLOW, BLOCK
from tests.llm import helpers as H

URLS = [
    None, "", "no scheme/org/", "http://", "http:///en/1", "http://example.org", "http://example.org/", "https://A.EXAMPLE.Org/es/9",
    "https://a.example.org/es", "http://example.org/en/1", "http://example.org/en/2", "http://example.org/en/12#x", "http://b.c.example.org/en/1?q",
    "http://notexample.org/es/1", "http://xcom/fr/1", "http://com/fr/1", "http://a.com/fr/", "http://a.com/fr", "http://a.com/de/7?x=/fr/",
    "http://a.com/en/", "http://a.com?b/fr/", "http://a.org#/es/", "x://y://example.org/es/", "ftp://é.example.net/ü/1", "http://a.com:80/fr/",
    "http://casino-win.example.net/en/5", "http://m.tionble.example.net/en/5", "http://a.net/" + "long/" * 30000, "http://" + "a." * 5000 + "org/x",
    "http://a.net/x\ny?z", "http://.org/", "http://org/", "http://www.EXAMPLE.org/ES/1",
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k % 29 if k % 11 else None, u, "h", "host", "path", 1.0, "r", "v") for k, u in enumerate(URLS + URLS[5:9])]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, path string, score double, rule string, verdict string").repartition(3)


def parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return ("", "") if m is None else (m[1].translate(H.LOWER), m[2])


def rule(host, path):
    fits = [r for r, _ in URL_RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
    return max(fits, key=len, default=None)


def test_hosts_paths_and_rules(pages):
    got = judge_urls(pages, URL_RULES).collect()
    want = []
    for r in pages.collect():
        h, p = parts(r.url)
        want.append((r.page_id, h, p, rule(h, p)))
    H.same([tuple(r)[:4] for r in got], want)
    assert {r.rule for r in got} == {None, *[r for r, _ in URL_RULES]}
    for r in got:
        assert 0 <= r.score <= 1
        assert r.verdict == (dict(URL_RULES)[r.rule] if r.rule else "block" if r.score >= 0.5 else "allow")
    assert judge_urls(pages.limit(0), URL_RULES).count() == 0


def test_scores_are_those_of_the_model(spark, pages):
    weights, _ = learn(labelled_urls(spark))
    got = {(r.host, r.path): r.score for r in judge_urls(pages, ()).collect()}
    for (h, p), score in got.items():
        assert score == pytest.approx(1 / (1 + math.exp(-margins(weights, [h], [p])[0])), rel=1e-9)
    assert got["casino-win.example.net", "/en/5"] > 0.5 > got["m.tionble.example.net", "/en/5"]


def test_features_are_counts_of_marked_grams_of_length_one():
    row, place, value = features(["aab", ""], ["/é", ""])
    for k, (host, path) in enumerate([("aab", "/é"), ("", "")]):
        counts = {}
        for part, text in (("h", host), ("p", path)):
            marked = f"\x02{text}\x03"
            for n in GRAMS:
                for i in range(len(marked) - n + 1):
                    counts[part, marked[i:i + n]] = counts.get((part, marked[i:i + n]), 0) + 1
        norm = math.sqrt(sum(c * c for c in counts.values()))
        mine = sorted(v for r, p, v in zip(row, place, value) if r == k and p < 2 * PLACES)
        assert mine == pytest.approx(sorted(c / norm for c in counts.values()))


def test_fit_stands_at_the_minimum():
    import numpy as np

    from basketry.llm.url_filter import RIDGE

    hp = [parts(u) for u in BLOCK + ALLOW]
    hosts, paths, y = [h for h, _ in hp], [p for _, p in hp], np.array([1.0] * len(BLOCK) + [0.0] * len(ALLOW))
    w = fit(hosts, paths, y)
    p = 1 / (1 + np.exp(-margins(w, hosts, paths)))
    row, place, value = features(hosts, paths)
    gradient = np.bincount(place, weights=value * (p - y)[row], minlength=len(w)) / len(y) + RIDGE * np.append(w[:-1], 0)
    assert np.abs(gradient).max() < 1e-5
    assert ((p >= 0.5) == y).all()


def test_held_out_urls():
    import numpy as np

    hp = [parts(u) for u in BLOCK + ALLOW]
    y = np.array([1.0] * len(BLOCK) + [0.0] * len(ALLOW))
    right = 0
    for fold in range(5):
        test = np.arange(len(y)) % 5 == fold
        w = fit([hp[i][0] for i in np.flatnonzero(~test)], [hp[i][1] for i in np.flatnonzero(~test)], y[~test])
        m = margins(w, [hp[i][0] for i in np.flatnonzero(test)], [hp[i][1] for i in np.flatnonzero(test)])
        right += ((m >= 0) == y[test]).sum()
    assert right >= 0.85 * len(y)


def test_odd_labelled_tables(spark, pages):
    table = spark.createDataFrame([("http://a.net/", 1), (None, 0), ("http://b.net/", None), ("http://c.net/", 2)], "url string, label int")
    assert {r.score for r in judge_urls(pages, (), table).collect()} == {1.0}
    assert {r.score for r in judge_urls(pages, (), table.limit(0)).collect()} == {0.0}
    one = spark.createDataFrame([("http://bad.net/", 1), ("http://bad.net/", 1), ("http://good.net/", 0)], "url string, label int")
    got = {r.host: r.score for r in judge_urls(spark.createDataFrame([(1, "http://bad.net/"), (2, "http://good.net/")], "page_id int, url string"), (), one).collect()}
    assert got["bad.net"] > 0.5 > got["good.net"]


def test_rules_of_equal_length_and_deep_hosts():
    rules = Rules([("b.c/x", "allow"), ("c/xyz", "block"), ("C/", "block")])
    assert rules.find(rules.hosts("a.b.c"), "/xyz") == ("b.c/x", "allow")
    assert rules.find(rules.hosts("c"), "/xy") == ("C/", "block")
    assert rules.find(rules.hosts("bc"), "/xyz") == (None, None)
    assert Rules([]).hosts("a.b") == []


def test_every_page_of_the_table_has_one_row(spark):
    from conftest import SF_SMALL

    from basketry.llm.queries import op11_url_filter

    got = op11_url_filter(spark, SF_SMALL)
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    assert got.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted(r.page_id for r in got.collect()) == sorted(r.page_id for r in pages.select("page_id").collect())
    assert got.where(F.col("verdict").isNull()).count() == 0
