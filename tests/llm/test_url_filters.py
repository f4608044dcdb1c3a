import random
import re

import numpy as np
import pyarrow as pa
import pytest

from rollcall.llm import url_filters as uf
from rollcall.llm.catalogue import ORACLES, QUERIES
from rollcall.llm.texts import bytes_of

SF_DIR = "/root/testdata/sf0.001"
SITES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
ODD = [
    None,
    "",
    "no scheme",
    "://",
    "http://",
    "http://ORG/",
    "http://Example.ORG/es/",
    "https://a.b.example.org/es",
    "http://badexample.org/es/1",
    "http://example.org/en/1",
    "http://example.org/en/12?x=/es/",
    "http://example.org?/es/",
    "http://example.org#/es/",
    "http://x.com/de/",
    "http://x.com/fr/a.zip",
    "http://com/de/",
    "http://com.evil.net/de/x.org/",
    "http://é.org/ÄÖ",
    "http://casino-é.net/a\nb/login/x",
    "x://y://z.org/",
    "http://free-software.net/cart/",
    "http://" + "a." * 5000 + "org/" + "x" * 200_000,
]


def site_rule(url):
    """Host, path and rule by the words of the contract."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for rule in SITES:
        at = rule.index("/")
        if (host == rule[:at] or host.endswith("." + rule[:at])) and path.startswith(rule[at:]):
            fits.append(rule)
    return host, path, max(fits, key=len, default=None)


def fitting(globs, texts):
    return uf.Automaton(globs).run(*bytes_of(pa.array(texts, pa.string())))


def test_globs_fit_as_their_regular_expressions():
    rng = random.Random(4)
    globs = ["".join(rng.choice(["a", "b", "/", "?", "*", "**", "é", "\\?", "."]) for _ in range(rng.randrange(9))) for _ in range(300)]
    texts = ["".join(rng.choice("aab/?é.𐍈") for _ in range(rng.randrange(12))) for _ in range(400)]
    expected = np.array([[re.match(uf.regex_of(g), t) is not None for g in globs] for t in texts])
    assert (fitting(globs, texts) == expected).all()
    assert expected.any() and len(uf.Automaton(globs).begin[0]) > 4


def test_rules_that_cross_words_and_no_rows():
    globs = ["a" * n + "*" for n in (10, 60, 64, 130)]
    assert fitting(globs, ["a" * 64, "a" * 200, "", "a" * 9]).tolist() == [
        [True, True, True, False],
        [True] * 4,
        [False] * 4,
        [False] * 4,
    ]
    assert fitting(globs, []).shape == (0, 4)
    assert fitting([], ["a"]).shape == (1, 0)


def pages(spark, urls):
    rows = [(i, u, "x", "y") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id BIGINT, url STRING, host STRING, canonical STRING")


def test_odd_urls_against_the_words_of_the_rules(spark):
    got = {r.page_id: r for r in uf.filter_urls(pages(spark, ODD)).collect()}
    assert len(got) == len(ODD)
    for i, url in enumerate(ODD):
        host, path, rule = site_rule(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), url
        if rule is not None:
            assert got[i].verdict == SITES[rule]
    verdicts = {ODD[i]: r.verdict for i, r in got.items()}
    assert verdicts["http://casino-é.net/a\nb/login/x"] == "block"
    assert verdicts["http://free-software.net/cart/"] == "allow"
    assert verdicts[None] == verdicts[""] == "allow"


def test_query_matches_the_words_of_the_rules_and_sql(spark, con):
    rows = QUERIES["op12_url_filters"](spark, SF_DIR).collect()
    urls = dict(con.execute("SELECT page_id, url FROM pages").fetchall())
    assert len(rows) == len(urls)
    for r in rows:
        assert (r.host, r.path, r.rule) == site_rule(urls[r.page_id])
    assert {r.verdict for r in rows if r.rule is None} == {"allow", "block"}
    sql = con.execute(f"SELECT page_id, host, path, rule, pattern, verdict FROM ({ORACLES['op12_url_filters']})").fetchall()
    assert sorted(map(tuple, rows)) == sorted(sql)


def test_kept_rows_are_whole_whatever_their_columns(spark):
    urls = [None, "http://a.org/", "http://a.org/", "http://a.com/de/1", "http://ads-1.net"]
    kept = uf.keep_allowed(pages(spark, urls))
    assert kept.columns == ["page_id", "url", "host", "canonical"]
    assert sorted(r.page_id for r in kept.collect()) == [0, 1, 2]
    assert uf.keep_allowed(pages(spark, urls), [], "block").count() == 0
    assert uf.filter_urls(pages(spark, [])).collect() == []


@pytest.mark.parametrize("first", ["allow", "block"])
def test_blocks_go_before_allows_of_one_length(spark, first):
    other = {"allow": "block", "block": "allow"}[first]
    rules = [uf.Rule(first, "**a**"), uf.Rule(other, "**b**")]
    got = uf.filter_urls(pages(spark, ["http://ab/", "http://a/"]), rules).collect()
    assert [r.verdict for r in got] == ["block", first]
