import html
import re

import numpy as np
import pytest
from conftest_llm import prose

from rollcall.llm import html_extraction as H
from rollcall.llm.catalogue import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "page_id BIGINT, url STRING, html STRING"


def article_of(source):
    """The text of pages of the test tables, by patterns that fit only them."""
    found = re.search(r"<article>(.*?)(</article>|\Z)", source, re.DOTALL)
    inner = re.sub(r"</?b>", "", re.sub(r"<br>", " ", found[1] if found else ""))
    blocks = (re.sub(r"\s+", " ", html.unescape(x)).strip() for x in re.split(r"<[^>]*>|<[^>]*\Z", inner))
    return "\n".join(b for b in blocks if b)


def test_query_gives_the_articles(spark, con):
    rows = QUERIES["op4_html_extraction"](spark, SF_DIR).collect()
    pages = con.execute("SELECT page_id, url, html FROM pages").fetchall()
    assert {(r.page_id, r.url, r.text, r.n_chars) for r in rows} == {
        (i, u, article_of(s), len(article_of(s))) for i, u, s in pages
    }


@pytest.fixture(scope="module")
def model(spark):
    from rollcall.llm.texts import ship_code

    ship_code(spark)
    return H.train(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def page(body):
    links = "".join(f'<li><a href="/{i}">{prose(2, i)}</a></li>' for i in range(6))
    return (
        f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>a='</p>'</script></head><body>"
        f"<nav><ul>{links}</ul></nav>{body}<footer>&copy; 2024 {prose(4, 9)}</footer></body></html>"
    )


def paragraphs(*seeds):
    return [f"{prose(40, s)}." for s in seeds]


def test_menus_adverts_comments_and_forms_inside_an_article_go(model):
    a, b = paragraphs(1, 2)
    body = (
        f'<article><h1>Head &amp; line</h1><p>{a}<div class="ad">buy {prose(9, 3)}</div><p><b>{b}'
        f"<form><p>{prose(9, 4)}<button>go</button></form><script>x</script>"
        f'<div class="comments"><p>{prose(15, 5)}</p></div></article>'
    )
    assert H.extract(page(body), model) == f"Head & line\n{a}\n{b}"


def test_white_space_references_and_blocks(model):
    a, b = paragraphs(6, 7)
    body = f"<article><p>  {a}\n\t &nbsp; x&lt;y &#233; <i>i</i>n<b>ner</b></p>\n<p>{b}<br>next</p></article>"
    assert H.extract(page(body), model) == f"{a} x<y é inner\n{b} next"


def test_pages_without_an_article_element(model):
    a, b, c = paragraphs(10, 11, 12)
    body = f"<div><p>{a}</p><p>{b}</p><p>{c}</p></div>"
    assert H.extract(page(body), model) == f"{a}\n{b}\n{c}"


def test_decoding_contradicts_no_ancestor():
    tree = H.Page("<div><p>a</p><section><p>b</p></section></div>")
    scores = np.array([0.0, 1.0, 2.0, -5.0, 3.0])
    assert decoded(tree, scores) == [0, 1, 2]  # the good paragraph goes with its bad section
    assert decoded(tree, np.array([0.0, 1.0, 2.0, -2.0, 3.0])) == [0, 1, 2, 3, 4]
    assert decoded(tree, np.array([0.0, -9.0, 2.0, 1.0, 3.0])) == [0]


def decoded(tree, scores):
    return np.flatnonzero(H.decode(tree, scores)).tolist()


@pytest.mark.parametrize(
    "source",
    ["", "plain", "<", "<p", "a < b > c", "<!-- never closed", "</p></div>", "<p>&am", "<script>x", "<a href='>'>t",
     "<ul><li>a<li>b</ul>", "<div " * 3000, "<p>" * 3000, "<div>" * 3000 + "x", "<p>" + "y " * 300_000],
)
def test_broken_pages_do_not_fail(model, source):
    H.extract(source, model)


def test_every_text_is_in_some_block():
    source = "a<p>b<i>c</i><div>d</div>e<hr>f<ul><li>g<li>h</ul><select><option>no</select>"
    tree = H.Page(source)
    assert [tree.block(i) for i in range(len(tree.runs))] == ["a", "bc", "d", "e", "f", "g", "h"]


def test_nulls_repeats_and_empty_tables(spark):
    a = paragraphs(1)[0]
    source = page(f"<article><p>{a}</p><p>{a} x</p></article>")
    rows = [(1, "u", source), (1, "u", source), (None, None, source), (2, "v", None), (3, "w", "")]
    got = H.extract_pages(spark.createDataFrame([(*r, "t") for r in rows], SCHEMA + ", text STRING")).collect()
    text = f"{a}\n{a} x"
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(i, u, text if s else "", len(text) if s else 0) for i, u, s in rows], key=repr
    )
    assert H.extract_pages(spark.createDataFrame([], SCHEMA)).collect() == []
    none = H.extract_pages(spark.createDataFrame([(1, "u", "<p>no article named</p>")], SCHEMA)).collect()
    assert [(r.text, r.n_chars) for r in none] == [("", 0)]


def test_trees_separate_what_features_separate():
    rng = np.random.default_rng(2)
    x = rng.random((2000, 5))
    y = ((x[:, 1] > 0.6) ^ (x[:, 3] > 0.5)).astype(float)
    model = H.Boosted(x[:1500], y[:1500])
    assert ((model.score(x[1500:]) > 0) == y[1500:]).mean() > 0.95


def test_letters_that_lower_case_lengthens():
    turkish = "\u0130stanbul " * 300
    tree = H.Page(f"<p>{turkish}</p><script>a='<p>'</SCRIPT><p>b</p><p>c</p><style>x</\u017ftyle></style><p>d")
    assert [tree.block(i) for i in range(len(tree.runs))] == [turkish.strip(), "b", "c", "d"]


def bare(n, body):
    links = "".join(f'<td><a href="/{i}">{prose(2, n + i)}</a></td>' for i in range(6))
    return f"<html><body><table><tr>{links}</tr></table>{body}<div><a href='/'>{prose(5, n)}</a></div></body></html>"


def test_few_pages_name_their_article(spark):
    a, b = paragraphs(1, 2)
    one = page(f"<article><h1>Head</h1><p>{a}</p><p>{b}</p></article>")
    others = [(n, "u", bare(n, f"<div><p>{prose(3, n)}</p></div>")) for n in range(300)]
    in_script = [(n, "u", page(f"<script>'<article>'</script><p>{n}</p>")) for n in range(300, 400)]
    rows = [(999, "u", one), *others, *in_script]
    got = H.extract_pages(spark.createDataFrame(rows, SCHEMA).repartition(2), sample=5).where("page_id = 999").first()
    assert got.text == f"Head\n{a}\n{b}"


def test_no_page_names_its_article(spark):
    rows = [
        (n, "u", bare(7 * n, f"<table><tr><td><h2>{prose(3, n)}</h2><p>{prose(40, 900 + n)}.</p><p>{prose(40, 950 + n)}.</p></td></tr></table>"))
        for n in range(40)
    ]
    got = H.extract_pages(spark.createDataFrame(rows, SCHEMA)).collect()
    for r in got:
        n = r.page_id
        assert r.text == f"{prose(3, n)}\n{prose(40, 900 + n)}.\n{prose(40, 950 + n)}."


def test_an_apostrophe_in_an_attribute_without_quotes_opens_nothing(model):
    a, b = paragraphs(21, 22)
    body = f"<article><h1>Head</h1><p title=it's class='x'>{a}</p><p data-x='a>b' title = \"c>d\" y=5\">{b} don't</p></article>"
    assert H.extract(page(body), model) == f"Head\n{a}\n{b} don't"
    # A quote that does not close ends with its tag.
    body = f"<article><h1>Head</h1><p title='open>{a}</p><p>{b}</p></article>"
    assert H.extract(page(body), model) == f"Head\n{a}\n{b}"
