"""Main text of pages (operator 11): held-out pages of the grammar, template pages, markup cases."""

from __future__ import annotations

import html
import re

import pytest

from playlake.llm import boosting, dom, extraction, page_grammar, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return extraction.fit()


def text_of(page, model):
    return extraction.main_texts([page], model)[0]


def by_template(page):
    """The article of the given pages by their one template, without any tree."""
    body = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    body = re.sub(r"</?b>", "", re.sub(r"<br>", " ", re.sub(r"</?(p|h1)>", "\n", body)))
    assert "<" not in body
    lines = [" ".join(html.unescape(x).split()) for x in body.split("\n")]
    return "\n".join(x for x in lines if x)


def test_every_page_of_the_table(spark):
    got = queries.op11_extract(spark, SF).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == by_template(pages[r["page_id"]]) and r["n_chars"] == len(r["text"])


def test_held_out_pages_of_the_grammar(model):
    same = missed = extra = chars = 0
    for page in page_grammar.pages(200, 4711):
        tree = dom.parse(page)
        want, got = dom.blocks(tree, extraction.marked(tree)[0]), text_of(page, model)
        same += want == got
        a, b = set(want.split("\n")), set(got.split("\n"))
        missed, extra, chars = missed + sum(map(len, a - b)), extra + sum(map(len, b - a)), chars + len(want)
    assert same >= 170 and missed < 0.02 * chars and extra < 0.01 * chars


def test_choices_never_contradict(model):
    for page in page_grammar.pages(60, 99):
        tree = dom.parse(page)
        chosen = extraction.decoded(tree, model.logit(dom.features(tree)))
        assert all(chosen[p] for p, c in zip(tree.parent[1:], chosen[1:]) if c)


def test_long_comment_sections_stay_out(model):
    comments = "".join(f'<div class="comment"><p>A reader says that point {i} is wrong, and why.</p></div>' for i in range(200))
    page = f'<body><article><h1>Title</h1><p>First words of the story.</p><p>More of it.</p></article><section id="comments"><h3>Replies</h3>{comments}</section></body>'
    assert text_of(page, model) == "Title\nFirst words of the story.\nMore of it."


ARTICLE = "<article><h1>T</h1>{}<p>Some more text stands here, as it does.</p></article>"
TAIL = "\nSome more text stands here, as it does."


@pytest.mark.parametrize(
    ("inner", "want"),
    [
        ("<p>a\n\t b&nbsp;&amp;&#x41;&lt;i&gt; c</p>", "T\na b &A<i> c"),
        ("<p>one<br>two<p><b>three<br><p>four", "T\none two\nthree\nfour"),
        ("<p>1 < 2 and a<!-- x > y -->b</p>", "T\n1 < 2 and ab"),
        ("<p>x<script>var t='</p>';</script>y</p><style>p{}</style>", "T\nxy"),
        ("<p>a <a href='/x' title='<p>'>link</a> b</i></p>", "T\na link b"),
        ("<P>upper</P></div></p><p>&notareference; &amp &am</p>", "T\nupper\n¬areference; & &am"),
    ],
)
def test_markup(model, inner, want):
    assert text_of(ARTICLE.format(inner), model) == want + TAIL


@pytest.mark.parametrize("page", ["", " ", "<", "<p", "<!-- open", "</p></p>", "<script>x", "<div><div>", "<a b='c", "<nav><ul><li><a href=x>y</a></li></ul></nav>"])
def test_pages_without_text(model, page):
    assert text_of(page, model) in ("", "<")


def test_rows_nulls_repeats_and_other_columns(spark, model):
    page = ARTICLE.format("<p>words of a paragraph.</p>")
    rows = [(1, page, 1), (1, page, 1), (2, None, 1), (3, "", 1), (None, page, 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, html string, text int")
    got = sorted(map(str, (tuple(r) for r in extraction.extract(pages, model, ["page_id"]).collect())))
    want = f"T\nwords of a paragraph.{TAIL}"
    assert got == sorted(map(str, [(1, want), (1, want), (2, ""), (3, ""), (None, want)]))
    assert extraction.extract(pages.limit(0), model, ["page_id"]).collect() == []
    with pytest.raises(ValueError):
        extraction.extract(pages, model, ["text"])


def test_very_long_and_deep_pages(model):
    long = ARTICLE.format("".join(f"<p>Paragraph {i} has some words, and an end.</p>" for i in range(20_000)))
    assert text_of(long, model).count("\n") == 20_001
    deep = "<div>" * 3_000 + ARTICLE.format("") + "<p><b>" * 3_000
    assert "Some more text" in text_of(deep, model)


def test_trees_fit_a_known_rule():
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] < -0.5)).astype(float)
    trees = boosting.fit(x[:1000], y[:1000], trees=30)
    assert ((trees.logit(x[1000:]) > 0) == (y[1000:] > 0)).mean() > 0.95
