"""Main text: given pages against their article element, hand-made layouts, the field against enumeration."""

import html
import itertools
import re

import numpy as np
import pytest

from runtally.llm import html_extract, queries

PAGES = "page_id long, url string, html string"


def article_text(page):
    """What the article of a given page says, by its tags alone."""
    inner = re.search(r"<article>(.*?)</article>", page or "", re.S)
    parts = re.split(r"</?(?:p|h1)>", inner.group(1)) if inner else []
    texts = [re.sub(r"[\x20\x09-\x0d]+", " ", html.unescape(re.sub(r"</?b>", "", p).replace("<br>", " "))).strip(" ") for p in parts]
    return "\n".join(t for t in texts if t)


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return html_extract.train(queries.table(spark, sf_dir, "pages"))


def test_given_pages_against_their_article(spark, sf_dir):
    pages = queries.table(spark, sf_dir, "pages").select("page_id", "url", "html").collect()
    want = sorted((p.page_id, p.url, article_text(p.html), len(article_text(p.html))) for p in pages)
    assert sorted(map(tuple, queries.QUERIES["op11_html_main_text"](spark, sf_dir).collect())) == want


LONG = "The quick brown fox jumps over the lazy dog, and then it rests for a while under the old tree by the river."
NOTE = "We use cookies to make this site work."


@pytest.mark.parametrize("page", [
    f"<body><header><a href=/>Home</a> <p>Daily paper</p></header><nav><a href=a>One</a><a href=b>Two</a></nav><main><h1>Title here</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></main><aside class=sidebar><h3>Related</h3><ul><li><a href=x>Other story</a></li></ul></aside><footer>© 2020 Paper</footer>",
    f'<body><div id="cookie-notice">{NOTE}</div><div class="page"><div class="article-content"><h1>Title here</h1><p>{LONG}</p><div class="ad">Buy now at our store!</div><p>Short.</p><p>{LONG}</p></div><div class="sidebar"><p>Most read this week</p></div></div><div class="footer"><p>All rights reserved.</p></div>',
    f'<article><h1>Title here</h1><p>{LONG}</p><form action=s><label>Mail</label><input><button>Send</button></form><p>Short.</p><p>{LONG}</p></article><section id="comments"><h2>Comments</h2><div class="comment"><p>{LONG}</p></div><div class="comment"><p>I agree, thanks.</p></div></section>',
    f'<article><h1>Title here</h1><p>{LONG}<p>Short.<p>{LONG}<aside class="ad"><p>Buy now at our store, it is cheap, today.</p></aside></article><ol class="commentlist"><li><p>{LONG}</p></li></ol><script>var a = "<p>no</p>";</script><!-- <p>no</p> --><style>p {{ }}</style>',
    f'<div class="banner">{NOTE}</div><div class="wrapper"><div class="post"><h1>Title here</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div></div><div class="newsletter"><form><p>Sign up for our letter</p><input></form></div>',
])
def test_layouts_that_the_table_does_not_hold(model, page):
    assert html_extract.main_text(page, model) == f"Title here\n{LONG}\nShort.\n{LONG}"


def test_held_out_layouts(spark, sf_dir, model):
    """Fitted on the pages with the smallest hash, tested on the texts of all others in layouts of their own."""
    wrong = total = 0
    for p in queries.table(spark, "/root/testdata/sf0.01", "pages").collect():
        for page, labels in html_extract.labelled(p.html)[1:]:
            wrong += sum(a != b for a, b in zip(html_extract.decode(page, model), labels))
            total += len(labels)
    assert total > 5000 and wrong / total < 0.03


def test_odd_pages(spark, model):
    deep = "<div>" * 30_000 + "deep" + "</div>" * 30_000
    rows = [(1, None, None), (2, "u", ""), (3, "u", "  \n "), (3, "u", "  \n "), (None, "v", "<p>a &amp; b&amp c&#233;&nbsp;d<br>e\t\n f</p>"),
            (5, "w", "<article><p>x < y and y > z</p><p>half <b"), (6, "w", "<article><!-- never ends <p>z</p>"), (7, "w", deep),
            (8, "w", "<article>" + "<p>one more line of the page, as it is.</p>" * 30_000 + "</article>"), (9, "w", "</p></div></article>" * 1000),
            (10, "w", "<article><script>x</article>"), (11, "w", "<table><tr><td><p>a</table>" * 2000), (12, "w", '<p class="unclosed>text')]
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS text", "2 AS n_chars", "3 AS labels", "4 AS feats", "5 AS chosen")
    got = {(r.page_id, r.url): r for r in html_extract.extract(df, model).collect()}
    assert len(got) == len(rows) - 1 and all(r.n_chars == len(r.text) for r in got.values())
    assert got[1, None].text == got[2, "u"].text == got[3, "u"].text == got[9, "w"].text == got[6, "w"].text == ""
    assert got[5, "w"].text == "x < y and y > z\nhalf" and got[8, "w"].text.count("\n") == 29_999
    alone = {(r.page_id, r.url): r.text for r in html_extract.extract(df, None).collect()}
    assert alone[None, "v"] == "a & b& cé d e f" and alone[7, "w"] == "deep"
    assert html_extract.extract(df.limit(0), model).count() == 0
    assert html_extract.train(df.limit(0)) is None and html_extract.train(df.filter("html IS NULL")) is None


def test_viterbi_against_all_labellings():
    rng = np.random.default_rng(4)
    for _ in range(40):
        n = int(rng.integers(1, 8))
        feats = [[f"f{k}" for k in rng.integers(0, 6, 3)] for _ in range(n)]
        page = html_extract.Page(["x"] * n, feats, [-1] * n, [], [], [])
        model = html_extract.Model({"": 0.3} | {f"f{k}": float(rng.normal()) for k in range(6)}, rng.normal(size=2), rng.normal(size=(2, 2)))

        def score(ys):
            on = sum(model.weights[""] + sum(model.weights[f] for f in feats[k]) for k in range(n) if ys[k])
            return model.start[ys[0]] + on + sum(model.step[a, b] for a, b in zip(ys, ys[1:]))

        best = max(itertools.product((0, 1), repeat=n), key=score)
        assert tuple(html_extract.decode(page, model)) == best


def test_fit_matches_expected_counts():
    """At the optimum the field expects as many main blocks and label changes as the pages show."""
    rng = np.random.default_rng(8)
    pages = []
    for _ in range(60):
        n = int(rng.integers(2, 9))
        ys = [int(rng.random() < 0.6)]
        while len(ys) < n:
            ys.append(ys[-1] if rng.random() < 0.8 else 1 - ys[-1])
        pages.append(([["a"] if rng.random() < 0.3 + 0.4 * y else ["b"] for y in ys], ys))
    m = html_extract.fit(pages)
    expected, seen = np.zeros(2), np.zeros(2)
    for feats, ys in pages:
        n, z = len(ys), 0.0
        on = [m.weights[""] + m.weights[f[0]] for f in feats]
        sums = np.zeros(2)
        for lab in itertools.product((0, 1), repeat=n):
            w = np.exp(m.start[lab[0]] + sum(o for o, y in zip(on, lab) if y) + sum(m.step[a, b] for a, b in zip(lab, lab[1:])))
            z += w
            sums += w * np.array([sum(lab), sum(a != b for a, b in zip(lab, lab[1:]))])
        expected += sums / z
        seen += [sum(ys), sum(a != b for a, b in zip(ys, ys[1:]))]
    assert np.abs(expected / seen - 1).max() < 0.02
