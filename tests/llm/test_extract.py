import html
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import extract, labeller
from tidemark.llm.blocks import SIZE, Vectors, leaf_blocks

PAGES = "/root/testdata/sf0.01/pages.parquet"


def texts(page):
    return [t for _, t, _ in leaf_blocks(page)]


@pytest.mark.parametrize(
    "page, want",
    [
        ("", []),
        ("plain &amp; simple &#233;&nbsp;x", ["plain & simple é x"]),
        ("<p>one<p>two</p>three", ["one", "two", "three"]),
        ("<p>wor<b>d</b>s <a href='>'>link</a>\n\t end</p>", ["words link end"]),
        ("<script>var a = '<p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><p>yes<br>more", ["yes", "more"]),
        ("<head><title>t</title></head><body>b", ["b"]),
        ("<title>t<p>all hidden", []),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>d", ["a", "b", "c", "d"]),
        ("1 < 2 <p class=\"x>y\" id=q>3", ["1 < 2", "3"]),
        ("<div><p>open <b>bold<br><p>next</p></div><footer>f</footer>", ["open bold", "next", "f"]),
        ("<p \"unclosed>a</p>b", ["a", "b"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
    ],
)
def test_blocks(page, want):
    assert texts(page) == want


@pytest.mark.parametrize(
    "page, want",
    [
        ("<video-player src=x>one</video-player><p>two", ["one", "two"]),
        ("<audio-js>one</audio-js><object-viewer>two</object-viewer><template-part><p>three</p></template-part><TITLE-bar>four</TITLE-bar>", ["one", "two", "three", "four"]),
        ("<style-guide>one</style-guide><style>p{}</style>two", ["one", "two"]),
        ("<svg class='icon'/><p>one</p><svg viewBox='0 0 1 1' /><p>two</p><svg><text>no</text></svg>three<SVG/>", ["one", "two", "three"]),
        ("<svg title='a/>b'><path/>no</svg>one<video>no</video><video\nsrc=x>no</video >two", ["onetwo"]),
        ("<p>if <math display=block><mrow><msup><mi>x</mi><mn>2</mn></msup><mo>=</mo><mn>4</mn></mrow></math> then</p><math/><p>so", ["if x2=4 then", "so"]),
        ("<p>a <math><semantics><mi>y</mi><annotation-xml>z</annotation-xml></semantics></math> b", ["a yz b"]),
    ],
)
def test_only_hidden_elements_are_dropped(page, want):
    assert texts(page) == want


def test_custom_elements_formulas_and_icons_stay_in_the_main_text(spark):
    says = "Some words of a long article, with <math><mi>x</mi><mo>=</mo><mn>3</mn></math> inside. More words, and more."
    nav, rest = "<nav><a href=x>Home</a></nav>", "<p>Again a paragraph with words.</p>" * 3
    body = f"<svg class=icon /><article><h1>A title here</h1><p>{says}</p><video-player><p>{says}</p></video-player>{rest}</article>"
    got = extract.extract(spark.createDataFrame([(1, "u", nav + body)], "page_id bigint, url string, html string")).first()["text"]
    assert got == " ".join(["A title here", *2 * ["Some words of a long article, with x=3 inside. More words, and more."], *3 * ["Again a paragraph with words."]])


def test_paths_and_links():
    blocks = leaf_blocks('<body><div class="side-bar X9" id=menu><a href=x>abc</a> de</div><div><p>x</div>y')
    assert blocks == [(("body", "div", ".side", ".bar", ".x", ".menu"), "abc de", 3), (("body", "div", "p"), "x", 0), (("body",), "y", 0)]


def test_parsing_takes_linear_time():
    assert len(texts("<p \"" * 20_000)) <= 20_001
    assert texts("<" * 50_000)[0].startswith("<")
    assert len(leaf_blocks("<div>" * 3000 + "x")) == 1


def test_gradient():
    rng = np.random.default_rng(1)
    model = labeller.Labeller(2, hidden=3)
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    x, mask = labeller.padded([rng.standard_normal((n, SIZE)) * 0.2 for n in (4, 2, 5)])
    y = rng.random(mask.shape) < 0.5
    _, g = model.gradient(x, mask, y)
    for name in model.w:
        flat, at = model.w[name].reshape(-1), rng.integers(0, model.w[name].size)
        old, h = flat[at], 1e-2
        flat[at] = old + h
        up = model.gradient(x, mask, y)[0]
        flat[at] = old - h
        down = model.gradient(x, mask, y)[0]
        flat[at] = old
        assert np.asarray(g[name]).reshape(-1)[at] == pytest.approx((up - down) / 2 / h, rel=0.03, abs=2e-4)


def test_held_out_pages():
    model, vectors = labeller.trained(), Vectors()
    pages = labeller.made_up(300, 77_777)
    found = model.label([vectors.of(b) for b, _, _ in pages])
    wrong = sum(int((f != y).sum()) for f, (_, y, _) in zip(found, pages))
    assert wrong < 0.01 * sum(len(y) for _, y, _ in pages)


def test_label_does_not_depend_on_the_batch():
    model, vectors = labeller.trained(), Vectors()
    pages = [vectors.of(b) for b, _, _ in labeller.made_up(40, 5)] + [np.zeros((0, SIZE), np.float32)]
    alone = [model.label([p])[0] for p in pages]
    assert all((a == b).all() for a, b in zip(alone, model.label(pages, cells=200)))


def article(page):
    inner = re.search("<article>(.*?)</article>", page, re.S)[1]
    return " ".join(html.unescape(re.sub("</?(?:p|h1|br)>", " ", inner).replace("<b>", "")).split())


def test_given_pages(spark):
    pages = spark.read.parquet(PAGES)
    want = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    got = {r["page_id"]: r["text"] for r in extract.extract(pages).collect()}
    assert got.keys() == want.keys()
    assert sum(got[k] == want[k] for k in want) >= 0.99 * len(want)


def test_hard_pages(spark):
    body = "<nav><a href=x>Home</a></nav><article><h1>A title here</h1><p>Some words of a long article. More words, and more.</p>" + "<p>Again a paragraph with words.</p>" * 3 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (None, None, body), (3, "a", body), (3, "a", body), (4, "b", body * 400), (5, "c", "<nav><a href=/>Home</a></nav>")]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id bigint, url string, html string, text string, n_chars int")
    got = extract.extract(docs).collect()
    assert Counter((r["page_id"], r["url"]) for r in got) == Counter((p, u) for p, u, _ in rows)
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    by = {r["page_id"]: r["text"] for r in got}
    assert by[1] == by[2] == by[5] == "" and by[3] == by[None] and by[3].startswith("A title here Some words")
    assert by[4].count("A title here") == 400
    assert extract.extract(docs.limit(0)).collect() == []
