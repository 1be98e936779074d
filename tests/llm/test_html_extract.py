"""Block parsing by hand, gradients by differences, accuracy on held-out pages, edges."""

import numpy as np
import pytest

from heliopanel.llm import html_extract as H
from heliopanel.llm.common import table
from heliopanel.llm.html_blocks import blocks

SF = "/root/testdata/sf0.01"


def texts(page):
    return [b.text for b in blocks(page)]


def test_blocks():
    assert texts("<p>a &amp; b&nbsp;&copy;<br>c <b>d</b>e<p>f</p>g") == ["a & b © c de", "f", "g"]
    assert texts('<script>var t="</p>";</script><!-- x <p> --><style>p{}</style><div title="a>b">t</div>') == ["t"]
    assert texts("a < b and c<d> e") == ["a < b and c", "e"]
    assert texts("<p>open <i>x") == ["open x"] and texts("<p>cut &am") == ["cut &am"] and texts("<script>never closed <p>x") == []
    assert texts("<!-- open <p>x") == [] and texts('<p class="broken>x</p><p>y</p>') in ([], ["y"], ["x", "y"])
    assert texts("") == [] and texts(" \n ") == [] and texts("plain  text") == ["plain text"]
    page = blocks('<body><nav><ul><li><a href=x>one</a><li>two</ul></nav><div class="Post main-text" id=k><p>p1<p>p2<h2>h</h2></div></body>')
    assert [b.path for b in page[:2]] == [("body", "nav", "ul", "li")] * 2 and page[0].linked == 3 and page[1].linked == 0
    assert page[2].path == page[3].path == ("body", "div", ".post", ".main", ".text", ".k", "p")
    assert page[4].path[-1] == "h2" and "p" not in page[4].path
    rows = blocks("<table><tr><td>a<td>b<p>c<tr><td>d</table>")
    assert [b.text for b in rows] == ["a", "b", "c", "d"] and rows[3].path == ("table", "tr", "td")


def test_long_broken_markup_is_linear():
    for page in ("<" * 200_000, "<a " * 100_000, '<p title="' * 50_000, "<!--" * 100_000, "&" * 200_000, "<p>" * 50_000 + "x"):
        blocks(page)


def test_gradients():
    net = H.Labeller.new(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    r = np.random.default_rng(1)
    pages = [r.normal(size=(n, H.PATH_DIM + H.WORD_DIM + H.RATIOS)) for n in (3, 5, 1)]
    x, there = H.padded(pages)
    x = x.astype(np.float64)
    y = r.random(there.shape) < 0.5
    _, g = net.gradients(x, there, y)
    for name in net.p:
        flat = net.p[name].reshape(-1)
        for i in r.integers(0, len(flat), 4):
            keep = flat[i]
            flat[i] = keep + 1e-3
            up = net.gradients(x, there, y)[0]
            flat[i] = keep - 1e-3
            down = net.gradients(x, there, y)[0]
            flat[i] = keep
            assert abs((up - down) / 2e-3 - g[name].reshape(-1)[i]) < 2e-3, name


@pytest.fixture(scope="module")
def net(spark):
    return H.fit(table(spark, SF, "pages"), 60)


def test_held_out_pages(spark, net):
    rows = table(spark, SF, "pages")
    html = {r["page_id"]: r["html"] for r in rows.collect()}
    got = H.extract(rows, net).collect()
    assert len(got) == len(html)
    for g in got:
        found = blocks(html[g["page_id"]])
        want = "\n".join(b.text for b, y in zip(found, H.standard_labels(found)) if y)
        assert g["text"] == want and g["n_chars"] == len(want)


def test_unseen_templates(net):
    body = ["The old harbour was rebuilt in three years, said the mayor.", "Boats returned in spring, and with them the market.",
            "Nobody had expected so many visitors on the first day of the season."]
    paragraphs = "".join(f"<p>{t}</p>" for t in body)
    page = (f'<html><body><div class="cookie-notice"><p>We use cookies to improve this site.</p></div><nav><a href="/">Home</a></nav>'
            f'<div class="article-body"><h1>Harbour</h1>{paragraphs}</div>'
            f'<aside class="sidebar"><h3>Popular</h3><p>Ten things to see</p></aside>'
            f'<section class="comments"><h3>Comments</h3><div class="comment"><p>I was there and it was great fun.</p></div></section>'
            f'<form><label>Subscribe</label><button>Go</button></form><footer><p>Copyright</p></footer></body></html>')
    got = H.main_texts(net, [page])[0].split("\n")
    assert set(body) <= set(got) and len(set(got) - set(body) - {"Harbour"}) <= 1


def test_padding_and_batches_do_not_matter(net):
    r = np.random.default_rng(4)
    pages = [r.normal(size=(n, H.PATH_DIM + H.WORD_DIM + H.RATIOS)).astype(np.float32) for n in (0, 9, 1, 700, 3)]
    together = net.probabilities(pages)
    for p, q in zip(pages, together):
        assert len(p) == len(q) and np.allclose(net.probabilities([p])[0], q, atol=1e-4)


def test_edges(spark, net):
    long = "<article>" + "<p>word and more words here.</p>" * 30_000 + "</article>"
    rows = [(1, "u", None, "z"), (2, None, "", "z"), (3, "u", "no markup", "z"), (None, "u", "<p>x</p>", "z"), (4, "u", long, "z"), (4, "u", long, "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = H.extract(df, net).collect()
    assert len(got) == 6 and all(g["n_chars"] == len(g["text"]) for g in got)
    by = {g["page_id"]: g for g in got}
    assert by[1]["text"] == by[2]["text"] == "" and by[4]["text"].count("word") > 29_000
    assert H.extract(df.limit(0)).count() == 0 and H.extract(df.where("page_id = 1")).first()["text"] == ""
