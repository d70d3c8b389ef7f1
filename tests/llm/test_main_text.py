import random

import numpy as np
import pytest

from pressloom.llm import main_text

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><!-- ad <p>no</p> --><div class="ad">Buy now.</div>
<article><h1>Title &amp; more</h1><p><b>First   one.<br><p>Second
 <a href=x>link</a> &eacute;.</p></article><footer>&copy; site &middot; Words here.
Te.</footer></body></html>"""


def test_blocks():
    texts = [b.text for b in main_text.blocks(PAGE)]
    assert texts == ["Home", "News", "Buy now.", "Title & more", "First one.", "Second link é.", "© site · Words here. Te."]
    assert main_text.blocks(None) == main_text.blocks("") == main_text.blocks("<script>x") == main_text.blocks("<!-- x") == []
    assert [b.text for b in main_text.blocks("</p>a</div><p>b<div>c<td")] == ["a", "b", "c"]
    assert [b.text for b in main_text.blocks("x < y <b>&lt;z&gt;</b> & w")] == ["x < y <z> & w"]
    assert [b.text for b in main_text.blocks("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e")] == ["a", "b", "c", "d", "e"]


def test_gradient_equals_differences():
    rng = np.random.default_rng(1)
    pages = [p for p, _ in main_text.examples(["One two three.", "Four five six seven?"], 3, 5)]
    truth = [rng.integers(0, 2, p.size).astype(np.float32) for p in pages]
    w = {k: v.astype(np.float64) for k, v in main_text.fresh(4).items()}
    _, grad = main_text.gradients(w, pages, truth)
    for name, g in grad.items():
        flat = np.abs(g).ravel()
        for at in np.argsort(flat)[-3:]:
            place = np.unravel_index(at, g.shape)
            step, kept = 1e-3, w[name][place]
            w[name][place] = kept + step
            high = main_text.gradients(w, pages, truth)[0]
            w[name][place] = kept - step
            low = main_text.gradients(w, pages, truth)[0]
            w[name][place] = kept
            assert (high - low) / (2 * step) == pytest.approx(g[place], rel=2e-2, abs=1e-5), name


@pytest.fixture(scope="module")
def weights():
    rng = random.Random(3)
    words = [f"w{rng.randrange(900)}" for _ in range(4000)]
    texts = [" ".join(words[k : k + rng.randrange(3, 60)]) + "." for k in range(0, 3900, 20)]
    return main_text.train(list(main_text.examples(texts)))


def test_held_out_layouts(weights):
    right = blocks = 0
    for page, truth in main_text.examples(["Some words of a page.", "And, in the end, others: are they main?", "Short"], 200, 41):
        if page.size:
            right += int(((main_text.probabilities(weights, [page])[0] >= 0.5) == (truth > 0.5)).sum())
            blocks += page.size
    assert right >= 0.98 * blocks


def test_pages(spark, weights):
    assert main_text.label(weights, [PAGE, None, "", "<p>"]) == ["Title & more\nFirst one.\nSecond link é.", "", "", ""]
    long = "<body><article>" + "<p>some words of it.</p>" * 3000 + "</article></body>"
    assert main_text.label(weights, [long, PAGE])[1] == main_text.label(weights, [PAGE])[0]
    rows = [(1, "u", PAGE, "k"), (1, "u", PAGE, "k"), (None, None, None, None), (3, "v", "", "k")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = main_text.report(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == 4
    assert {(r["page_id"], r["n_chars"]) for r in got.where("page_id is null or page_id = 3").collect()} == {(None, 0), (3, 0)}
    assert main_text.report(pages.where("false")).collect() == []
