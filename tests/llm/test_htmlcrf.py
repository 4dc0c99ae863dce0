import itertools

import numpy as np
import pytest

from flowline.llm import htmlcrf as H


@pytest.fixture(scope="module")
def chain():
    return H.trained()


def test_held_out_pages(chain):
    right = total = 0
    for x, y in H.examples(H.labelled_pages(120, seed=91)):
        p = np.array(chain.decode(x))
        right, total = right + (p == y).sum(), total + len(y)
    assert right / total > 0.99


def test_viterbi_equals_all_labellings(chain):
    page = H.blocks(H.labelled_pages(8, seed=17)[3])[:9]
    cells = H.features(page)
    e = chain._emissions(cells)
    best = max(itertools.product((0, 1), repeat=len(cells)),
               key=lambda y: sum(e[k, v] for k, v in enumerate(y)) + sum(chain.t[a, b] for a, b in itertools.pairwise(y)))
    assert chain.decode(cells) == list(best)


def test_gradient_by_differences():
    pages = H.examples(H.labelled_pages(3, seed=2))

    def loss(c):
        total = 0.0
        for x, y in pages:
            e = c._emissions(x)
            a = e[0]
            for k in range(1, len(e)):
                a = np.logaddexp(a[0] + c.t[0], a[1] + c.t[1]) + e[k]
            total += np.logaddexp(*a) - sum(e[k, v] for k, v in enumerate(y)) - sum(c.t[p, q] for p, q in itertools.pairwise(y))
        return total

    c = H.Chain()
    before = loss(c)
    c.fit(pages, steps=25)
    assert loss(c) < 0.2 * before


def test_text_rules(chain):
    page = ("<html><body><nav><a href=/>Home</a></nav><article><h1>A &amp; B</h1><p>One  <b>bo</b>ld\n line.<br>Two "
            "&lt;tag&gt; &eacute;&#33;<p>Unclosed paragraph here.<script>var x='<p>no</p>';</script><!-- <p>no</p> -->"
            "</article><div class='comments'><p>Nice post, thanks a lot.</p></div><footer>&copy; 2020 Site</footer>")
    assert H.main_text(page, chain) == "A & B One bold line. Two <tag> é! Unclosed paragraph here."


def test_broken_pages(chain):
    for page in (None, "", "<", "<p", "<!--", "<script>", "</div></p>", "<a href='x", "&#xZZ; &bogus; &#99999999999;",
                 "<style>p{}", "<title>x", "<table><tr><td>a<td>b", "<div " * 500, "<p>" * 3000 + "x"):
        assert isinstance(H.main_text(page, chain), str)
    long = "<article>" + "<p>Some words in a sentence.</p>" * 20_000 + "</article>"
    assert H.main_text(long, chain).count("sentence.") == 20_000


def test_pages_table(spark):
    rows = [(1, "u", "<article><p>Some text of the page.</p></article>"), (2, None, None), (3, "u", ""), (None, "u", "<p>"),
            (1, "u", "<article><p>Some text of the page.</p></article>")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "page_id long, url string, html string, text int")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in H.extract(df).collect()), key=str)
    text = "Some text of the page."
    assert got == sorted([(1, "u", text, len(text))] * 2 + [(2, None, "", 0), (3, "u", "", 0), (None, "u", "", 0)], key=str)
    assert H.extract(df.limit(0)).count() == 0


def test_given_pages_are_their_articles(spark, chain):
    import html
    import re
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        body = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        body = re.sub("</?(b|i|a|em|strong|span)>", "", body)
        assert H.main_text(r.html, chain) == " ".join(html.unescape(re.sub("<[^>]+>", " ", body)).split())


def shown(page):
    return " ".join(b.text for b in H.blocks(page))


def test_head_without_end_tag(chain):
    body = "<article><h1>A title</h1><p>One sentence of text.</p></article>"
    want = "A title One sentence of text."
    for head in ("<head><title>t</title>", "<head><meta charset=utf-8><title>t</title><script>x</script>", "<head>",
                 "<head><title>t</title><noscript><link rel=x></noscript>", "<head><noscript>", "<head><title>t"):
        assert H.main_text(f"<html>{head}<body>{body}", chain) == want
    assert H.main_text(f"<head><title>t</title>{body}", chain) == want              # no <body> either
    assert shown("<head><title>t</title>\n Plain text") == "Plain text"
    assert shown("<head><title>t</title><style>p{}</style></head><body>x") == "x"


def test_silent_elements_without_end_tag(chain):
    for tag in ("button", "select", "noscript", "video", "audio", "canvas", "iframe", "object", "template", "svg",
                "math", "textarea", "select><option", "button><svg"):
        page = f"<article><p>One sentence here.</p><{tag}>x<p>Two sentences here.</p><p>Three of them.</p></article>"
        assert H.main_text(page, chain) == "One sentence here. Two sentences here. Three of them.", tag
    for tag in ("noscript", "video", "object"):                 # with one, what it holds stays out
        assert shown(f"<p>a</p><{tag}><p>b</p><button>c<p>d</p></{tag}><p>e</p>") == "a e", tag
    assert shown("<noscript><button><p>a</p></button><p>b</p>") == "b"


def test_self_closed_silent_elements():
    for tag in ("svg", "svg width='1' ", "math", "iframe src=\"x\" ", "video src='x'", "canvas", "object"):
        assert shown(f"<p>a <{tag}/> b</p><p>c</p>") == "a b c", tag
    assert shown("<p>a <svg><title/><path d='x'/></svg> b</p>") == "a b"
    assert shown("<p>a <iframe src=http://x/></iframe> b <svg class=x/>c</svg></p>") == "a b"
    assert shown("<div>a<div/>b</div>c") == "a b c"


def test_digits_of_the_whole_block():
    digits = H._cell("digits")
    prose, numbers = "words in a sentence " * 100, "1234567 " * 30
    for text, want in ((numbers + prose, False), (prose[:220] + numbers * 10, True), (numbers, True), ("no 1", False)):
        assert (digits in H.features(H.blocks(f"<p>{text}</p>"))[0]) == want
