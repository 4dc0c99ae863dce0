"""Main text of web pages by a linear-chain conditional random field.

1. *Blocks*: a page is read tag by tag; text between block-level tags is one
   leaf block, with the tags, classes, ids and roles of its ancestors.
   Scripts, styles, comments, head matter and form controls hold no text.  Of
   them, one that is never closed ends at the next block-level tag, and a head
   at the first tag or text that cannot stand in it.
   Character references are decoded, white space becomes one space.
2. *Features* of a block: its ancestors' tags, words of their class, id and
   role, and the nearest tag; and of the text, its length, the share inside
   links, final punctuation, digits, a copyright mark.
3. *Chain*: labels main and other, with weights for features per label and for
   pairs of neighbours.  Training maximises the likelihood (forward-backward,
   L-BFGS-free gradient steps with momentum) on labelled pages; decoding is by
   Viterbi.

The labelled pages are made from a fixed seed by ``labelled_pages``: layouts
with headers, menus, adverts, notices, sidebars, forms, articles in several
mark-ups, reader comments and footers, in any combination, whose blocks carry
their label.  A model is trained once per process.

Nulls and ties: a null or empty page has no blocks and an empty text, as has a
page with no main block; a null page_id or url is returned; repeated rows give
a row each.  Only page_id, url and html are read.
"""

from __future__ import annotations

import functools
import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowline.llm.common import table

DIMS = 1 << 14           # hashed features
PAGES = 600              # labelled pages
STEPS = 120              # gradient steps
L2 = 2e-4

# HTML's element classes.
BLOCK_TAGS = frozenset("""address article aside blockquote body br button caption center dd details dialog dir div dl
dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav
noscript ol optgroup option p pre search section select summary table tbody td template textarea tfoot th thead title
tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT_TAGS = frozenset("""script style head title noscript template svg math iframe object select textarea
button canvas audio video option""".split())
FOREIGN_TAGS = frozenset(("svg", "math"))
RAW_TAGS = frozenset("script style textarea title".split())
HEAD_TAGS = frozenset("""head html base basefont bgsound link meta title script style noscript noframes template
object""".split())
# an opening tag that closes these open ones (an unclosed <p>, <li> and so on)
IMPLIED_END = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
               "th": ("td", "th"), "option": ("option",)}
CLOSES_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul""".split())
SCOPES = frozenset("html body table td th ul ol dl div article section aside nav header footer main form".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                   r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SPACES = re.compile(r"\s+")


def _self_closed(attributes: str) -> bool:
    """Whether a tag ends in '/>', the '/' being no part of a bare value."""
    if not attributes.endswith("/"):
        return False
    tail = 1 + max(attributes.rfind(c) for c in " \t\n\r\f\"'")
    return "=" not in attributes[tail:] and not attributes[:tail].rstrip().endswith("=")


def _tokens(page: str) -> list[list]:
    """[begin, end, tag or None, is end tag, attributes, closed] of the markup
    in page order.  Of an opening tag, closed is True if its end tag comes
    before that of an element around it, and None if it is empty ('/>')."""
    out: list[list] = []
    stack: list[list] = []
    depth: dict = {}                                    # open elements by tag
    at = 0
    while m := TOKEN.search(page, at):
        at = m.end()
        tag = m[2] and m[2].lower()
        one = [m.start(), at, tag, bool(m[1]), m[3] or "", False]
        out.append(one)
        if tag is None or (tag in VOID_TAGS and not m[1]):
            continue
        if m[1]:
            if depth.get(tag):
                while True:
                    x = stack.pop()
                    depth[x[2]] -= 1
                    if x[2] == tag:
                        x[5] = True
                        break
            continue
        if _self_closed(one[4]) and (tag in FOREIGN_TAGS or any(depth.get(t) for t in FOREIGN_TAGS)):
            one[5] = None
            continue
        stack.append(one)
        depth[tag] = depth.get(tag, 0) + 1
        if tag in RAW_TAGS:                             # no markup inside
            stop = re.compile(f"</{tag}", re.I).search(page, at)
            if stop is not None:
                at = stop.start()
            elif tag in ("script", "style"):
                out.append([len(page), len(page), None, False, "", False])
                break
    for one in out:                                     # never closed, and written as empty
        if one[5] is False and one[2] in SILENT_TAGS and not one[3] and _self_closed(one[4]):
            one[5] = None
    return out


class Block:
    """A leaf block: its text, the characters in links, and its ancestors."""

    __slots__ = ("text", "linked", "path", "names", "label")

    def __init__(self, text, linked, path, names, label):
        self.text, self.linked, self.path, self.names, self.label = text, linked, path, names, label


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page, in page order."""
    out: list[Block] = []
    stack: list = [("", (), None, False)]               # tag, words of its names, label, has an end tag
    parts: list[str] = []
    linked = silent = links = 0
    page = page or ""

    def flush():
        nonlocal parts, linked
        if parts:
            text = SPACES.sub(" ", "".join(parts)).strip()
            if text:
                label = next((x[2] for x in reversed(stack) if x[2] is not None), None)
                out.append(Block(text, linked, tuple(x[0] for x in stack[1:]),
                                 tuple(w for x in stack for w in x[1]), label))
            parts, linked = [], 0

    def close(k: int):
        nonlocal silent, links
        for tag, _, _, _ in stack[k:]:
            silent -= tag in SILENT_TAGS
            links -= tag == "a"
        del stack[k:]

    def end_unclosed():
        """Close what holds no text, has no end tag and lies in nothing that has one."""
        at = None
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in SILENT_TAGS:
                if stack[k][3]:
                    break
                at = k
        if at is not None:
            close(at)

    at, size = 0, len(page)
    for begin, end, tag, ends, attributes, closed in [*_tokens(page), (size, size, None, False, "", False)]:
        if begin > at:
            if stack[-1][0] == "head" and not page[at:begin].isspace():
                close(len(stack) - 1)
            if not silent:
                text = entities.unescape(page[at:begin])
                parts.append(text)
                if links:
                    linked += len(text)
        at = end
        if tag is None:
            continue
        if ends:                                        # an end tag
            if tag in BLOCK_TAGS:
                flush()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
            continue
        if tag in BLOCK_TAGS:
            flush()
        if silent:
            if tag == "body" or (stack[-1][0] == "head" and tag not in HEAD_TAGS):
                k = next((k for k, x in enumerate(stack) if x[0] == "head"), None)
                if k is not None:
                    close(k)
            if tag in CLOSES_P:
                end_unclosed()
        if tag in CLOSES_P or tag in IMPLIED_END:
            gone = IMPLIED_END.get(tag, ("p",))
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in gone:
                    close(k)
                    break
                if stack[k][0] in SCOPES:
                    break
        if tag in VOID_TAGS or closed is None:
            continue
        words, label = (), None
        if attributes.strip():
            found = {a[0].lower(): a[1] or a[2] or a[3] for a in ATTRIBUTE.findall(attributes)}
            words = tuple(w.lower() for key in ("class", "id", "role", "aria-label", "itemprop") if key in found
                          for w in NAME_WORD.findall(found[key]))
            if "hidden" in found or "display:none" in found.get("style", "").replace(" ", ""):
                words += ("hidden",)
            label = found.get("data-main")
        stack.append((tag, words, label, closed))
        silent += tag in SILENT_TAGS
        links += tag == "a"
    flush()
    return out


# ---------------------------------------------------------------- features

@functools.lru_cache(maxsize=200_000)
def _cell(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature.encode("utf-8", "surrogatepass")) % DIMS


def features(page: list[Block]) -> list[list[int]]:
    """Cells of each block's features."""
    out = []
    for b in page:
        n = len(b.text)
        names = ["bias", f"size {min(n.bit_length(), 12)}", f"links {min(4, int(5 * b.linked / (n + 1)))}"]
        names += [f"in {t}" for t in set(b.path) - {"html", "body"}]
        names += [f"name {w}" for w in set(b.names)]
        near = next((t for t in reversed(b.path) if t in BLOCK_TAGS), "")
        names.append(f"near {near}")
        if b.text[-1] in ".!?…。\"'”»)":
            names.append("ends")
        if b.text[-1] == ":":
            names.append("colon")
        if sum(map(str.isdigit, b.text)) * 4 > n:
            names.append("digits")
        if "©" in b.text or "copyright" in b.text.lower():
            names.append("copyright")
        out.append([_cell(f) for f in names])
    return out


# ---------------------------------------------------------------- the chain

class Chain:
    """Labels 0 (other) and 1 (main)."""

    def __init__(self):
        self.w = np.zeros((DIMS, 2))
        self.t = np.zeros((2, 2))

    def _emissions(self, cells: list[list[int]]) -> np.ndarray:
        flat = np.fromiter((c for row in cells for c in row), np.int64)
        starts = np.cumsum([0, *map(len, cells[:-1])])
        return np.add.reduceat(self.w[flat], starts, axis=0)

    def fit(self, pages: list[tuple[list[list[int]], np.ndarray]], steps: int = STEPS) -> None:
        """Adam on the negative log likelihood; all pages run side by side."""
        rows, wide = len(pages), max(len(y) for _, y in pages)
        flat = np.concatenate([np.fromiter((c for r in x for c in r), np.int64) for x, _ in pages])
        counts = np.concatenate([[len(r) for r in x] for x, _ in pages])
        size = np.array([len(y) for _, y in pages])
        live = np.arange(wide) < size[:, None]
        gold = np.zeros((rows, wide), np.int64)
        gold[live] = np.concatenate([y for _, y in pages])
        starts = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(counts)), counts)
        hot = np.zeros((rows, wide, 2))
        hot[live, gold[live]] = 1.0
        pair_gold = np.zeros((2, 2))
        both = live[:, 1:] & live[:, :-1]
        np.add.at(pair_gold, (gold[:, :-1][both], gold[:, 1:][both]), 1)
        params = np.concatenate([self.w.ravel(), self.t.ravel()])
        m, v = np.zeros_like(params), np.zeros_like(params)
        for step in range(1, steps + 1):
            w, t = params[:2 * DIMS].reshape(DIMS, 2), params[2 * DIMS:].reshape(2, 2)
            e = np.zeros((rows, wide, 2))
            e[live] = np.add.reduceat(w[flat], starts, axis=0)
            a, b = np.zeros((rows, wide, 2)), np.zeros((rows, wide, 2))
            a[:, 0] = e[:, 0]
            for k in range(1, wide):
                s = np.logaddexp(a[:, k - 1, 0:1] + t[0], a[:, k - 1, 1:2] + t[1]) + e[:, k]
                a[:, k] = np.where(live[:, k, None], s, a[:, k - 1])
            for k in range(wide - 2, -1, -1):
                x = e[:, k + 1] + b[:, k + 1]
                s = np.logaddexp(t[:, 0] + x[:, 0:1], t[:, 1] + x[:, 1:2])
                b[:, k] = np.where(live[:, k + 1, None], s, 0.0)
            z = np.logaddexp(a[:, -1, 0], a[:, -1, 1])
            p = np.exp(a + b - z[:, None, None]) * live[:, :, None]
            pair = a[:, :-1, :, None] + t + (e + b)[:, 1:, None, :] - z[:, None, None, None]
            gt = (np.exp(np.minimum(pair, 0)) * both[:, :, None, None]).sum((0, 1)) - pair_gold
            d = (p - hot)[live]
            gw = np.stack([np.bincount(flat, d[owner, y], DIMS) for y in (0, 1)], axis=1)
            g = np.concatenate([gw.ravel(), gt.ravel()]) / rows + L2 * params
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            params = params - 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        self.w, self.t = params[:2 * DIMS].reshape(DIMS, 2), params[2 * DIMS:].reshape(2, 2)

    def decode(self, cells: list[list[int]]) -> list[int]:
        """The most likely labels, by Viterbi; ties go to main."""
        if not cells:
            return []
        e = self._emissions(cells).tolist()
        (t00, t01), (t10, t11) = self.t.tolist()
        x, y = e[0]
        back = []
        for a, b in e[1:]:
            to0, to1 = y + t10 >= x + t00, y + t11 >= x + t01
            back.append((to0, to1))
            x, y = (y + t10 if to0 else x + t00) + a, (y + t11 if to1 else x + t01) + b
        label = int(y >= x)
        out = [label]
        for to0, to1 in reversed(back):
            label = int(to1 if label else to0)
            out.append(label)
        return out[::-1]


# ---------------------------------------------------------------- labelled pages

_SYLLABLES = ("the an re on er in ti es at nd or ou ha en th ing le de la un par ein der sch ich os ado que mente "
              "con por tion").split()


def labelled_pages(n: int, seed: int = 5) -> list[str]:
    """Pages whose elements say ``data-main="1"`` or ``"0"`` for their blocks."""
    rng = np.random.default_rng(seed)

    def pick(xs):
        return xs[int(rng.integers(len(xs)))]

    def chance(p):
        return rng.random() < p

    def word():
        return "".join(pick(_SYLLABLES) for _ in range(int(rng.integers(1, 5))))

    def words(a, b):
        return " ".join(word() for _ in range(int(rng.integers(a, b))))

    def sentence(a=1, b=22):
        return words(a, b).capitalize() + pick([".", ".", ".", "!", "?", ""])

    def prose(a=1, b=6):
        text = " ".join(sentence() for _ in range(int(rng.integers(a, b))))
        if chance(0.1):                                 # tables as text, noise, numbers
            text = pick([" | ", "%%% ", " &middot; ", "&amp;&amp; ", " 12 "]).join(text.split(" "))
        return text

    def links(k):
        return "".join(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' for _ in range(k))

    def menu():
        k = int(rng.integers(2, 9))
        body = pick([f"<ul>{links(k)}</ul>", " | ".join(f'<a href="/{word()}">{word()}</a>' for _ in range(k)),
                     "".join(f'<a href="#">{words(1, 3)}</a> ' for _ in range(k))])
        return pick([f"<nav>{body}</nav>", f'<div class="{pick(["menu", "navbar", "nav", "breadcrumb", "site-nav"])}">'
                     f"{body}</div>", f'<div id="{pick(["nav", "navigation", "topmenu"])}">{body}</div>',
                     f'<div role="navigation">{body}</div>', f"<nav>{body}</nav>"])

    def header():
        body = pick([f"<h1>{words(1, 4)}</h1>", f'<a href="/">{words(1, 3)}</a>', f"<p>{sentence(2, 8)}</p>", ""])
        body += menu() if chance(0.4) else ""
        return pick([f"<header>{body}</header>", f'<div class="{pick(["header", "masthead", "site-header", "banner", "topbar"])}">'
                     f"{body}</div>", f'<div id="header">{body}</div>'])

    def advert():
        body = pick([prose(1, 3), f'<a href="#">{sentence(2, 9)}</a>', f"<p>{prose(1, 3)}</p>"])
        name = pick(["ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner-ad", "ad-box", "ad"])
        return pick([f'<div class="{name}">{body}</div>', f'<div id="{name}">{body}</div>',
                     f'<aside class="{name}">{body}</aside>', f'<section class="{name}">{body}</section>'])

    def notice():
        name = pick(["cookie", "cookie-notice", "consent", "notice", "newsletter", "alert", "gdpr", "popup", "subscribe",
                     "modal", "paywall", "cookie-banner"])
        return f'<div {pick(["class", "id"])}="{name}"><p>{prose(1, 3)}</p>' + pick(["", "<button>OK</button>"]) + "</div>"

    def sidebar():
        body = f"<h3>{words(1, 3)}</h3>" + pick([f"<ul>{links(4)}</ul>", f"<p>{prose(1, 4)}</p>", f"<p>{words(3, 9)}</p>"])
        name = pick(["sidebar", "side", "related", "widget", "recommended", "rail", "share", "social", "author-bio", "tags"])
        return pick([f"<aside>{body}</aside>", f'<div class="{name}">{body}</div>', f'<div id="{name}">{body}</div>',
                     f'<aside class="{name}">{body}</aside>'])

    def form():
        body = f"<label>{words(1, 3)}</label><input name=q><p>{sentence(1, 8)}</p><button>{word()}</button>"
        return pick([f"<form>{body}</form>", f'<form class="search">{body}</form>'])

    def comments():
        body = "".join(pick([f'<div class="comment"><b>{word()}</b><p>{prose(1, 4)}</p></div>',
                             f"<li><p>{prose(1, 4)}</p></li>", f"<p>{prose(1, 4)}</p>"]) for _ in range(int(rng.integers(1, 6))))
        name = pick(["comments", "comment-list", "responses", "replies", "discussion", "disqus", "user-comments", "comments"])
        return f'<{(t := pick(["div", "section", "ol", "div"]))} {pick(["class", "id"])}="{name}"><h3>{words(1, 3)}</h3>{body}</{t}>'

    def footer():
        body = pick(["&copy; ", "&copy; 2020 ", "Copyright ", ""]) + words(1, 4) + pick([" &middot; ", " | ", " "]) + prose(1, 3)
        body = pick([body, f"<p>{body}</p>", f"<p>{body}</p><ul>{links(3)}</ul>"])
        return pick([f"<footer>{body}</footer>", f'<div class="{pick(["footer", "site-footer", "bottom", "copyright", "legal"])}">'
                     f"{body}</div>", f'<div id="footer">{body}</div>', f"<footer>{body}</footer>"])

    def part():
        kind = int(rng.integers(14))
        if kind < 6:
            return f"<p>{prose()}" + pick(["</p>", "</p>", ""])
        if kind == 6:
            return f"<p><b>{prose(1, 3)}<br>"
        if kind == 7:
            return f"<h{int(rng.integers(2, 5))}>{words(1, 8)}</h2>"
        if kind == 8:
            return "<ul>" + "".join(f"<li>{pick([words(1, 6), prose(1, 3)])}</li>" for _ in range(3)) + "</ul>"
        if kind == 9:
            return f"<blockquote>{prose(1, 3)}</blockquote>"
        if kind == 10:
            return "<table>" + "".join(f"<tr><td>{words(1, 4)}</td><td>{int(rng.integers(9999))}</td></tr>" for _ in range(3)) + "</table>"
        if kind == 11:
            return f"<pre>{words(1, 9)} = {int(rng.integers(99))};\n{words(1, 5)}()</pre>"
        if kind == 12:
            return f"<figure><img src=x><figcaption>{words(2, 9)}.</figcaption></figure>"
        return f'<p>{prose(1, 3)} <a href="/{word()}">{words(1, 4)}</a> {prose(1, 3)}</p>'

    def article():
        body = pick(["", f"<h1>{pick([words(1, 9), prose(1, 3)])}</h1>"]) + "".join(part() for _ in range(int(rng.integers(1, 14))))
        if chance(0.25):
            body += f'<div data-main="0">{pick([advert, sidebar, comments, form, notice])()}</div>' + part()
        name = pick(["content", "post", "entry", "article-body", "story", "main", "post-content", "text"])
        return pick([f"<article>{body}</article>", f"<article>{body}</article>", f"<main>{body}</main>",
                     f'<div class="{name}">{body}</div>', f'<div id="{name}">{body}</div>', f'<div role="main">{body}</div>',
                     f'<main><article class="{name}">{body}</article></main>', f"<div>{body}</div>"])

    out = []
    for _ in range(n):
        bare = chance(0.1)                              # nothing but the article

        def zero(f, p):
            return f'<div data-main="0">{f()}</div>' if not bare and chance(p) else ""
        body = zero(notice, 0.2) + zero(header, 0.5) + zero(menu, 0.6) + zero(advert, 0.5) + zero(sidebar, 0.2)
        body += f'<div data-main="1">{article()}</div>'
        body += zero(comments, 0.4) + zero(sidebar, 0.3) + zero(advert, 0.3) + zero(form, 0.2) + zero(footer, 0.8) + zero(notice, 0.1)
        out.append(f"<html><head><title>{words(1, 9)}</title><script>var a='<p>';</script></head><body>{body}</body></html>")
    return out


def examples(pages: list[str]) -> list[tuple[list[list[int]], np.ndarray]]:
    """(features, labels) of labelled pages; blocks without a label are left out."""
    out = []
    for page in pages:
        found = [b for b in blocks(page) if b.label is not None]
        if found:
            out.append((features(found), np.array([int(b.label) for b in found])))
    return out


@functools.lru_cache(maxsize=2)
def trained(pages: int = PAGES) -> Chain:
    chain = Chain()
    chain.fit(examples(labelled_pages(pages)))
    return chain


def main_text(page: str | None, chain: Chain) -> str:
    """The main blocks of a page, joined by one space."""
    found = blocks(page)
    return " ".join(b.text for b, y in zip(found, chain.decode(features(found))) if y)


def extract(pages: DataFrame, labelled: int = PAGES) -> DataFrame:
    """page_id, url, text, n_chars for each page."""
    model = pages.sparkSession.sparkContext.broadcast(trained(labelled))       # 256 kB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [main_text(h, model.value) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(text, pa.string()),
                 pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")


def op1_htmlcrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all ``pages``."""
    return extract(table(spark, sf_dir, "pages"))
