"""Main text of web pages: a linear-chain conditional random field over the
DOM's leaf blocks.

A page is read once, left to right, into leaf blocks: stretches of text that no
block-level tag interrupts. A block's features are its ancestors' tags, cues in
their class, id, role and label attributes, its own tag, and its text (length,
share of link text, punctuation, signs). The field labels the blocks of a page
as one sequence, main text or not, and Viterbi finds the best labelling.

The field is fitted on the driver on ``TRAIN_PAGES`` generated, labelled pages
(a fixed bound) in many layouts, since no table here labels blocks.

Defined results: a null or empty page has no text; scripts, styles, the head and
elements that are not shown (``hidden``, ``display:none``) are never blocks; character references are decoded; white space inside a block,
line breaks included, becomes one space; blocks are joined in page order by a
line feed, none is shortened; broken and cut-off markup is read as far as it
goes; an empty table gives an empty result."""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.llm import crf

# ---- fixed values: HTML's own element classes ------------------------------
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
                  "option p pre search section select summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
UNSEEN = frozenset("head template svg math noscript object canvas audio video select".split())
CLOSES_SAME = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
               "th": {"tr", "table"}, "option": {"select"}}
# ---------------------------------------------------------------------------
CUES = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs topbar toolbar pagination pager tabs skip toc",
    "side": "sidebar side aside rail widget complementary",
    "ad": "ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner adsense commercial",
    "comment": "comment comments commentlist reply replies respond discussion disqus thread feedback review reviews",
    "notice": "cookie cookies consent notice alert popup modal gdpr newsletter subscribe signup dialog overlay paywall warning",
    "foot": "footer foot bottom copyright colophon legal contentinfo imprint",
    "head": "header masthead logo branding top hero banner-top site-title",
    "share": "share sharing social follow like likes",
    "related": "related recommended recommendations more popular trending latest teaser also",
    "form": "form search login register contact-form input",
    "meta": "byline author meta date tags tag published timestamp",
    "content": "content article post entry story text body main page blog single",
}
_CUE_OF = {t: c for c, ts in CUES.items() for t in ts.split()}
TRAIN_PAGES = 600
SEED = 11

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>"""
                    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|</\Z""", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAMED = frozenset(("class", "id", "role", "aria-label", "itemprop"))
_NOT_SHOWN = re.compile(r"(?:^|[;\s\"'])(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
_TAGS = frozenset("nav header footer aside form article main section ul ol table figure blockquote button dialog a "
                  "fieldset details pre label figcaption address".split())


def _marks(tag: str, attrs: str) -> tuple[list[str], bool]:
    """Features an element gives to the blocks inside it, and whether they are
    shown at all (not under ``hidden``, ``display:none`` or ``visibility:hidden``)."""
    out, shown = ["in:" + tag] if tag in _TAGS else [], True
    if attrs:
        for name, value in _ATTR.findall(attrs):
            name = name.lower()
            if name == "hidden" or name == "style" and _NOT_SHOWN.search(value):
                shown = False
            elif name in _NAMED:
                for t in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()):
                    if t in _CUE_OF:
                        out.append("cue:" + _CUE_OF[t])
    return out, shown


def leaf_blocks(page: str) -> list[tuple[str, list[str]]]:
    """(text, features) of every leaf block with text, in page order."""
    blocks: list[tuple[str, list[str]]] = []
    stack: list[tuple[str, list[str], bool]] = []
    active: Counter[str] = Counter()
    depth: Counter[str] = Counter()
    unseen = 0
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            raw = "".join(parts)
            text = " ".join(raw.split())
            if text:
                own = next((e[0] for e in reversed(stack) if e[0] in BLOCK), "body")
                blocks.append((text, ["own:" + own, *active, *_text_features(text, linked / max(1, len(raw)))]))
            parts.clear()
        linked = 0

    def pop() -> None:
        nonlocal unseen
        tag, marks, skipped = stack.pop()
        depth[tag] -= 1
        unseen -= skipped
        for m in marks:
            active[m] -= 1
            if not active[m]:
                del active[m]

    def close(tag: str, limit: set[str] | frozenset[str] = frozenset()) -> None:
        """Close the nearest open ``tag`` unless one of ``limit`` is nearer."""
        if depth[tag]:
            for t, *_ in reversed(stack):
                if t == tag:
                    while stack[-1][0] != tag:
                        pop()
                    pop()
                    return
                if t in limit:
                    return

    at = 0
    while True:
        m = _TOKEN.search(page, at)
        if (m.start() if m else len(page)) > at and not unseen:
            text = html.unescape(page[at:m.start() if m else len(page)])
            parts.append(text)
            if depth["a"]:
                linked += len(text)
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag in BLOCK:
                flush()
            if tag != "html" and tag != "body":
                close(tag)
            continue
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}[^a-zA-Z0-9]", re.I).search(page, at)
            at = end.start() if end else len(page)
            if end:
                gt = page.find(">", at)
                at = gt + 1 if gt >= 0 else len(page)
            continue
        if tag == "br":
            parts.append(" ")
        if tag in BLOCK:
            flush()
            if depth["p"] and tag not in ("body", "html"):
                close("p", {"button", "td", "th", "table"})
            if tag in CLOSES_SAME:
                close(tag, CLOSES_SAME[tag])
            if tag == "body" and depth["head"]:
                close("head")
        attrs = m[3] or m[6] or ""
        if tag not in VOID and not attrs.endswith("/"):
            marks, shown = _marks(tag, attrs)
            skipped = tag in UNSEEN or not shown
            stack.append((tag, marks, skipped))
            depth[tag] += 1
            unseen += skipped
            active.update(marks)
    flush()
    return blocks


def _text_features(text: str, links: float) -> list[str]:
    n = text.count(" ") + 1
    out = [f"words:{min(6, n.bit_length())}", f"links:{int(min(links, 1.0) * 3.99)}", "end:" + (
        "stop" if text[-1] in ".!?…:;\"'”»)" else "word")]
    if "©" in text[:40]:
        out.append("sign:copyright")
    if "|" in text or "»" in text or "›" in text:
        out.append("sign:bar")
    low = text[:200].lower()
    if "cookie" in low or "consent" in low:
        out.append("word:cookie")
    if "rights reserved" in low or "privacy policy" in low:
        out.append("word:legal")
    return out


def sequence(blocks: list[tuple[str, list[str]]]) -> list[list[str]]:
    """Feature sets of a page's blocks, with a mark for the first and last."""
    out = [["bias", *f] for _, f in blocks]
    if out:
        out[0].append("first")
        out[-1].append("last")
    return out


def _labelled(rng: random.Random) -> tuple[str, set[str]]:
    """One generated page and the texts of its main blocks."""
    word = lambda: "".join(rng.choice("aeiounrstldhmc") for _ in range(rng.randint(2, 9)))
    words = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    main: set[str] = set()

    def prose() -> str:
        return ". ".join(words(1, 14).capitalize() for _ in range(rng.choice((1, 1, 2, 3, 6)))) + "."

    def keep(s: str) -> str:
        main.add(" ".join(s.split()))
        return s

    def attr(*names: str) -> str:
        return rng.choice(("", *(f' {k}="{v}"' for v in names for k in ("class", "id"))))

    def must(*names: str) -> str:
        return f' {rng.choice(("class", "id"))}="{rng.choice(names)}"'

    def links(n: int, tag: str = "li") -> str:
        return "".join(f'<{tag}><a href="/{word()}">{words(1, 3)}</a></{tag}>' for _ in range(n))

    ad = lambda: f"<div{must('ad', 'ads', 'advert', 'sponsored', 'promo-box', 'ad-banner')}>{rng.choice((prose(), words(2, 8)))}</div>"
    notice = lambda: f"<div{must('cookie-notice', 'notice', 'consent', 'alert', 'newsletter', 'popup')}><p>{rng.choice((prose(), 'We use cookies. ' + words(2, 6)))}</p>{rng.choice(('', f'<button>{word()}</button>'))}</div>"
    form = lambda: f"<form{attr('search', 'login')}><label>{words(1, 3)}</label><input name=q><button>{word()}</button></form>"

    def comments() -> str:
        items = "".join(rng.choice((f"<div{must('comment', 'reply')}><p>{prose()}</p></div>", f"<li><p>{prose()}</p></li>"))
                        for _ in range(rng.randint(1, 5)))
        tag = rng.choice(("section", "div", "ol"))
        return f"<{tag}{must('comments', 'comment-list', 'discussion', 'reviews')}>" + rng.choice(
            ("", f"<h2>{words(1, 3)}</h2>")) + items + f"</{tag}>"

    side = lambda: rng.choice((f"<aside{attr('sidebar', 'widget')}>", f"<div{must('sidebar', 'widget', 'related', 'popular')}>"))

    def sidebar() -> str:
        s = side()
        return s + f"<h3>{words(1, 3)}</h3><ul>{links(rng.randint(2, 5))}</ul>" + rng.choice(("", f"<p>{prose()}</p>")) + (
            "</aside>" if s.startswith("<aside") else "</div>")

    top = [rng.choice((f"<nav><ul>{links(rng.randint(2, 8))}</ul></nav>", f"<div{must('menu', 'navbar', 'nav')}>{links(rng.randint(2, 6), 'span')}</div>",
                       f"<ul{must('menu', 'breadcrumb')}>{links(rng.randint(2, 6))}</ul>"))]
    for piece in (f"<header{attr('masthead')}><a href=/>{words(1, 3)}</a><p>{words(2, 8)}</p></header>", ad(), notice(), form()):
        if rng.random() < .4:
            top.insert(rng.randint(0, len(top)), piece)
    body = []
    if rng.random() < .85:
        body.append(f"<h1>{keep(rng.choice((words(2, 10), prose())))}</h1>")
    for _ in range(rng.choice((1, 2, 4, 8, 14))):
        r = rng.random()
        s = keep(rng.choice((prose(), prose(), words(1, 4))))
        if r < .62:
            body.append(rng.choice((f"<p>{s}</p>", f"<p>{s}", f"<p><b>{s}</b></p>", f"<p><b>{s}<br>")))
        elif r < .7:
            head = rng.choice(("h2", "h2", "h3", "h3", "h4"))
            body.append(f"<{head}>{s}</{head}>")
        elif r < .78:
            tag = rng.choice(("ul", "ol"))
            body.append(f"<{tag}><li>{s}</li><li>{keep(prose())}</li></{tag}>")
        elif r < .84:
            body.append(f"<blockquote>{s}</blockquote>")
        elif r < .88:
            body.append(f"<pre>{s}</pre>")
        elif r < .92:
            body.append(f"<table><tr><td>{s}</td><td>{keep(words(1, 4))}</td></tr></table>")
        elif r < .96:
            body.append(f"<section><h3>{s}</h3><p>{keep(prose())}</p></section>")
        else:
            body.append(f"<div>{s}</div>")
    for piece in (ad, sidebar, notice, comments, form):
        if rng.random() < .12:
            body.insert(rng.randint(1, len(body)), piece())
    kind = rng.random()
    if kind < .55:
        article = f"<article{attr('post', 'story')}>{''.join(body)}</article>"
    elif kind < .75:
        article = f"<main>{''.join(body)}</main>"
    elif kind < .92:
        article = f"<div{must('content', 'article-body', 'post', 'entry-content', 'main')}>{''.join(body)}</div>"
    else:
        article = f"<div>{''.join(body)}</div>"
    if rng.random() < .25:
        article = f"<div{attr('wrapper', 'page')}>{article}</div>"
    tail = []
    for piece in (comments, sidebar, ad, notice, form):
        if rng.random() < .35:
            tail.append(piece())
    rng.shuffle(tail)
    if rng.random() < .85:
        tail.append(rng.choice((f"<footer>&copy; {words(2, 5)} &middot; {prose()}</footer>", f"<footer><p>{words(2, 9)}</p><ul>{links(3)}</ul></footer>",
                                f"<div{must('footer', 'legal', 'copyright')}>&copy; {words(2, 8)}</div>")))
    cut = rng.random() < .15
    return f"<!DOCTYPE html><html><head><title>{words(2, 6)}</title></head><body>{''.join(top)}{article}{''.join(tail)}" + (
        "" if cut else "</body></html>"), main


def train(pages: int = TRAIN_PAGES, seed: int = SEED) -> crf.Chain:
    """Fit the field on generated pages."""
    xs, ys = labelled_sequences(pages, seed)
    return crf.fit(xs, ys)


def labelled_sequences(pages: int, seed: int) -> tuple[list[list[list[str]]], list[list[int]]]:
    rng = random.Random(seed)
    xs, ys = [], []
    for _ in range(pages):
        page, main = _labelled(rng)
        blocks = leaf_blocks(page)
        xs.append(sequence(blocks))
        ys.append([int(t in main) for t, _ in blocks])
    return xs, ys


def main_text(page: str | None, model: crf.Chain) -> str:
    if not page:
        return ""
    blocks = leaf_blocks(page)
    return "\n".join(t for (t, _), v in zip(blocks, model.decode(sequence(blocks)), strict=True) if v)


def extract(pages: DataFrame, model: crf.Chain, keep: tuple[str, ...] = ("page_id", "url"), source: str = "html",
            out: str = "text") -> DataFrame:
    """The columns ``keep`` of every row and its main text."""
    keep = tuple(c for c in keep if c != out)
    rows = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(source).alias("_html"))
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                texts = [main_text(p.as_py(), model) for p in b.column(len(keep))]
                yield pa.record_batch([*b.columns[:len(keep)], pa.array(texts, pa.string())], names=[*keep, out])
    return rows.mapInArrow(each, f"{schema}, `{out}` string")
