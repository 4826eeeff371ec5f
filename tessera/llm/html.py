"""Main text of web pages by a linear-chain CRF over DOM leaf blocks.

A page is read into leaf blocks: runs of text between the bounds of block-level
elements, each with its open ancestors. A chain over two labels, main and
other, scores each block by its ancestors' tags and names (class, id, role) and
by features of its text; it is trained on labelled pages and decoded by Viterbi.

The labelled pages are made here by rule (``labelled_pages``): articles of
random prose in many layouts, with menus, notices, adverts, sidebars, forms,
comments and footers under the names that pages use for them, some of them
hidden. Their number is a parameter; they are fixed by a seed, so the model is
the same each time.

Only what is no text is left out before the model sees it: scripts, styles,
heads, comments, and embedded objects, drawings and media with their fallbacks.

Defined results: a null page is empty and has an empty text, as has a page of
which no block is main; broken mark-up is read as far as it goes, with open
elements closed where a parent ends, an embedded element without end tag taken
for its start tag alone, and a quote that is never closed ended with its tag;
repeated rows return repeated rows; an empty table returns no rows. Other
columns are not read.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.crf import Bag, Chain

#: Element names by their part in a page (fixed values).
BLOCKS = frozenset("address article aside blockquote body br button center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav ol optgroup option p pre section select summary table tbody td textarea tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template svg iframe object canvas audio video head".split())
CLOSES_P = BLOCKS - {"br", "button", "option", "optgroup"}

VALUE = r"""(?:"(?:[^"]*"|[^">]*)|'(?:[^']*'|[^'>]*)|[^\s>"'][^\s>]*)"""
TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[(?P<cdata>.*?)\]\]>|<[!?][^>]*>?|<(?P<end>/?)(?P<tag>[A-Za-z][A-Za-z0-9:-]*)"
    rf"(?P<attrs>(?:[\s/]+|[^\s>/=][^\s>/=]*+(?:\s*=\s*{VALUE})?|=)*+)>",
    re.S,
)
#: The same where no CDATA section ends any more.
TOKEN_AFTER = re.compile(TOKEN.pattern.replace(r"<!\[CDATA\[(?P<cdata>.*?)\]\]>", "(?P<cdata>(?!))"), re.S)
OPENS = re.compile("<[!?]")
ATTRIBUTE = re.compile(rf"([^\s>/=]+)(?:\s*=\s*({VALUE}))?")
NAMED = frozenset("class id role itemprop".split())
HIDES = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
HIDDEN = "hidden!"
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
MAIN, OTHER = "main", "other"
FEATURES = 1 << 15
PAGES_AT_ONCE = 400


class Element:
    """An open block-level element, its names, and the features that it and its
    ancestors give to all below: made once, each of them once, so that a block
    costs as many as there are different ones, however deep it lies."""

    __slots__ = ("tag", "names", "parent", "own", "_below")

    def __init__(self, tag: str, names: tuple[str, ...], parent: Element | None):
        self.tag, self.names, self.parent, self._below = tag, names, parent, None
        self.own = [x for name in names for x in (f"name={name}", f"name:{name[:5]}")]

    @property
    def below(self) -> list[str]:
        chain, e = [], self
        while e is not None and e._below is None:
            chain.append(e)
            e = e.parent
        above = e._below if e is not None else []
        for e in reversed(chain):
            f = [f"under={e.tag}", *e.own]
            e._below = above = above if f == above[: len(f)] else list(dict.fromkeys([*f, *above]))
        return above


class Block:
    __slots__ = ("text", "element", "linked")

    def __init__(self, text: str, element: Element | None, linked: int):
        self.text, self.element, self.linked = text, element, linked

    @property
    def tag(self) -> str:
        return self.element.tag if self.element else ""


def leaf_blocks(html: str) -> list[Block]:
    """The page's leaf blocks in order, references decoded, white space single."""
    blocks: list[Block] = []
    stack: list[Element] = []  # open block-level elements
    opened: Counter[str] = Counter()
    run: list[str] = []
    links = linked = 0
    at, n = 0, len(html)
    # behind the last > nothing is a tag, and behind the last ]]> nothing a CDATA section: not looked for again and again
    last, last_cdata = html.rfind(">") + 1, html.rfind("]]>")
    endless: set[str] = set()  # embedded elements that no end tag follows for any more

    def close() -> None:
        nonlocal linked
        if run:
            text = " ".join(unescape("".join(run)).split())
            if text:
                blocks.append(Block(text, stack[-1] if stack else None, linked))
            run.clear()
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        if piece:
            run.append(piece)
            if links:
                linked += len(piece)

    def drop() -> None:
        opened[stack.pop().tag] -= 1

    while m := (TOKEN if at <= last_cdata else TOKEN_AFTER).search(html, at, last):
        add(html[at : m.start()])
        at = m.end()
        if at == last and html.startswith("<!--", m.start()) and not html.endswith("-->", m.start(), at):
            at = n  # a comment that is never closed
            break
        if m["cdata"] is not None:
            add(m["cdata"])
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if m["end"]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in BLOCKS:
                close()
                if opened[tag]:
                    while stack[-1].tag != tag:
                        drop()
                    drop()
                    links = 0
            continue
        attrs = m["attrs"]
        if tag in SKIPPED:
            if not attrs.endswith("/") and tag not in endless:
                end = _end_of(html, tag, at, n)
                if end == at:
                    endless.add(tag)
                at = end
            if tag not in ("script", "style", "noscript", "template"):
                close()
            continue
        if tag == "a":
            links += 1
        elif tag in BLOCKS:
            close()
            if tag in CLOSES_P and stack and stack[-1].tag == "p":
                drop()
            if tag in ("li", "option", "tr", "td", "th", "dd", "dt") and stack and stack[-1].tag == tag:
                drop()
            if tag not in VOID and not attrs.endswith("/"):
                stack.append(Element(tag, _names(attrs) if attrs else (), stack[-1] if stack else None))
                opened[tag] += 1
    tail = OPENS.search(html, max(at, last))
    add(html[at : tail.start() if tail else n])
    close()
    return blocks


def _names(attrs: str) -> tuple[str, ...]:
    """The parts of what an element is called, and whether it is hidden."""
    out = []
    for a in ATTRIBUTE.finditer(attrs):
        name, value = a[1].lower(), a[2] or ""
        if name in NAMED:
            out += [x.lower() for x in PARTS.findall(value)]
        elif name == "hidden" or name == "style" and HIDES.search(value):
            out.append(HIDDEN)
    return tuple(out)


def _end_of(html: str, tag: str, at: int, n: int) -> int:
    """Behind the end tag of an element whose start tag ends at ``at``; ``at``
    itself if it has none."""
    if tag in ("script", "style"):
        m = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
        return m.end() if m else n
    depth, last = 1, at
    for m in re.compile(rf"<!--.*?(?:-->|$)|<(/?){tag}\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>", re.I | re.S).finditer(html, at):
        if m[1] is None:
            continue
        depth += -1 if m[1] else 1
        last = m.end() if m[1] else last
        if not depth:
            return last
        if tag == "head" and not m[1]:
            break
    if tag == "head":  # a head without end goes on to the body
        m = re.compile(r"<body\b|<(?:div|p|article|main|header|h1)\b", re.I).search(html, at)
        return m.start() if m else n
    return last


@lru_cache(maxsize=1 << 16)
def _bucket(name: str) -> int:
    return zlib.crc32(name.encode()) % FEATURES


def _features(blocks: list[Block]) -> list[list[int]]:
    out = []
    for i, b in enumerate(blocks):
        size = len(b.text)
        f = ["bias", f"tag={b.tag}", f"long={min(9, size.bit_length())}", f"links={4 * b.linked // max(1, size)}"]
        f += [f"stops={min(3, b.text.count('. ') + b.text.endswith('.'))}", f"commas={min(2, b.text.count(','))}", f"at={min(4, 5 * i // len(blocks))}"]
        f += [f"sign={s}" for s in ("©", "|", "»", "→", "@", "http") if s in b.text]
        if b.text[:1].isdigit():
            f.append("digit first")
        e = b.element
        for depth in range(2):
            if e is not None:
                f += [f"under={e.tag}", f"up{depth}={e.tag}", *e.own]
                e = e.parent
        if e is not None:
            f += e.below
        out.append([_bucket(x) for x in dict.fromkeys(f)])
    return out


def _bag(pages: list[list[Block]]) -> Bag:
    rows = [f for p in pages for f in _features(p)]
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    return Bag(np.fromiter((x for r in rows for x in r), np.int64, int(sizes.sum())), np.cumsum(sizes) - sizes)


#: What pages call their parts (fixed values).
NAMES_OF = {
    "nav": "nav navbar navigation menu main-menu site-nav breadcrumb breadcrumbs topbar tabs toc pagination pager skip-link",
    "header": "header site-header masthead page-header top branding logo banner-top",
    "footer": "footer site-footer page-footer bottom colophon copyright legal imprint credits",
    "side": "sidebar side aside widget widgets related related-posts recommended more-stories trending popular rail secondary tags teaser",
    "notice": "cookie cookie-banner consent notice gdpr alert popup modal overlay disclaimer privacy-banner paywall message toast",
    "ad": "ad ads advert advertisement sponsored sponsor promo promotion banner commercial dfp adbox outbrain",
    "form": "form search search-form login signup subscribe newsletter newsletter-form contact-form register",
    "social": "share sharing social social-links follow buttons toolbar print",
    "comments": "comments comment comment-list discussion replies reply disqus responses user-comments thread reader-comments",
}
ARTICLE_NAMES = "article post entry content story main text body article-body entry-content post-content story-body main-content single blog-post page-content".split()
PLAIN_NAMES = "wrapper container row col inner page site grid box layout block outer section".split()


def labelled_pages(n: int, seed: int = 17, half: int | None = None) -> list[list[tuple[Block, int]]]:
    """n pages as blocks with label (1: main), made by rule from a seed. half: 0
    or 1, to call parts by every second name only."""
    rng = random.Random(seed)
    called = lambda names: [x for i, x in enumerate(names) if half is None or i % 2 == half]
    syllables = [a + b for a in "b d f g k l m n p r s t v w th ch".split() for b in "a e i o u an er on is".split()]

    def prose(least: int, most: int) -> str:
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(least, most))]
        for i in range(len(words) - 1):
            if rng.random() < 0.12:
                words[i] += rng.choice([".", ".", ",", ";", "?"])
        return " ".join(words).capitalize() + rng.choice([".", ".", ".", ""])

    def label(kind: str) -> str:
        names = rng.choice(called(NAMES_OF[kind].split()))
        if rng.random() < 0.3:
            names = rng.choice(["js-", "c-", "site-", "block-", ""]) + names + rng.choice(["", "-wrap", "-1", " box", "__inner"])
        return f'{rng.choice(["class", "class", "id"])}="{names}"'

    def item(text: str) -> str:
        return f'<a href="/{rng.randint(1, 999)}">{text}</a>'

    def other(kind: str) -> str:
        tag = {"nav": "nav", "header": "header", "footer": "footer", "side": "aside", "form": "form", "comments": "section"}.get(kind, "div")
        attrs = label(kind)
        if rng.random() < 0.5 and kind != "form":
            tag = rng.choice(["div", "section", "ul" if kind == "nav" else "div"])
        elif rng.random() < 0.4:
            attrs = ""
            if tag in ("div", "section"):
                attrs = label(kind)
        if kind == "nav":
            inner = "".join(f"<li>{item(prose(1, 3))}</li>" for _ in range(rng.randint(2, 8)))
            inner = inner if tag == "ul" else f"<ul>{inner}</ul>"
        elif kind == "side":
            inner = f"<h3>{prose(1, 4)}</h3>" + "".join(rng.choice([f"<p>{prose(3, 40)}</p>", f"<li>{item(prose(2, 9))}</li>"]) for _ in range(rng.randint(1, 5)))
        elif kind == "form":
            inner = f"<label>{prose(1, 3)}</label><input name=q><p>{prose(2, 20)}</p><button>{prose(1, 2)}</button><select><option>{prose(1, 2)}</option></select>"
        elif kind == "comments":
            inner = f"<h3>{prose(1, 3)}</h3>" + "".join(f'<div class="{rng.choice(["comment", "reply", "item", "c"])}"><b>{prose(1, 2)}</b><p>{prose(2, 60)}</p></div>' for _ in range(rng.randint(1, 5)))
        elif kind == "footer":
            inner = rng.choice([f"&copy; {prose(1, 4)} &middot; {prose(3, 15)}", f"<p>{prose(2, 12)}</p>{item(prose(1, 2))} | {item(prose(1, 2))}", f"<p>© {rng.randint(1999, 2026)} {prose(2, 9)}</p>"])
        elif kind == "header":
            inner = rng.choice([f"<h1>{prose(1, 4)}</h1>", f"<p>{prose(1, 8)}</p>", item(prose(1, 3))])
        else:
            inner = rng.choice([f"<p>{prose(3, 40)}</p>", prose(2, 25), f"{prose(2, 12)} {item(prose(1, 2))}"])
        if rng.random() < 0.08:
            attrs += rng.choice([" hidden", ' style="display:none"', ' hidden=""'])
        return f"<{tag} {attrs}>\x01{inner}\x02</{tag}>"

    def article() -> str:
        parts = [f"<h1>{prose(2, 12)}</h1>"] if rng.random() < 0.85 else []
        for _ in range(rng.randint(1, 14)):
            r = rng.random()
            if r < 0.72:
                parts.append(f"<p>{prose(1, rng.choice([4, 30, 120]))}" + "</p>" * (rng.random() < 0.9))
            elif r < 0.78:
                parts.append(f"<p><b>{prose(2, 40)}<br>")
            elif r < 0.84:
                parts.append(f"<h{rng.randint(2, 4)}>{prose(1, 7)}</h2>")
            elif r < 0.9:
                parts.append("<ul>" + "".join(f"<li>{prose(1, 14)}</li>" for _ in range(rng.randint(1, 5))) + "</ul>")
            elif r < 0.94:
                parts.append(f"<blockquote>{prose(3, 30)}</blockquote>")
            elif r < 0.97:
                parts.append(f"<pre>{prose(3, 30)}</pre>")
            else:
                parts.append(f"<table><tr><td>{prose(1, 5)}</td><td>{prose(1, 5)}</td></tr></table>")
            if rng.random() < 0.06:
                parts.append(other(rng.choice(["ad", "notice", "social", "side", "form"])))
        return "".join(parts)

    def page() -> str:
        before = [other(k) for k in rng.sample(["nav", "header", "notice", "ad", "form", "side"], rng.randint(1, 4))]
        after = [other(k) for k in rng.sample(["comments", "side", "ad", "form", "social", "footer", "nav"], rng.randint(1, 4))]
        r = rng.random()
        body = article()
        if r < 0.5:
            if rng.random() < 0.15:
                body += other("comments")
            body = f"<article>{body}</article>"
        elif r < 0.65:
            body = f"<main>{body}</main>"
        elif r < 0.9:
            body = f'<div {rng.choice(["class", "id"])}="{rng.choice(called(ARTICLE_NAMES))}">{body}</div>'
        if rng.random() < 0.4:
            body = f'<div class="{rng.choice(called(PLAIN_NAMES))}">{body}</div>'
        whole = "".join([*before, body, *after])
        if rng.random() < 0.3:
            whole = f'<div class="{rng.choice(called(PLAIN_NAMES))}">{whole}</div>'
        return f"<html><head><title>{prose(2, 8)}</title></head><body>{whole}</body></html>"

    out = []
    for _ in range(n):
        depth, rows = 0, []
        for b in leaf_blocks(page()):
            # marks inside the text tell where a part that isn't main begins and ends
            inside = depth > 0 or "\x01" in b.text
            depth += b.text.count("\x01") - b.text.count("\x02")
            b.text = b.text.replace("\x01", "").replace("\x02", "").strip()
            if b.text:
                rows.append((b, int(not inside)))
        if rows:
            out.append(rows)
    return out


def fitted(data: list[list[tuple[Block, int]]], rounds: int = 60) -> Chain:
    bag = _bag([[b for b, _ in p] for p in data])
    gold = np.array([y for p in data for _, y in p])
    lens = np.array([len(p) for p in data])
    return Chain.new([OTHER, MAIN], FEATURES).fit([bag], np.arange(len(gold)), gold, lens, rounds)


@lru_cache(maxsize=1)
def trained(pages: int = 700) -> Chain:
    return fitted(labelled_pages(pages))


def label_pages(chain: Chain, pages: list[list[Block]]) -> list[np.ndarray]:
    """For each page which of its blocks are main."""
    lens = np.array([len(p) for p in pages], dtype=np.int64)
    if not lens.sum():
        return [np.zeros(0, bool) for _ in pages]
    full = np.flatnonzero(lens)
    best = chain.viterbi(chain.emissions([_bag([pages[i] for i in full])]), lens[full]).astype(bool)
    out = [np.zeros(0, bool) for _ in pages]
    for i, part in zip(full, np.split(best, np.cumsum(lens[full])[:-1])):
        out[i] = part
    return out


def extract(pages: DataFrame, chain: Chain | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_blocks, n_main of every page."""
    model = chain or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, PAGES_AT_ONCE):
                b = whole.slice(at, PAGES_AT_ONCE)
                read = [leaf_blocks(h.as_py() or "") for h in b.column(2)]
                main = label_pages(model, read)
                texts = [" ".join(x.text for x, y in zip(p, m) if y) for p, m in zip(read, main)]
                counts = [pa.array([len(p) for p in read], pa.int64()), pa.array([int(m.sum()) for m in main], pa.int64())]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), *counts], ["page_id", "url", "text", "n_blocks", "n_main"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_blocks long, n_main long")
