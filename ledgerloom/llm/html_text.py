"""Main text of web pages: flat text blocks, classified by a small decision tree."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EXTRACTED = "page_id long, url string, text string, n_chars long"
FEATURES = [
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
    "boilerplate_ancestor", "article_ancestor", "heading",
]

# A quote counts behind an equals sign only, and a tag that is not closed runs to the page's end,
# so that no place is looked at twice.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>])*+)(?:>|\Z)|<[!?][^>]*+(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']++)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]++)))?")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "title", "textarea", "noscript", "template", "svg", "iframe", "select")}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"},
          "th": {"td", "th", "p"}, "option": {"option"}}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
STOPS = {"ul", "ol", "dl", "table", "nav", "div", "section", "article", "main", "aside", "footer", "header", "form", "body"}
BOILERPLATE_TAGS = {"nav", "aside", "footer", "form", "button", "dialog", "menu", "fieldset"}
BOILERPLATE_NAMES = set(
    "nav navbar navigation menu breadcrumb breadcrumbs masthead header footer sidebar aside widget ad ads adv advert adverts advertisement "
    "advertising sponsor sponsored sponsors promo promotion banner cookie cookies consent notice notices alert gdpr popup modal overlay "
    "newsletter subscribe subscription signup login form search comment comments disqus reply replies respond share sharing social "
    "related recommended recommendations trending toolbar pagination pager copyright legal skip contentinfo complementary hidden".split()
)
ARTICLE_NAMES = set("article content main post entry story".split())
# What an article inside is still part of; of other names an inner article or main is free.
SECONDARY_NAMES = set(
    "comment comments disqus reply replies respond related recommended recommendations trending sidebar aside widget ad ads adv advert "
    "adverts advertisement advertising sponsor sponsored sponsors promo promotion".split()
)
# Names that only say something about another part, such as has-sidebar.
ABOUT = set("has with without no not overflow".split())
# Names that open a compound on any subject, such as share-price, unless its last part is one of a page's fittings.
SUBJECTS = set("legal share sharing social search alert notice".split())
FITTINGS = BOILERPLATE_NAMES | set(
    "area bar block box button buttons container icon icons info item items link links list media message notes page panel post row section "
    "text this tools wrapper".split()
)


def boilerplate_names(tag: str, value: str, inside: bool) -> set[str]:
    """The boilerplate names in a class, id or role. An article's header is none, nor is a heading's."""
    out: set[str] = set()
    for token in value.split():
        parts = [p.lower() for p in PART.findall(token)]
        if not parts or parts[0] in ABOUT or parts[0] in SUBJECTS and parts[-1] not in FITTINGS:
            continue
        found = BOILERPLATE_NAMES.intersection(parts)
        if inside or tag in HEADINGS or ARTICLE_NAMES.intersection(parts):
            found -= {"header"}
        out |= found
    return out


@dataclass
class Block:
    """Text between two block boundaries."""

    text: str
    words: int
    linked: int
    boilerplate: bool
    article: bool
    heading: bool

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


@dataclass
class _Open:
    """The elements around the reader's place. `bad` counts those that are boilerplate, `free` those
    that stay so around an inner article."""

    names: list[str] = field(default_factory=list)
    bad: list[int] = field(default_factory=list)
    free: list[int] = field(default_factory=list)
    good: list[int] = field(default_factory=list)
    counts: Counter = field(default_factory=Counter)

    def push(self, tag: str, attributes: str) -> None:
        names: set[str] = set()
        articles = hidden = False
        inside = bool(self.good and self.good[-1])
        for name, *values in ATTRIBUTE.findall(attributes) if attributes else ():
            value = "".join(values)
            name = name.lower()
            if name in ("class", "id", "role"):
                names |= boilerplate_names(tag, value, inside)
                articles = articles or any(p.lower() in ARTICLE_NAMES for p in PART.findall(value))
            elif (
                name == "hidden" or name == "aria-hidden" and value.lower() == "true"
                or name == "style" and "display:none" in value.replace(" ", "").lower()
            ):
                hidden = True
        bad, free = self.bad[-1] if self.bad else 0, self.free[-1] if self.free else 0
        if tag in ("article", "main"):
            bad = free
        own = firm = False
        if tag == "article":
            own = firm = bool(names & {"comment", "comments", "reply"})
        elif tag not in ("html", "body", "main"):
            firm = hidden or tag in BOILERPLATE_TAGS or bool(names & SECONDARY_NAMES)
            own = firm or tag == "header" and not inside or bool(names)
        self.names.append(tag)
        self.counts[tag] += 1
        self.bad.append(bad + own)
        self.free.append(free + firm)
        self.good.append((self.good[-1] if self.good else 0) + (tag in ("article", "main") or articles))

    def cut(self, at: int) -> None:
        self.counts.subtract(self.names[at:])
        del self.names[at:], self.bad[at:], self.free[at:], self.good[at:]

    def pop(self, tag: str) -> None:
        """Closes `tag` and what is still open in it; a stray end tag closes nothing."""
        if self.counts[tag]:
            self.cut(len(self.names) - 1 - self.names[::-1].index(tag))

    def opening(self, tag: str) -> None:
        """Closes elements that `tag` ends without an end tag."""
        ends = CLOSES.get(tag) or (set() if tag in INLINE else {"p"})
        if not any(self.counts[name] for name in ends):
            return
        for at in range(len(self.names) - 1, -1, -1):
            name = self.names[at]
            if name in ends:
                self.cut(at)
            elif name in STOPS:
                break


def blocks(page: str) -> list[Block]:
    """The non-empty blocks in page order. Scripts, styles, comments and the title are none."""
    out: list[Block] = []
    around, parts, links = _Open(), [], 0
    anchor_parts: list[str] = []

    def flush() -> None:
        nonlocal links
        words = "".join(parts).split()
        if words:
            linked = len("".join(anchor_parts).split())
            out.append(Block(
                " ".join(words), len(words), min(linked, len(words)), bool(around.bad and around.bad[-1]),
                bool(around.good and around.good[-1]), bool(around.names and re.fullmatch(r"h[1-6]", around.names[-1])),
            ))
        parts.clear()
        anchor_parts.clear()

    def add(text: str) -> None:
        text = html.unescape(text) if "&" in text else text
        parts.append(text)
        if links:
            anchor_parts.append(text)

    at = 0
    while True:
        found = TOKEN.search(page, at)
        if not found:
            add(page[at:])
            break
        if found.start() > at:
            add(page[at : found.start()])
        at = found.end()
        closing, tag, attributes = found.groups()
        if at == len(page) and page[-1] != ">" and not page.startswith(("<!--", "<![CDATA["), found.start()):
            add(page[found.start() :])
            break
        if not tag:
            continue
        tag = tag.lower()
        if tag in RAW and not closing:
            end = RAW[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "a":
            links = max(0, links + (-1 if closing else 1))
            anchor_parts.append(" ")
        if tag == "br":
            parts.append(" ")
            anchor_parts.append(" ")
        if tag in INLINE:
            continue
        flush()
        links = 0
        if closing:
            around.pop(tag)
        else:
            around.opening(tag)
            if tag not in VOID and not attributes.endswith("/"):
                around.push(tag, attributes)
    flush()
    return out


def features(found: list[Block]) -> np.ndarray:
    """A row per block: its own shape, that of its neighbours, and where it stands."""
    words = np.array([b.words for b in found], float)
    density = np.array([b.density for b in found])
    own = np.array([(b.boilerplate, b.article, b.heading) for b in found], float).reshape(-1, 3)
    before = lambda x: np.concatenate(([0.0], x[:-1]))
    after = lambda x: np.concatenate((x[1:], [0.0]))
    return np.column_stack((words, density, before(words), before(density), after(words), after(density), own))


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 6, least: int = 2):
    """A decision tree: a label, or (feature, limit, tree up to the limit, tree above it).

    Each split has the least Gini impurity; of equal splits the later feature of FEATURES is
    taken, where the block stands before how long it is.
    """
    share = labels.mean() if len(labels) else 0.0
    if depth == 0 or share in (0.0, 1.0) or len(labels) < 2 * least:
        return int(share >= 0.5)
    best = None
    for column in range(rows.shape[1]):
        values = np.unique(rows[:, column])
        for limit in (values[1:] + values[:-1]) / 2:
            low = rows[:, column] <= limit
            a, b = labels[low], labels[~low]
            if min(len(a), len(b)) < least:
                continue
            cost = sum(len(x) * x.mean() * (1 - x.mean()) for x in (a, b))
            if best is None or cost <= best[0] + 1e-12:
                best = (cost, column, limit, low)
    if best is None:
        return int(share >= 0.5)
    _, column, limit, low = best
    return column, float(limit), grow(rows[low], labels[low], depth - 1, least), grow(rows[~low], labels[~low], depth - 1, least)


def decide(tree, row) -> int:
    while not isinstance(tree, int):
        column, limit, low, high = tree
        tree = low if row[column] <= limit else high
    return tree


LONG = "The river rose through the night and by morning the lower fields had gone under water again, as they had most springs that anyone could remember."
MID = "Nobody was hurt, and the bridge has since been opened again."

# The labelled table: pages in small, each with the label of its blocks in page order
# (1: main text). Long runs of text stand in for paragraphs.
LABELLED = [
    (f"<nav><a>Home</a><a>News</a></nav><article><h1>Flood</h1><p>{LONG}</p><p>So it is.</p><p>{LONG}</p></article><footer>Imprint</footer>", "011110"),
    (f"<div class=ad>Buy now, cheap and fast.</div><article><h1>Rise</h1><p>Yes.</p><p>{MID}</p></article><footer>{MID}</footer>", "01110"),
    (f"<article><p>{LONG}</p><aside>{MID}</aside><p>See <a>the earlier report</a>.</p><ul><li><a>Part one</a></li><li>Part two</li></ul></article>", "10111"),
    (f"<header>Daily Paper</header><main><h1>On maps</h1><p>{MID}</p><form>Your name <label>Mail</label></form></main>", "0110"),
    (f"<article><h2>Why</h2><p>No.</p></article><div class=comments><p>{LONG}</p><p>{MID}</p></div>", "1100"),
    (f"<div id=cookie-notice>{LONG}</div><article><p>{MID}</p><p><a>All of it is linked</a></p></article>", "011"),
    (f"<div><p>{LONG}</p><p>{LONG}</p><p>Short line.</p><p>{LONG}</p></div>", "1111"),
    (f"<div><a>Home</a></div><div><a>Sport</a> <a>Weather</a></div><div><p>{LONG}</p><p>{LONG}</p></div><div><a>Privacy</a></div><div>Contact</div>", "001100"),
    (f"<h1>Harvest</h1><p>{LONG}</p><p>{MID}</p><p>{LONG}</p><div><a>More stories from this part of the country</a></div>", "11110"),
    ("<div>Login</div><div><a>Join</a></div><div><a>Help</a></div><div>Terms</div>", "0000"),
    (f"<ul><li><a>One</a></li><li><a>Two</a></li><li><a>Three</a></li></ul><p>{LONG}</p><p>{LONG}</p><p>(c) 2020</p>", "000110"),
    (f"<div class=sidebar><p>{LONG}</p><h3>Tags</h3><p>{MID}</p></div><div class=content><h1>Wells</h1><p>{MID}</p><p>Dry.</p></div>", "000111"),
    (f"<article><p>{LONG}</p><div class=share>Share this</div><footer>{MID}</footer></article><aside><p>{LONG}</p></aside>", "1000"),
]


def trained(labelled=LABELLED):
    rows, labels = [], []
    for page, marks in labelled:
        found = blocks(page)
        if len(found) != len(marks):
            raise ValueError(f"{len(found)} blocks but {len(marks)} labels: {page}")
        rows.append(features(found))
        labels += [int(m) for m in marks]
    return grow(np.concatenate(rows), np.array(labels))


def main_text(page: str, tree) -> str:
    found = blocks(page)
    if not found:
        return ""
    return " ".join(b.text for b, row in zip(found, features(found), strict=True) if decide(tree, row))


def _extract(tree):
    def run(frames):
        for frame in frames:
            out = frame[["page_id", "url"]].copy()
            out["text"] = [main_text(page, tree) for page in frame.html]
            out["n_chars"] = out.text.str.len().astype("int64")
            yield out

    return run


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    A page is cut at its block elements. A block is described by its number of words and its
    share of linked words, by those of its neighbours, and by the elements around it; a
    decision tree trained on a small labelled table says whether it is main text. Character
    references are decoded, white space in a block becomes one space, blocks are joined by
    one space. A scan without a shuffle.

    An article or main element inside is free of what class, id and role names of outer
    elements say, unless these name comments, related pieces, sidebars or adverts. A page of
    any length is read once from left to right; a tag that is never closed is text.

    Null or empty html, or no main text: empty text. Null id: left out. Null url: null.
    Repeated rows: a row each. Unclosed elements end with the element around them or the
    page. No pages: no rows.
    """
    read = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"),
    ).where("page_id IS NOT NULL")
    return read.mapInPandas(_extract(trained()), EXTRACTED)
