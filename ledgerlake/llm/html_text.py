"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into blocks of text at its block-level tags. A block has features:
its words and the share of them inside links, the same of the blocks before and
after it, and what the nearest telling tag around it says (a part of the page
that is an article, one that is not, or nothing). A tag speaks by its name and by
the words of its class, id and role; where they disagree the article wins, words
like "no-sidebar" or "with-sidebar" say nothing, nor do names on the page's body. A decision tree decides which
blocks are main text. The tree is grown once, on the driver, from the small
labelled table of this module: invented pages whose main blocks are numbered.

Defined results: null html counts as empty; a page without main text gives an
empty text; broken markup is read as far as it goes; character references are
decoded, also those without a semicolon where HTML allows it; repeated rows get
equal results; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import in_tasks, small_slices

# --- blocks ---

# Elements whose content is never text: up to their end tag or that of the page, or only where they have an end tag.
# A head needs no care of its own: what it holds is silent, and it ends wherever text begins.
SILENT = ("script", "style", "noscript", "iframe", "title", "textarea")
CLOSED = ("template", "svg", "object", "canvas", "select")
# Elements that part blocks.
PARTING = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th"
    " thead tr ul".split()
)
# Elements that can say what a part of the page is; only these are followed while they are open.
HOLDING = frozenset("article aside blockquote body button details dialog div fieldset figure footer form header main menu nav"
                    " ol section table td ul".split())
AWAY = frozenset("aside button dialog footer form header menu nav".split())
HOME = frozenset(("article", "main"))
_AWAY_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|form|gdpr|header|login|masthead|"
    r"menu|modal|nav\w*|newsletter|notices?|overlay|pagination|popup|promo\w*|recommend\w*|related|replies|reply|search|share|sharing|"
    r"sidebar|signup|skip|social|sponsor\w*|subscribe|tags?|toc|toolbar|widget)(?:$|[\s_-])"
)
_HOME_NAME = re.compile(r"(?:^|[\s_-])(?:article|content|entry|main|post|prose|story)(?:$|[\s_-])")
# Names that tell what a page has or lacks elsewhere, and those of an article's own heading.
_NO_NAME = re.compile(r"(?:no|not|with|without|has|hide|hides|show|shows|is)[_-]\S*|\S*[_-](?:open|closed|hidden|visible|left|right)")
_HEADING_NAME = re.compile(r"(?:article|content|entry|main|post|story)[_-]+header|header[_-]+(?:article|content|entry|main|post|story)")
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)"
    r"|<(?P<silent>" + "|".join(SILENT) + r")\b[^>]*>.*?(?:</(?P=silent)\s*>|$)"
    r"|<(?P<closed>" + "|".join(CLOSED) + r")\b[^>]*>.*?</(?P=closed)\s*>"
    # A quotation mark opens a value only behind an equals sign.
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>=]|=(?:\s*\"[^\"]*\"|\s*'[^']*')?)*)(?:>|$)|<[!?/][^>]*(?:>|$)",
    re.S | re.I,
)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_BLANKS = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    part: int  # 1 in an article, -1 in something else, 0 unknown

    @property
    def link_density(self) -> float:
        return self.linked / self.words if self.words else 0.0


def part_of(name: str, rest: str, around: int) -> int | None:
    """What a tag says about its content; None if it says nothing."""
    named = " ".join(a or b or c for a, b, c in _NAMED.findall(rest)).lower() if "=" in rest else ""
    if name == "body":
        named = ""
    words = [w for w in named.split() if not _NO_NAME.fullmatch(w)]
    headings = [w for w in words if _HEADING_NAME.fullmatch(w)]
    words = [w for w in words if w not in headings]
    away = any(map(_AWAY_NAME.search, words))
    home = any(_HOME_NAME.search(w) and not _AWAY_NAME.search(w) for w in words)
    if name in HOME or (home and name not in AWAY):
        return 1
    if away:
        return -1
    if around == 1 and (name == "header" or (headings and name not in AWAY)):
        return None  # the heading of an article
    return -1 if name in AWAY else None


def blocks(page: str | None) -> list[Block]:
    page = page or ""
    out: list[Block] = []
    pieces: list[tuple[str, bool]] = []
    open_tags: list[tuple[str, int]] = []
    links = 0

    def close_block() -> None:
        text = html.unescape("".join(p for p, _ in pieces))
        text = _BLANKS.sub(" ", text).strip()
        if text:
            linked = sum(len(html.unescape(p).split()) for p, in_link in pieces if in_link)
            out.append(Block(text, len(text.split()), linked, open_tags[-1][1] if open_tags else 0))
        pieces.clear()

    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            pieces.append((page[at : token.start()], links > 0))
        at = token.end()
        name = (token["name"] or "").lower()
        if not name:
            continue
        closing = bool(token["close"])
        if name == "a":
            links = 0 if closing else 1
        elif name == "br":
            pieces.append((" ", False))
        elif name in PARTING:
            close_block()
            links = 0
            if name in HOLDING:
                if not closing:
                    around = open_tags[-1][1] if open_tags else 0
                    said = part_of(name, token["rest"], around)
                    # Inside a part that is no article, only a tag of its own kind could say otherwise.
                    open_tags.append((name, around if said is None else said))
                elif any(n == name for n, _ in open_tags):
                    while open_tags.pop()[0] != name:
                        pass
    if at < len(page):
        pieces.append((page[at:], links > 0))
    close_block()
    return out


def features(found: list[Block]) -> np.ndarray:
    """part, words, link density, then words and link density of the block before and the block after."""
    words = np.array([0, *(b.words for b in found), 0], dtype=float)
    density = np.array([0, *(b.link_density for b in found), 0], dtype=float)
    part = np.array([b.part for b in found], dtype=float)
    return np.column_stack([part, words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:]])


# --- the labelled table and the tree ---

_S = "Rain fell on the harbour all morning and the boats stayed in."
_L = f"{_S} The men mended nets in the long shed, and nobody spoke much until the kettle had boiled."
# (page, numbers of its main blocks)
LABELLED = (
    (
        "<nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></nav><div class=ad>Buy two lamps and get one for free today.</div>"
        f"<article><h1>Harbour</h1><p>{_L}</p><p>{_S}</p><p>Yes.</p></article><footer>&copy; Harbour Post &middot; all about boats.</footer>",
        {3, 4, 5, 6},
    ),
    (
        f"<header><a href=/>The Post</a> since long ago</header><main><h1>Nets</h1><p>{_L}</p><p>{_S} <a href=/k>Kettles</a> are sold here.</p>"
        "<p><a href=/x>Further reading</a></p></main><aside><h3>Most read</h3><p>The storm of the year, and what it left behind on the beach.</p></aside>",
        {1, 2, 3, 4},
    ),
    (
        f"<div id=cookie-notice>We use cookies to make this site work better for you.</div><article><h2>Old ships</h2><p>{_S}</p>"
        f"<div class=ad>Cheap rope, sold by the yard.</div><p>{_L}</p><section class=comments><p>Great piece, thank you for it.</p><p>{_L}</p>"
        "</section></article><form><p>Your mail address</p><button>Send</button></form>",
        {1, 2, 4},
    ),
    (
        f"<div><a href=/>Home</a> <a href=/a>About</a> <a href=/c>Contact</a></div><div><p>{_L}</p><p>{_L}</p><p>{_S}</p></div>"
        "<div><a href=/p>Privacy</a> <a href=/t>Terms</a></div><div>Printed in town</div>",
        {1, 2, 3},
    ),
    (
        f"<table><tr><td><a href=/>Start</a></td><td><p>{_L}</p><p>{_S}</p><p>{_L}</p></td></tr></table><p>Ask us</p><p><a href=/m>Map</a></p>",
        {1, 2, 3},
    ),
    (
        f"<div class=sidebar><p>{_S}</p><p>{_L}</p></div><div class=content><p>No.</p><p>{_S}</p><ul><li>Rope</li><li>Tar</li></ul></div>"
        f"<div class=related><a href=/r>The other harbour, and why it was closed</a></div><footer><p>{_L}</p></footer>",
        {2, 3, 4, 5},
    ),
    ("<ul><li><a href=/1>One</a></li><li><a href=/2>Two</a></li></ul><p>Page not found</p><p><a href=/>Back</a></p>", set()),
    (f"<p>{_L}</p><p>{_L}</p><p>{_L}</p>", {0, 1, 2}),
    # Without telling tags: short blocks between long ones are text, long blocks of links are not.
    (
        f"<p>{_L}</p><p>Nobody came.</p><p>{_L}</p><p>{_S}</p><p>And then?</p><p>{_S}</p><p><a href=/q>{_L}</a></p>"
        f"<p><a href=/v>{_S}</a></p><p>Printed in town</p>",
        {0, 1, 2, 3, 4, 5},
    ),
    (
        f"<div><a href=/1>{_S}</a></div><div><a href=/2>{_S}</a></div><div>Top stories</div><div><a href=/3>{_L}</a></div>"
        f"<div>Page 3</div><div>{_L}</div><div>Only the gulls.</div><div>{_L}</div><div>Back to top</div>",
        {5, 6, 7},
    ),
    # A head without its end, names that say nothing about their element, an article's heading of its own.
    (
        f"<html><head><title>Nets</title><meta name=a content=b><body class='nav-open no-sidebar'><div class='content no-sidebar'><p>{_S}</p><p>{_L}</p></div>"
        f"<div class=sidebar><p>{_L}</p></div></body>",
        {0, 1},
    ),
    (
        f"<main class='with-sidebar'><div class='post-header'><h1>Kettles</h1></div><p>{_L}</p><div class='post-comments'><p>{_S}</p></div></main>"
        f"<div class='widget'><p>{_S}</p></div>",
        {0, 1},
    ),
    (
        f"<p>Menu</p><p>Search</p><p>{_S} See <a href=/s>ships</a>.</p><p>It was late.</p><p>{_L}</p><p>Share</p><p>Print</p>",
        {2, 3, 4},
    ),
)


@dataclass
class Tree:
    """A decision tree: inner nodes have a feature and a limit, leaves the answer."""

    answer: bool
    feature: int = -1
    limit: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def decide(self, rows: np.ndarray) -> np.ndarray:
        if self.feature < 0 or not len(rows):
            return np.full(len(rows), self.answer)
        out = np.empty(len(rows), dtype=bool)
        under = rows[:, self.feature] <= self.limit
        out[under] = self.low.decide(rows[under])
        out[~under] = self.high.decide(rows[~under])
        return out


def gini(labels: np.ndarray) -> float:
    share = labels.mean() if len(labels) else 0.0
    return len(labels) * share * (1 - share)


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 8) -> Tree:
    """Split where the Gini impurity falls most; of equal splits the first feature wins."""
    tree = Tree(bool(labels.mean() >= 0.5) if len(labels) else False)
    best = gini(labels) - 1e-9
    if depth == 0 or best <= 0:
        return tree
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for limit in (values[1:] + values[:-1]) / 2:
            under = rows[:, feature] <= limit
            impurity = gini(labels[under]) + gini(labels[~under])
            if impurity < best - 1e-9:
                best, tree.feature, tree.limit = impurity, feature, float(limit)
    if tree.feature >= 0:
        under = rows[:, tree.feature] <= tree.limit
        tree.low = grow(rows[under], labels[under], depth - 1)
        tree.high = grow(rows[~under], labels[~under], depth - 1)
    return tree


def train(labelled=LABELLED) -> Tree:
    rows, labels = [], []
    for page, main in labelled:
        found = blocks(page)
        rows.append(features(found))
        labels.append(np.array([k in main for k in range(len(found))]))
    return grow(np.concatenate(rows), np.concatenate(labels))


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks(page)
    if not found:
        return ""
    return "\n\n".join(b.text for b, keep in zip(found, tree.decide(features(found))) if keep)


def extract(pages: DataFrame, html_col: str = "html", carry: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """One row per row: the carried columns as a struct ``row``, and ``text``."""
    tree = train()
    narrow = pages.select(F.struct(*carry).alias("row"), F.col(html_col).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small_slices(batches):
            texts = [main_text(page, tree) for page in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["row", "text"])

    return in_tasks(narrow, run, narrow.select("row", F.lit("").alias("text")).schema)
