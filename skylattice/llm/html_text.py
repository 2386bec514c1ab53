"""Main text of web pages by tag-path ratios.

A page is read as a sequence of text blocks, each with the path of block elements
from the root to it (a tag with its class, id and role words). For every path the letters
outside links and the punctuation marks are summed and divided by the number of
blocks. Both ratios are smoothed along the page and fused into one score, together with
what the elements on the path say about themselves: an article speaks for, a name such as
``left-sidebar`` against, and one such as ``post-comments`` strongly against. Paths that reach
a share of the page's best score are selected; the article around them, or else the element
around them, is the content. Inside it the paths are held against a second, low threshold on
the same score, in which only names inside the content count: headings and short lines pass,
runs of links, adverts, comments and footers do not.

Names count by all words of a token, ``js-ad-slot`` and ``userComments`` included. They do not
count in a token that only states a layout or a class of its article (``no-sidebar``,
``category-social``, ``content-sidebar-wrap``), inside a word of an article's own name beyond
the first, or on an element around nearly all of the page's text unless they are strong; and
never on the elements around the content. So a page that has nothing else gives what it has.

Pages are independent, so there is no shuffle. Time and memory grow in proportion to the page,
whatever its markup: paths are pairs of a parent and a label, and no tag is looked for twice.

Defined results: null html is empty and gives an empty text with 0 code points; a page
without any text likewise. Broken markup is read leniently: unclosed elements end with
their parent, unknown end tags are ignored, a tag that never ends takes the rest of the page,
and from a quote on that never closes, tags end at the next ``>``. White space is what
Python's ``str.split`` takes for it. Repeated rows give repeated rows. Other columns are not
looked at.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skylattice.llm.common import text_pieces

#: A path is selected if its fused score reaches this share of the page's best.
THRESHOLD = 0.25
#: A path inside the content stays if its score reaches this share of the best there.
INNER_THRESHOLD = 0.01
#: Weights of a block's own and its neighbours' ratios.
SMOOTHING = (0.06, 0.24, 0.4, 0.24, 0.06)
#: What an article or main element speaks for its content.
WEIGHTS = {"": 1.0, "main": 2.0, "article": 4.0}
#: What a name takes from the score of what is in its element: weakly or strongly against.
AGAINST = (1.0, 0.05, 0.002)
#: The same inside the content, where a named element is no part of it.
AGAINST_INSIDE = 0.001
#: A weak name does not count on an element with this share of the page's letters.
MOST = 0.8
#: A path with this share of its letters in links, and as many blocks, is a menu.
MENU_SHARE, MENU_BLOCKS = 0.8, 3

_OPENING = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_QUOTED = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_PUNCTUATION = re.compile(r"[.,;:!?¿¡…]")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

# Elements as the HTML standard groups them.
_RAW = frozenset("script style noscript template textarea title iframe svg object".split())
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_BLOCK = frozenset(
    "html head body p div h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
    "caption section article header footer nav aside main form fieldset blockquote pre figure "
    "figcaption address details summary dialog menu hgroup select option button label".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What a start tag ends, beside an open paragraph, and what it does not look beyond.
_ENDS = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
_SCOPE = tuple("html body div ul ol dl table section article aside nav main form td th".split())

_NEVER = frozenset(
    "head nav footer aside menu dialog select option button fieldset label".split()
)
#: Words of class tokens, ids and roles that speak strongly against an element.
_STRONG = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion "
    "menu nav navbar navigation breadcrumb breadcrumbs footer cookie cookies consent gdpr "
    "newsletter signup login related recommended recommendations comment comments commentlist "
    "replies disqus respond pagination pager copyright contentinfo".split()
)
#: Words that may as well be about the article itself.
_WEAK = frozenset(
    "banner sidebar widget widgets masthead notice notices alert popup modal overlay subscribe "
    "subscription share sharing social reply discussion search searchbox toolbar legal skip "
    "complementary".split()
)
#: Parts of run-together words that speak strongly against, and words that only look so.
_STEMS = ("comment", "footer", "cookie", "newsletter", "advert", "breadcrumb", "disqus")
_NO_STEMS = frozenset("commentary commentaries commentator commentators".split())
#: Leading words of tokens that state a layout or a class, not what the element is.
_STATES = frozenset("no has with without category tag type format status layout template".split())
_OWN = frozenset("article content entry main post story text".split())
_AROUND = frozenset("wrap wrapper wrapping container layout grid row columns page with".split())


@dataclass
class Paths:
    """Root-to-leaf paths as pairs of a parent and a label; a parent comes before its children."""

    parent: list[int] = field(default_factory=lambda: [0])
    tag: list[str] = field(default_factory=lambda: [""])
    #: 0, 1 or 2: how far the element's own names speak against it.
    against: list[int] = field(default_factory=lambda: [0])
    #: Never text of the article, whatever the names say.
    shut: list[bool] = field(default_factory=lambda: [False])
    #: Path and kind of the article or main element around, 0 if there is none.
    article: list[int] = field(default_factory=lambda: [0])
    kind: list[str] = field(default_factory=lambda: [""])
    known: dict[tuple[int, str, bool], int] = field(default_factory=dict)

    def below(self, parent: int, tag: str, attributes: str) -> int:
        tokens, hidden = _named(attributes)
        shut = self.shut[parent] or hidden or tag in _NEVER
        key = (parent, f"{tag} {' '.join(tokens)}" if tokens else tag, shut)
        path = self.known.get(key)
        if path is not None:
            return path
        path = self.known[key] = len(self.parent)
        kind = _kind(tag, tokens)
        article, around = self.article[parent], self.kind[parent]
        against = _against(tokens, bool(kind))
        words = {word for token in tokens for word in _words(token)}
        if tag == "header" and not article:
            against = 2
        elif tag == "form" or not article and not kind and "header" in words:
            against = max(against, 1)
        if kind and (not article or around == "main" and kind == "article"):
            article, around = path, kind
        self.parent.append(parent)
        self.tag.append(tag)
        self.against.append(0 if tag in ("html", "body") else against)
        self.shut.append(shut)
        self.article.append(article)
        self.kind.append(around)
        return path


@dataclass
class Block:
    path: int
    text: str
    letters: int
    linked: int


def _named(attributes: str) -> tuple[list[str], bool]:
    """Class tokens, id and role of a tag, and whether it is hidden."""
    tokens: list[str] = []
    hidden = False
    for match in _ATTRIBUTE.finditer(attributes):
        name = match[1].lower()
        value = match[2] or match[3] or match[4] or ""
        if name in ("class", "id", "role"):
            # Numbers and such tell elements of one kind apart, so they are no part of a path.
            tokens += [t for x in value.split() if (t := "-".join(_WORD.findall(x)))]
        elif name == "style":
            hidden |= bool(_HIDDEN.search(value))
        elif name == "hidden":
            hidden = True
        elif name == "aria-hidden":
            hidden |= value.lower() == "true"
    return tokens, hidden


def _words(token: str) -> list[str]:
    return token.lower().split("-")


def _kind(tag: str, tokens: list[str]) -> str:
    if tag in ("article", "main"):
        return tag
    if tag in ("div", "section"):
        return next((x for x in ("article", "main") if x in map(str.lower, tokens)), "")
    return ""


def _against(tokens: list[str], is_article: bool) -> int:
    """How far names speak against an element: 0 not, 1 weakly, 2 strongly."""
    worst = 0
    for token in tokens:
        words = _words(token)
        if words[0] in _STATES or not (_OWN.isdisjoint(words) or _AROUND.isdisjoint(words)):
            continue
        for word in words[:1] if is_article else words:
            stem = word not in _NO_STEMS and any(x in word for x in _STEMS)
            if word in _STRONG or stem:
                worst = 2
            elif word in _WEAK or word.startswith("sidebar") or word.endswith("sidebar"):
                worst = max(worst, 1)
    return worst


class _Reader:
    """Blocks of one page, tag by tag."""

    def __init__(self) -> None:
        self.paths = Paths()
        self.found: list[Block] = []
        self.tags = [""]
        self.open = [0]
        #: Places of each tag's open elements, so that none is searched for.
        self.places: dict[str, list[int]] = {}
        self.parts: list[str] = []
        self.linked = 0
        self.links = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            size = len(text)
            self.found.append(Block(self.open[-1], text, size, min(self.linked, size)))
        self.parts.clear()
        self.linked = 0

    def text(self, raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        self.parts.append(text)
        if self.links:
            self.linked += len(text.strip())

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.parts.append(" ")
        elif tag == "a":
            self.links += 1
        elif tag == "hr":
            self.flush()
        elif tag in _BLOCK:
            self.flush()
            self.links = 0
            ends = _ENDS.get(tag, ())
            limit = max(self._last(x) for x in _SCOPE if x not in ends)
            closed = [at for x in (*ends, "p") for at in self._above(x, limit)]
            if closed:
                self._close(min(closed))
            self.places.setdefault(tag, []).append(len(self.open))
            self.open.append(self.paths.below(self.open[-1], tag, attributes))
            self.tags.append(tag)

    def end(self, tag: str) -> None:
        if tag == "a":
            self.links = max(0, self.links - 1)
        elif tag in _BLOCK:
            self.flush()
            if self.places.get(tag):
                self._close(self._last(tag))
                self.links = 0

    def _last(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else 0

    def _above(self, tag: str, limit: int) -> list[int]:
        """The element of a tag that is open above a place: one at most, as each ends the last."""
        last = self._last(tag)
        return [last] if last > limit else []

    def _close(self, place: int) -> None:
        while len(self.open) > place:
            self.places[self.tags.pop()].pop()
            self.open.pop()


def blocks(page: str) -> tuple[list[Block], Paths]:
    """Text blocks of a page in order, and their paths."""
    reader = _Reader()
    at, end, quotes = 0, len(page), True
    while at < end:
        if page[at] != "<":
            upto = page.find("<", at)
            upto = end if upto < 0 else upto
            reader.text(page[at:upto])
            at = upto
            continue
        if page.startswith("<!--", at):
            upto = page.find("-->", at + 4)
            at = end if upto < 0 else upto + 3
            continue
        opening = _OPENING.match(page, at)
        if opening is None:
            if page.startswith(("<!", "<?", "</"), at):
                upto = page.find(">", at)
                at = end if upto < 0 else upto + 1
            else:
                reader.text("<")
                at += 1
            continue
        quoted = _QUOTED.match(page, opening.end()) if quotes else None
        if quoted:
            upto = quoted.end() - 1
        else:
            # At most one scan of a page fails, so the rest is read without heed to quotes.
            quotes = False
            upto = page.find(">", opening.end())
            if upto < 0:
                break
        tag, attributes = opening[2].lower(), page[opening.end() : upto]
        at = upto + 1
        if opening[1]:
            reader.end(tag)
        elif tag in _RAW:
            closing = re.compile(rf"</{tag}\s*+>", re.I).search(page, at)
            at = closing.end() if closing else end
        else:
            reader.start(tag, attributes)
    reader.flush()
    return reader.found, reader.paths


def _smoothed(values: np.ndarray) -> np.ndarray:
    weights = np.convolve(np.ones(len(values)), SMOOTHING)[2:-2]
    return np.convolve(values, SMOOTHING)[2:-2] / weights


class _Ratios:
    """Fused ratios of the paths of one page."""

    def __init__(self, found: list[Block], paths: Paths) -> None:
        count = len(paths.parent)
        self.paths = paths
        size, linked, marks, blocks_ = ([0] * count for _ in range(4))
        for block in found:
            size[block.path] += block.letters
            linked[block.path] += block.linked
            marks[block.path] += len(_PUNCTUATION.findall(block.text))
            blocks_[block.path] += 1
        letters = np.array([(size[b.path] - linked[b.path]) / blocks_[b.path] for b in found])
        points = np.array([marks[b.path] / blocks_[b.path] for b in found])
        self.fused = [0.0] * count
        for block, a, b in zip(found, _smoothed(letters), _smoothed(points), strict=True):
            score = math.log1p(a) * (1 + math.log1p(b))
            self.fused[block.path] = max(self.fused[block.path], score)
        self.share = [a / b if b else 0.0 for a, b in zip(linked, size, strict=True)]
        self.menu = [
            share >= MENU_SHARE and n >= MENU_BLOCKS and tag not in _HEADINGS
            for share, n, tag in zip(self.share, blocks_, paths.tag, strict=True)
        ]
        self._excuse([0 if x else a - b for a, b, x in zip(size, linked, paths.shut, strict=True)])

    def _excuse(self, letters: list[int]) -> None:
        """Weak names do not count around most of what no strong name speaks against."""
        paths = self.paths
        strong = list(paths.against)
        for path in range(1, len(strong)):
            strong[path] = max(strong[path], 2 * (strong[paths.parent[path]] == 2))
        inside = [0 if strong[p] == 2 else n for p, n in enumerate(letters)]
        total = sum(inside)
        for path in range(len(inside) - 1, 0, -1):
            inside[paths.parent[path]] += inside[path]
        self.against = [
            0 if a == 1 and inside[p] >= MOST * total else a for p, a in enumerate(paths.against)
        ]

    def selected(self, threshold: float) -> set[int]:
        """Paths whose score reaches the share of the page's best."""
        paths = self.paths
        factor = [1.0] * len(self.fused)
        scores: dict[int, float] = {}
        for path in range(len(factor)):
            if path:
                factor[path] = factor[paths.parent[path]] * AGAINST[self.against[path]]
            if not paths.shut[path] and self.share[path] <= 0.5 and self.fused[path]:
                scores[path] = self.fused[path] * factor[path] * WEIGHTS[paths.kind[path]]
        best = max(scores.values(), default=0.0)
        return {path for path, score in scores.items() if score >= threshold * best}

    def inside(self, chosen: set[int], threshold: float) -> set[int]:
        """Paths of the content around the chosen ones that reach the second threshold."""
        paths = self.paths
        count = len(self.fused)
        roots = {paths.article[path] or paths.parent[path] for path in chosen}
        around = [path in roots for path in range(count)]
        for path in range(count - 1, 0, -1):
            around[paths.parent[path]] |= around[path]
        content, factor, scores = [False] * count, [1.0] * count, {}
        for path in range(count):
            up = paths.parent[path]
            content[path] = path in roots or bool(path) and content[up]
            if not around[path]:
                factor[path] = factor[up] * (AGAINST_INSIDE if self.against[path] else 1.0)
            if content[path] and not paths.shut[path]:
                score = self.fused[path] * factor[path]
                scores[path] = score * (AGAINST_INSIDE if self.menu[path] else 1.0)
        best = max(scores.values(), default=0.0)
        return {path for path, score in scores.items() if score >= threshold * best}


def main_text(
    page: str | None, threshold: float = THRESHOLD, inner_threshold: float = INNER_THRESHOLD
) -> str:
    found, paths = blocks(page or "")
    if not found:
        return ""
    ratios = _Ratios(found, paths)
    kept = ratios.inside(ratios.selected(threshold), inner_threshold)
    return "\n\n".join(block.text for block in found if block.path in kept)


def extract_text(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_pieces(batches, "html"):
            texts = [main_text(x, threshold) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(x) for x in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page_id"),
        F.col(f"`{url_column}`").cast("string").alias("url"),
        F.col(f"`{html_column}`").cast("string").alias("html"),
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
