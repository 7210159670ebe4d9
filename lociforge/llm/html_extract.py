"""Main text of web pages by tag-path ratios.

Every text block has a tag path, the element names from the root down to it.  Per path of a page, text length and punctuation are summed and
set against the number of its blocks; both ratios are smoothed over the blocks in page order and fused into one score (higher inside ``article``
and ``main``), and the paths at or above a threshold are content paths.  They select the content nodes:

* the core is the deepest container that holds most of the selected score, whatever its name; with it go the ``article`` or ``main`` around it;
* where a core's score lies in several containers below it, those of them stay in whose text content paths prevail;
* an element whose class or id names it a sidebar, notice, advert, comment list and the like is left out, unless an article lies in it or most of the
  selected score does; so are link lists, and what HTML itself sets apart (menus, forms, scripts, hidden elements).
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_BROKEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
_PUNCTUATION = re.compile(r"[.,;:!?…、。，！？¿¡]")

# Element names by their role in HTML.
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: An element that ends an open one of these names, up to the nearest of the given containers.
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}
#: Never main text.
SKIPPED = frozenset("head script style noscript template nav footer aside form button select option textarea title iframe svg math canvas audio video object map dialog menu noembed noframes xmp datalist".split())
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form toolbar".split())
#: Words that name, at the end of a class or id, what is not the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar side rail widget nav navbar navigation menu submenu breadcrumb breadcrumbs footer header masthead topbar toolbar "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login comment comments commentlist reply replies respond disqus discussion share sharing social follow "
    "related recommended recommendations readmore pagination pager skip search searchform tags taglist copyright legal disclaimer paywall hidden".split()
)
#: Of these, what holds whole sentences of readers or sellers: never spared for its length.
FOREIGN = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion comment comments commentlist reply replies respond disqus discussion".split())
#: Words of layout, which say nothing about the content; and what begins a name that only speaks of another element.
LAYOUT = frozenset("list box container wrapper wrap area block section bar panel left right top bottom slot unit inner outer item items group row col column text body form holder module zone".split())
ABOUT = frozenset("has with no without is not".split())
#: Parts of the article that may be called its header or footer.
OWN = frozenset("entry post article content story title".split())
_WORD = re.compile(r"[a-z]+")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold an article's blocks.
CONTAINERS = frozenset("article body center div main section td".split())
WINDOW = np.array([0.25, 0.5, 1.0, 0.5, 0.25])
#: A path inside an article or main counts so much more.
ARTICLE = 2.0


def _attributes(raw: str) -> dict[str, str]:
    return {m[0].lower(): (m[1] or m[2] or m[3]) for m in _ATTRIBUTE.findall(raw)} if raw and not raw.isspace() else {}


def _skipped(name: str, attrs: dict[str, str], in_article: bool) -> bool:
    """What HTML itself sets apart from the text."""
    if name in SKIPPED or name == "header" and not in_article:
        return True
    if not attrs or name in ("html", "body", "article", "main"):
        return False
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or attrs.get("role", "").lower() in SKIPPED_ROLES:
        return True
    return bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "").lower()))


def mark_of(attrs: dict[str, str]) -> str | None:
    """The word by which a class or the id names the element as foreign: the last of a name that is not layout."""
    names = f"{attrs.get('class', '')} {attrs.get('id', '')}".split()
    for name in names:
        words = _WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower())
        if not words or words[0] in ABOUT:
            continue
        said = [w for w in words if w not in LAYOUT]
        if said and said[-1] in MARKS and not (said[-1] in ("header", "footer") and OWN.intersection(said)):
            return said[-1]
    return None


class _Page:
    """A page's blocks: text, path, element, length of link text; and its elements, numbered in page order.

    ``inside`` tells whether an article or main is open, ``link`` how deep in a link an element is (0: not), ``home`` an element's nearest one that is not
    inline.  All are kept per element, so that deeply nested pages cost no more than flat ones.
    """

    def __init__(self, source: str):
        self.names, self.parents, self.dropped, self.paths = [""], [-1], [False], [0]
        self.inside, self.link, self.home, self.marks = [False], [0], [0], [None]
        self.path_of: dict[tuple[int, str], int] = {}
        self.path_inside: list[bool] = [False]
        self.blocks: list[tuple[str, int, int, int]] = []
        self.stack = [0]
        self.open_names: Counter[str] = Counter()
        self.parts: list[str] = []
        self.at, self.linked = 0, 0
        self._read(source)

    def _flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append((text, self.paths[self.at], self.at, self.linked))
            self.parts, self.linked = [], 0

    def _text(self, raw: str) -> None:
        top = self.stack[-1]
        if not raw or self.dropped[top]:
            return
        raw = entities.unescape(raw) if "&" in raw else raw
        if not self.parts:
            self.at = self.home[top]
        self.parts.append(raw)
        if self.link[top]:
            self.linked += len(raw.strip())

    def _open(self, name: str, raw: str) -> None:
        if name in CLOSES_P:
            self._pop(("p",), ("table", "td", "th", "button", "article", "section", "div", "main", "body", "aside", "li", "blockquote"))
        if name in ENDS:
            self._pop(*ENDS[name])
        parent = self.stack[-1]
        attrs = _attributes(raw)
        dropped = self.dropped[parent] or _skipped(name, attrs, self.inside[parent])
        mark = mark_of(attrs) if attrs and name not in ("html", "body", "article", "main") else None
        me = len(self.names)
        self.names.append(name)
        self.parents.append(parent)
        self.dropped.append(dropped)
        self.marks.append(mark)
        self.inside.append(self.inside[parent] or name in ("article", "main"))
        self.link.append(1 if name == "a" else self.link[parent] + 1 if 0 < self.link[parent] < 4 else 0)
        self.home.append(self.home[parent] if name in INLINE else me)
        step = (self.paths[parent], name if mark is None else name + "!")
        if name in INLINE:
            self.paths.append(self.paths[parent])
        else:
            if step not in self.path_of:
                self.path_of[step] = len(self.path_inside)
                self.path_inside.append(self.inside[me])
            self.paths.append(self.path_of[step])
        if not raw.endswith("/") and name not in VOID or raw.endswith("/") and name not in VOID and name not in INLINE and name != "path":
            self.stack.append(me)
            self.open_names[name] += 1

    def _cut(self, i: int) -> None:
        for e in self.stack[i:]:
            self.open_names[self.names[e]] -= 1
        del self.stack[i:]

    def _pop(self, names: tuple[str, ...], up_to: tuple[str, ...]) -> None:
        if not any(self.open_names[n] for n in names):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            name = self.names[self.stack[i]]
            if name in names:
                self._cut(i)
                return
            if name in up_to:
                return

    def _close(self, name: str) -> None:
        if not self.open_names[name]:
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.names[self.stack[i]] == name:
                self._cut(i)
                return

    def _read(self, source: str) -> None:
        at, lower, find = 0, None, source.find
        while True:
            tag = find("<", at)
            if tag < 0:
                self._text(source[at:])
                break
            m = _TOKEN.match(source, tag) or _BROKEN.match(source, tag)
            if not m:  # a bare "<"
                self._text(source[at : tag + 1])
                at = tag + 1
                continue
            self._text(source[at:tag])
            at = m.end()
            name = m.group(2)
            if name is None:
                continue
            name = name.lower()
            if m.group(1):
                if name not in INLINE:
                    self._flush()
                self._close(name)
                continue
            if name == "br":
                self._text(" ")
            elif name not in INLINE:
                self._flush()
            self._open(name, m.group(3) or "")
            if name in RAW:
                lower = source.lower() if lower is None else lower
                end = lower.find(f"</{name}", at)
                at = len(source) if end < 0 else end
        self._flush()

    def totals(self, values: np.ndarray) -> np.ndarray:
        """Sums of the blocks' values over every element's subtree."""
        total = np.zeros(len(self.names))
        np.add.at(total, [b[2] for b in self.blocks], values)
        total = total.tolist()
        for e in range(len(total) - 1, 0, -1):
            total[self.parents[e]] += total[e]
        return np.array(total)


def path_scores(paths: np.ndarray, lengths: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Fused score of each block: its path's text and punctuation per block, smoothed in page order, multiplied."""
    _, of, count = np.unique(paths, return_inverse=True, return_counts=True)
    smooth = lambda x: np.convolve(np.pad(x, 2, mode="edge"), WINDOW / WINDOW.sum(), "valid")
    text = (np.bincount(of, lengths) / count)[of]
    mark = (np.bincount(of, points) / count)[of]
    fused = smooth(text) * (0.5 + smooth(mark))
    return (np.bincount(of, fused) / count)[of]


def _spared(page: _Page, mass: np.ndarray, held: np.ndarray) -> list[bool]:
    """Elements that are left out by their mark, with all below them.  ``mass``: selected score, ``held``: text, by subtree."""
    named = [n in ("article", "main") and held[e] > 0 for e, n in enumerate(page.names)]
    around = [int(x) for x in named]
    for e in range(len(around) - 1, 0, -1):
        around[page.parents[e]] += around[e]
    gone = [False]
    for e in range(1, len(page.names)):
        word = page.marks[e]
        most = word is not None and word not in FOREIGN and not around[0] and mass[e] >= 0.5 * mass[0]
        gone.append(gone[page.parents[e]] or word is not None and not around[e] and not most)
    return gone


def _core(page: _Page, mass: np.ndarray, held: np.ndarray, headed: set[int]) -> int:
    """The element whose blocks are the text."""
    core = max((e for e, n in enumerate(page.names) if n in CONTAINERS and mass[e] >= 0.8 * mass[0] and not page.dropped[e]), default=0)
    up = core
    while up:  # the innermost article or main around it
        if page.names[up] in ("article", "main"):
            return up
        up = page.parents[up]
    while page.parents[core] in headed and page.names[page.parents[core]] in ("div", "section") and held[core] >= 0.8 * held[page.parents[core]]:
        core = page.parents[core]  # a title beside its text
    return core


def extract(source: str | None, threshold: float = 0.5) -> str:
    """The main text of one page: its blocks joined by newlines; empty for null, empty or textless pages.  Time is linear in the page."""
    if not source:
        return ""
    page = _Page(source)
    blocks = page.blocks
    if not blocks:
        return ""
    lengths = np.array([len(b[0]) for b in blocks], float)
    linked = np.array([b[3] for b in blocks], float) / lengths > 0.6
    points = np.array([len(_PUNCTUATION.findall(b[0])) for b in blocks], float)
    paths = np.array([b[1] for b in blocks])
    score = path_scores(paths, lengths, points) * ~linked * np.where(np.array(page.path_inside)[paths], ARTICLE, 1.0)
    chosen = score >= threshold * score.mean()
    weight = np.where(chosen, score * lengths, 0.0)
    if not weight.any():
        chosen, weight = np.ones(len(blocks), bool), lengths
    gone = _spared(page, page.totals(weight), page.totals(lengths))
    live = ~np.array([gone[b[2]] for b in blocks])
    if not live.any():
        return ""
    if not (weight * live).any():
        weight = lengths
    mass, held = page.totals(weight * live), page.totals(lengths * live)
    headed = {page.parents[b[2]] for b, x in zip(blocks, live, strict=True) if x and page.names[b[2]] in HEADINGS}
    core = _core(page, mass, held, headed)
    # the container right below the core that an element lies in; -1 outside the core, the core itself where there is none
    below = [-1] * len(page.names)
    below[core] = core
    for e in range(core + 1, len(page.names)):
        up = below[page.parents[e]]
        below[e] = e if up == core and page.names[e] in CONTAINERS else up
    rest = [i for i, b in enumerate(blocks) if live[i] and below[b[2]] >= 0]
    direct = sum(weight[i] for i in rest if below[blocks[i][2]] == core)
    if page.names[core] not in ("article", "main") and direct < 0.5 * mass[core]:
        selected = page.totals(lengths * live * chosen)
        rest = [i for i in rest if (c := below[blocks[i][2]]) == core or selected[c] >= 0.5 * held[c]]
    path_linked: dict[int, bool] = {}
    for i in rest:  # a path is a link list if all its blocks are links, and several
        path_linked[blocks[i][1]] = path_linked.get(blocks[i][1], True) and bool(linked[i])
    several = Counter(blocks[i][1] for i in rest)
    return "\n".join(blocks[i][0] for i in rest if not (path_linked[blocks[i][1]] and several[blocks[i][1]] > 1))


def main_text(page: Column, threshold: float = 0.5) -> Column:
    """``extract`` of each page's whole html."""

    def run(column: pa.Array) -> pa.Array:
        return pa.array([extract(x.as_py(), threshold) for x in column], pa.string())

    return F.arrow_udf(run, "string")(page)


def extract_pages(pages: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text in ``into`` (replacing a column of that name); rows stay as they are, repeated ones too.

    Null, empty and textless html give an empty text; deeply nested and very long pages take linear time.  No shuffle: a page is judged on its own.
    """
    return pages.withColumn(into, main_text(F.col(html)))
