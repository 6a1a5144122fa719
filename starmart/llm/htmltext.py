"""Main text of web pages by tag-path ratios.

A page becomes a row of text blocks, each with its tag path from the root. Per path, the text outside
links and the sentence punctuation are summed and divided by the path's blocks. Both ratios, written
along the page, are smoothed with a Gaussian, fused into one score with the path's share of unlinked text,
averaged over each path's blocks and held against a share of the best path. The paths above it find the
content: with them stays every other block of the main element or, on pages without one, of the smallest
element round them; where that is the whole page, every block from the first of them to the last.

Paths inside the page's main element weigh double; paths through page furniture (menus, headers and
footers of the page, forms, adverts, notices, reader comments, told by tag, role or class) weigh
nothing. Articles and main elements are never judged by class; a form, or an element named as furniture,
is none where it holds the main element or, without one, most of the unlinked text. Where everything is
furniture, nothing is. Scripts, styles and the head never become blocks.

Defined results: a null or empty page, or one without blocks, gives the empty text. Rows are
independent, so repeated pages give repeated results. Input columns stay; an added column replaces one
of the same name.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SHARE = 0.5  # of the best path's score that a content path reaches
MAIN_WEIGHT = 2.0
SMOOTHING = np.exp(-0.5 * np.arange(-2, 3) ** 2)

# Kinds of HTML elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set(
    "script style noscript template head title svg math iframe object canvas select button textarea".split()
)
RAW = {"script", "style", "textarea", "title"}  # no tags inside
BLOCKS = set(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p
    pre section summary table tbody td tfoot th thead tr ul""".split()
)
ENDS_BEFORE = {  # an element that the start of another one ends, and what the search for it stops at
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
}
FURNITURE_TAGS = {"nav", "aside", "footer", "form", "menu", "dialog"}
FURNITURE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form"}
FURNITURE_WORDS = set(
    """ad ads advert adverts advertisement adbox sponsor sponsored promo banner cookie cookies consent gdpr
    notice popup modal newsletter subscribe subscription sidebar menu nav navbar navigation breadcrumb
    breadcrumbs footer comment comments disqus reply replies respond related share sharing social login
    signup pagination widget toolbar masthead copyright authorbio""".split()
)
# Words that tell furniture wherever they stand in a name, as in "js-ad" or "global-nav", unless the word
# before them says that something has it, or has none: "with-sidebar", "no-ads".
HEAD_WORDS = set(
    """ad ads advert adverts advertisement adbox sponsored cookie cookies consent gdpr newsletter sidebar nav
    navbar navigation breadcrumb breadcrumbs footer comment comments disqus""".split()
)
HAVING_WORDS = set("with has have having no non without hide show is".split())
# Parts that other furniture names may have besides: "related-articles" is furniture, "related-work" is not.
PLACE_WORDS = set(
    """area article articles author bar bio block bottom box btn button buttons center container content footer header holder icon icons
    inner item items left link links list main outer overlay page panel post posts primary right secondary
    section site stories the title top wrap wrapper""".split()
)
READER_WORDS = set("comment comments disqus reply replies respond".split())
SENTENCE_MARKS = frozenset(".,;:!?…。，！？")

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)                                          # comment
      | <(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>=]|=\s*"[^"]*"|=\s*'[^']*'|=)*+)(?:>|(?P<cut>\Z))
      | <[!?/][^>]*>?                                              # declaration or broken end tag
      | [^<]+ | <""",
    re.S | re.X,
)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    path: int
    text: str
    link_chars: int
    furniture: bool
    main: bool
    element: _Element


@dataclass(eq=False)
class _Element:
    tag: str
    path: int
    silent: bool
    furniture: bool
    main: bool
    holds_main: bool = False
    by_name: bool = False
    by_readers: bool = False
    parent: _Element | None = None


@dataclass
class _Page:
    """Turns tags into blocks; paths are numbered as they appear."""

    blocks: list[tuple[_Element, str, int]] = field(default_factory=list)
    paths: dict[tuple[int, str], int] = field(default_factory=dict)
    parts: list[str] = field(default_factory=list)
    link_chars: int = 0
    links: int = 0
    main_seen: bool = False

    def __post_init__(self):
        self.stack = [_Element("", 0, False, False, False)]

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                holder = next(e for e in reversed(self.stack) if e.tag in BLOCKS or not e.tag)
                self.blocks.append((holder, text, self.link_chars))
            self.parts, self.link_chars = [], 0

    def text(self, raw: str) -> None:
        if not self.stack[-1].silent:
            plain = html.unescape(raw) if "&" in raw else raw
            self.parts.append(plain)
            if self.links:
                self.link_chars += len("".join(plain.split()))

    def start(self, tag: str, attributes: str) -> None:
        if tag in VOID:
            if tag == "hr":
                self.flush()
            elif tag == "br":
                self.parts.append(" ")
            return
        if tag in BLOCKS:
            self.flush()
            self._end_nearest({"p"}, {"table", "td", "th", "button"})
            if tag in ENDS_BEFORE:
                self._end_nearest(*ENDS_BEFORE[tag])
        parent = self.stack[-1]
        path = self.paths.setdefault((parent.path, tag), len(self.paths) + 1)
        found = self._furniture_words(tag, attributes)
        named, by_readers = bool(found), bool(found & READER_WORDS)
        inside = parent.main
        own_main = tag in ("article", "main") and not self.main_seen and not named and not self._around(parent)
        if own_main:
            self.main_seen = True
            for element in self.stack:
                element.holds_main = True
        tagged = tag in FURNITURE_TAGS or (tag == "header" and not inside)
        element = _Element(tag, path, parent.silent or tag in SILENT, tagged, inside or own_main)
        element.by_name, element.by_readers, element.parent = named, by_readers, parent
        self.stack.append(element)
        self.links += tag == "a"

    @staticmethod
    def _around(element: _Element | None) -> bool:
        """Whether a furniture element other than a form, or one of reader comments, is open."""
        while element is not None:
            if (element.furniture and element.tag != "form") or element.by_readers:
                return True
            element = element.parent
        return False

    @staticmethod
    def _furniture_words(tag: str, attributes: str) -> set[str]:
        """Furniture words of a role, and of class and id tokens: head words, and names of nothing but such words
        and places.
        """
        found: set[str] = set()
        if not attributes or tag in ("html", "body"):
            return found
        for name, *values in _ATTRIBUTE.findall(attributes):
            role = name.lower() == "role"
            if tag in ("article", "main") and not role:
                continue
            for token in "".join(values).split():
                parts = [w.lower() for w in _NAME_PARTS.findall(token)]
                words = set(parts)
                if role:
                    found |= words & FURNITURE_ROLES
                    continue
                found |= {w for before, w in zip(["", *parts], parts) if w in HEAD_WORDS and before not in HAVING_WORDS}
                if words <= FURNITURE_WORDS | PLACE_WORDS:
                    found |= words & FURNITURE_WORDS
                if "".join(parts) in FURNITURE_WORDS:
                    found.add("".join(parts))
        return found

    def _end_nearest(self, tags: set[str], stops: set[str]) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                self._pop_to(i)
                return
            if self.stack[i].tag in stops or (self.stack[i].tag in BLOCKS and "p" in tags):
                return

    def _pop_to(self, i: int) -> None:
        for element in self.stack[i:]:
            self.links -= element.tag == "a"
        del self.stack[i:]

    def end(self, tag: str) -> None:
        block = tag in BLOCKS
        if block:
            self.flush()
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                self._pop_to(i)
                return
            if not block and self.stack[i].tag in BLOCKS:
                return


def _is_furniture(element: _Element, known: dict[_Element, bool], holding: set[_Element]) -> bool:
    """By its tag or name or those around it; a form or named element that holds the text is none."""
    chain = []
    while element is not None and element not in known:
        chain.append(element)
        element = element.parent
    inherited = known[element] if element is not None else False
    for e in reversed(chain):
        exempt = e.holds_main or e in holding
        tagged = e.furniture and not (e.tag == "form" and exempt)
        inherited = inherited or tagged or (e.by_name and not exempt)
        known[e] = inherited
    return inherited


def _unlinked(text: str, link_chars: int) -> int:
    return max(0, len(text) - link_chars)


def _holding_most(blocks: list[tuple[_Element, str, int]]) -> set[_Element]:
    """Elements with more than half of the unlinked text, where no main element has any.

    Each element hands its sum on to its parent, the latest started first, so every element is met once.
    """
    if any(e.main and _unlinked(t, n) for e, t, n in blocks):
        return set()
    below: dict[_Element, int] = {}
    for e, t, n in blocks:
        below[e] = below.get(e, 0) + _unlinked(t, n)
    levels: dict[int, set[_Element]] = {}
    seen: dict[_Element, int] = {}

    def depth(e: _Element) -> int:
        chain = []
        while e is not None and e not in seen:
            chain.append(e)
            e = e.parent
        at = seen[e] if e is not None else -1
        for x in reversed(chain):
            at += 1
            seen[x] = at
            levels.setdefault(at, set()).add(x)
        return at

    for e in list(below):
        depth(e)
    for level in sorted(levels, reverse=True):
        for e in levels[level]:
            if e.parent is not None:
                below[e.parent] = below.get(e.parent, 0) + below.get(e, 0)
    total = sum(_unlinked(t, n) for _, t, n in blocks)
    return {e for e, n in below.items() if 2 * n > total and not e.by_readers}


def blocks_of(page: str) -> list[Block]:
    reader, at = _Page(), 0
    while at < len(page):
        token = _TOKEN.match(page, at)
        at = token.end()
        tag = token["tag"]
        if tag is None:
            if page[token.start()] != "<" or token.end() - token.start() == 1:
                reader.text(token.group())
            continue
        if token["cut"] is not None:  # the page ends inside a tag
            break
        tag = tag.lower()
        if token["end"]:
            reader.end(tag)
            continue
        reader.start(tag, token["attrs"])
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            at = close.start() if close else len(page)
    reader.flush()
    known: dict[_Element, bool] = {}
    holding = _holding_most(reader.blocks)
    return [Block(e.path, t, n, _is_furniture(e, known, holding), e.main, e) for e, t, n in reader.blocks]


def _smoothed(values: np.ndarray) -> np.ndarray:
    """Gaussian mean over the neighbours that there are."""
    margin = len(SMOOTHING) // 2
    near = slice(margin, margin + len(values))
    weight = np.convolve(np.ones(len(values)), SMOOTHING)[near]
    return np.convolve(values, SMOOTHING)[near] / weight


def _root(chosen: list[Block]) -> _Element:
    """The smallest element round all chosen blocks."""
    above = {}  # the elements round the first block, by their place from the inside
    element = chosen[0].element
    while element is not None:
        above[element] = len(above)
        element = element.parent
    root, cleared = chosen[0].element, set()
    for b in chosen:
        e = b.element
        while e not in above and e not in cleared:
            cleared.add(e)
            e = e.parent
        if e in above and above[e] > above[root]:
            root = e
    return root


def _below(element: _Element, root: _Element, known: dict[_Element, bool]) -> bool:
    chain = []
    while element is not None and element is not root and element not in known:
        chain.append(element)
        element = element.parent
    inside = element is root or (element is not None and known[element])
    known.update(dict.fromkeys(chain, inside))
    return inside


def _with_surroundings(blocks: list[Block], chosen: np.ndarray) -> list[Block]:
    """The chosen blocks and the others of the element that holds them."""
    best = [b for b, c in zip(blocks, chosen, strict=True) if c]
    if not best:
        return []
    if any(b.main for b in best):
        return [b for b, c in zip(blocks, chosen, strict=True) if c or b.main]
    root, known = _root(best), {}
    if root.tag in ("", "html", "body"):
        first, last = np.flatnonzero(chosen)[[0, -1]]
        return blocks[first : last + 1]
    return [b for b in blocks if _below(b.element, root, known)]


def content(blocks: list[Block]) -> list[Block]:
    """The blocks of the paths whose fused score reaches the share of the best one, and those around them."""
    blocks = [b for b in blocks if not b.furniture] or blocks
    if not blocks:
        return []
    # A path inside the main element and the same path outside it are two.
    _, path = np.unique([2 * b.path + b.main for b in blocks], return_inverse=True)
    number = np.bincount(path)
    every = np.bincount(path, [len(b.text) for b in blocks])
    chars = np.bincount(path, [max(0, len(b.text) - b.link_chars) for b in blocks]) / number
    unlinked = chars * number / every
    marks = np.bincount(path, [sum(map(SENTENCE_MARKS.__contains__, b.text)) for b in blocks]) / number
    length, points = _smoothed(chars[path]), _smoothed(marks[path])
    weight = unlinked[path] * np.array([MAIN_WEIGHT if b.main else 1.0 for b in blocks])
    fused = weight * np.log1p(length) * (1 + 0.1 * np.log1p(points))
    score = np.bincount(path, fused) / number
    chosen = (score >= SHARE * score.max()) & (score > 0)
    return _with_surroundings(blocks, chosen[path])


def main_text(page: str | None) -> str:
    return "\n".join(b.text for b in content(blocks_of(page or "")))


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """``pages`` with ``text`` and its length ``n_chars`` in code points."""
    columns = [c for c in pages.columns if c not in ("text", "n_chars")]
    kept = pages.select(*columns, *([] if column in columns else [column]))
    out = [c for c in columns if c != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(value.as_py()) for value in batch.column(column)]
            arrays = [batch.column(c) for c in out]
            arrays += [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*out, "text", "n_chars"])

    types = {f.name: f.dataType.simpleString() for f in kept.schema.fields}
    schema = "".join(f"`{c}` {types[c]}, " for c in out)
    return kept.mapInArrow(run, f"{schema}text string, n_chars bigint")
