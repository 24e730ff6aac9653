"""Main text of HTML pages from flat text blocks and a small decision tree.

A page is cut into flat text blocks at block-level tags. Each block gets shallow features, its
own and those of the blocks before and after it: number of words, link density, and what its
open elements say (boilerplate or content elements, and class, id and role names). A decision
tree (CART, Gini) tells content from boilerplate. It is trained here on the labelled pages of
``html_pages.py``, a small table kept with the code.

Scripts, styles, comments, head matter and form controls are never text. Character references
are decoded, white space inside a block becomes one blank, blocks of content are joined by line
feeds in page order; nothing is dropped for its length.

Defined cases: null and empty pages and pages without text give an empty text; unclosed and
stray tags close what they can; markup that never ends (a comment, a script, a tag without its >) is left out up to the end
of the page; repeated pages give repeated rows; other columns are ignored. Deep nesting, stray end tags and tags
without an end take time in proportion to the page.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements whose content is no text of the page.
_RAW = "script|style|template|textarea|title|iframe|noembed|noframes|xmp|svg|object|canvas"
_ATTRIBUTES = r"""(?:[^>"']++|"[^"]*"|'[^']*'|["'])*+"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW})(?=[\s/>]){_ATTRIBUTES}>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>{_ATTRIBUTES})>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
_OPENING = re.compile(r"<[a-zA-Z/!?]")
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_MAY_HIDE = re.compile(r"hidden|display", re.I)
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_NOT_DISPLAYED = re.compile(r"(?:^|;|\*/)\s*display\s*:\s*none(?![\w-])", re.I)
_WORDS = re.compile(r"[a-z]+|(?<=[a-z])(?=[A-Z])")

#: Elements that end a text block where they open or close.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav noscript ol option p pre "
    "search section select summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Content elements and boilerplate elements by their meaning in HTML.
CONTENT = frozenset("article main".split())
BOILERPLATE = frozenset(
    "nav footer aside form header menu dialog button select option label fieldset legend noscript head search".split()
)
#: Parts of class, id and role names that pages use for what is not the article.
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments complementary "
    "consent contentinfo cookie cookies copyright disclaimer disqus footer form gdpr header login masthead menu modal nav navbar "
    "navigation newsletter notice notices notification outbrain overlay pager pagination paywall popup privacy promo promoted "
    "promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored "
    "subscribe subscription taboola tags toc toolbar widget widgets".split()
)
CONTENT_NAMES = frozenset("article content entry main post story text body".split())
#: An opening tag of the first kind ends an open one of the second.
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
_CLOSES_P = BLOCK - {"body", "html", "head", "label", "button", "option", "select"}

_PAGES = 256  # worked on at once

FEATURES = (
    "words", "link_density", "boilerplate", "content", "names", "heading", "list_item",
    "content_on_page", "words_before", "link_density_before", "boilerplate_before", "words_after", "link_density_after", "boilerplate_after",
)


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    boilerplate: int  # open boilerplate elements
    content: int  # open content elements
    names: int  # boilerplate names less content names of the open elements
    heading: bool
    list_item: bool


def _name_score(attributes: str) -> int:
    """1 if a class, id or role names boilerplate, -1 if one names content, else 0."""
    score = 0
    for found in _NAMES.finditer(attributes):
        parts = set(_WORDS.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", found[1] or found[2] or found[3] or "").lower()))
        if parts & BOILERPLATE_NAMES:
            return 1
        if parts & CONTENT_NAMES:
            score = -1
    return score


def _hides(attributes: str) -> bool:
    """An attribute named hidden, aria-hidden that is true, or a style that does not display; not such words in other values."""
    if not _MAY_HIDE.search(attributes):
        return False
    for found in _ATTRIBUTE.finditer(attributes):
        name, value = found[1].lower(), found[2] or found[3] or found[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true" or name == "style" and _NOT_DISPLAYED.search(value):
            return True
    return False


def _is_open(page: str, tag: re.Match) -> bool:
    """Does a comment or an element that is no text lack its end?"""
    if tag["raw"]:
        return not re.fullmatch(rf"</{tag['raw']}\s*>", page[max(page.rfind("</", tag.start(), tag.end()), tag.start()) : tag.end()], re.I)
    return page.startswith("<!--", tag.start()) and not (tag.end() - tag.start() > 6 and page.endswith("-->", tag.start(), tag.end()))


def blocks_of(page: str) -> list[Block]:
    """Flat text blocks in page order."""
    out: list[Block] = []
    open_: list[str] = []
    parts: list[tuple[str, bool]] = []
    state = [0, 0, 0, 0, 0, 0, 0]  # boilerplate, content, names, links, hidden, headings, list items

    def flush() -> None:
        if not parts:
            return
        bare = " ".join(entities.unescape("".join([t for t, _ in parts])).split())
        if bare:
            total = linked = 0
            for t, link in parts:
                total += len(t)
                linked += len(t) * link
            out.append(
                Block(bare, round(len(bare) * linked / max(1, total)), state[0], state[1], state[2],
                      state[5] > 0, state[6] > 0)
            )
        parts.clear()

    before: list[list[int]] = []  # the state outside each open element
    places: dict[str, list[int]] = {}  # of the open elements of each name
    block_places = [-1]  # of the open block elements

    def enter(name: str, score: int, hidden: bool) -> None:
        before.append(list(state))
        places.setdefault(name, []).append(len(open_))
        if name in BLOCK:
            block_places.append(len(open_))
        open_.append(name)
        state[0] += name in BOILERPLATE and not (name == "header" and state[1])
        state[1] += name in CONTENT
        state[2] += score
        state[3] += name == "a"
        state[4] += hidden
        state[5] += name in HEADINGS
        state[6] += name == "li"

    def pop_to(at: int) -> None:
        state[:] = before[at]
        for name in open_[at:]:
            places[name].pop()
        while block_places[-1] >= at:
            block_places.pop()
        del open_[at:], before[at:]

    def last_place(name: str) -> int:
        return (places.get(name) or [-1])[-1]

    def text_at(low: int, high: int) -> None:
        if high > low and not state[4]:
            parts.append((page[low:high], state[3] > 0))

    at, last = 0, page.rfind(">") + 1
    never_ends = _OPENING.search(page, last)  # nothing behind the last > can end a tag
    end = never_ends.start() if never_ends else len(page)
    for tag in _TOKEN.finditer(page, 0, last):
        text_at(at, tag.start())
        at = tag.end()
        name = (tag["name"] or "").lower()
        if not name:
            if at == last and _is_open(page, tag):
                end = at  # a comment or script without an end
            continue
        if name == "br":
            parts.append((" ", False))
            continue
        is_block = name in BLOCK
        if is_block:
            flush()
        if tag["end"]:
            place = last_place(name)
            if place >= 0 and (is_block or place > block_places[-1]):  # a stray inline end tag closes nothing outside its block
                pop_to(place)
            continue
        if name in _CLOSES or name in _CLOSES_P:
            ends = _CLOSES.get(name, set()) | ({"p"} if name in _CLOSES_P else set())
            place = max(map(last_place, ends))
            if place >= 0 and place >= block_places[-1]:  # no other block between
                pop_to(place)
        if name in VOID or tag["attributes"].endswith("/") and name not in BLOCK:
            continue
        attributes = tag["attributes"]
        enter(name, _name_score(attributes) if attributes and name not in ("html", "body") else 0, bool(attributes and _hides(attributes)))
    text_at(at, end)
    flush()
    return out


def features(pages: Sequence[Sequence[Block]]) -> np.ndarray:
    """One row of ``FEATURES`` for each block of the pages, in order."""
    own = np.array(
        [[b.text.count(" ") + 1, b.linked / len(b.text), b.boilerplate, b.content, b.names, b.heading, b.list_item] for blocks in pages for b in blocks],
        dtype=np.float64,
    ).reshape(-1, 7)
    sizes = np.array([len(blocks) for blocks in pages if blocks], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    before, after = np.zeros((len(own), 3)), np.zeros((len(own), 3))
    before[1:], after[:-1] = own[:-1, :3], own[1:, :3]
    before[starts], after[starts + sizes - 1] = 0, 0
    on_page = np.repeat(np.maximum.reduceat(own[:, 3], starts) > 0 if len(starts) else [], sizes)
    return np.hstack([own, on_page.reshape(-1, 1).astype(np.float64), before, after])


@dataclass(frozen=True)
class Tree:
    """A binary tree in arrays: ``feature`` is -1 in a leaf, whose ``value`` is the share of content."""

    feature: np.ndarray
    cut: np.ndarray
    below: np.ndarray
    above: np.ndarray
    value: np.ndarray

    def content(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows), dtype=np.int64)
        while (inner := self.feature[at] >= 0).any():
            some = np.flatnonzero(inner)
            node = at[some]
            low = rows[some, self.feature[node]] <= self.cut[node]
            at[some] = np.where(low, self.below[node], self.above[node])
        return self.value[at] > 0.5


def fit_tree(rows: np.ndarray, content: np.ndarray, depth: int = 6, least: int = 2) -> Tree:
    """CART by Gini impurity; equal gains take the first feature and the lowest cut."""
    nodes: list[list[float]] = []

    def grow(at: np.ndarray, level: int) -> int:
        y = content[at]
        number = len(nodes)
        nodes.append([-1, 0.0, -1, -1, float(y.mean())])
        best = (1e-9, None, 0.0)
        if level < depth and 0 < y.mean() < 1:
            whole = 2 * y.mean() * (1 - y.mean())
            for f in range(rows.shape[1]):
                x = rows[at, f]
                values = np.unique(x)
                for cut in (values[1:] + values[:-1]) / 2:
                    low = x <= cut
                    n, k = low.sum(), len(at)
                    if min(n, k - n) < least:
                        continue
                    a, b = y[low].mean(), y[~low].mean()
                    gain = whole - (n * 2 * a * (1 - a) + (k - n) * 2 * b * (1 - b)) / k
                    if gain > best[0] + 1e-12:
                        best = (gain, f, float(cut))
        if best[1] is not None:
            low = rows[at, best[1]] <= best[2]
            nodes[number][:2] = [best[1], best[2]]
            nodes[number][2] = grow(at[low], level + 1)
            nodes[number][3] = grow(at[~low], level + 1)
        return number

    grow(np.arange(len(rows)), 0)
    columns = list(zip(*nodes))
    ints = [np.array(columns[i], dtype=np.int64) for i in (0, 2, 3)]
    return Tree(ints[0], np.array(columns[1]), ints[1], ints[2], np.array(columns[4]))


def labelled_rows(pages: Sequence[tuple[str, Sequence[str]]]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of all blocks of (page, texts of its content blocks)."""
    rows, labels = [], []
    for page, content in pages:
        blocks = blocks_of(page)
        found = [b.text in set(content) for b in blocks]
        missing = set(content) - {b.text for b in blocks}
        if missing:
            raise ValueError(f"a labelled text is no block of its page: {sorted(missing)[0]!r}")
        rows.append(features([blocks]))
        labels += found
    return np.vstack(rows), np.array(labels, dtype=np.float64)


def main_texts(pages: Sequence[str | None], tree: Tree) -> list[str]:
    """Main text of each page."""
    cut = [blocks_of(page) if page else [] for page in pages]
    if not any(cut):
        return [""] * len(cut)
    kept = iter(tree.content(features(cut)).tolist())
    return ["\n".join([b.text for b in blocks if next(kept)]) for blocks in cut]


def extract_main_text(pages: DataFrame, tree: Tree) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            page, texts = batch.column(2), []
            for at in range(0, len(page), _PAGES):
                texts += main_texts(page.slice(at, _PAGES).to_pylist(), tree)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kind = dict(pages.dtypes)["page_id"]
    made = pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string")
    return made.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
