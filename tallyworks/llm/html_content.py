"""HTML extraction: the best contiguous region of words against tags.

A page is read as a line of tags and words. Words score by the block element they stand
in, above zero where content is, tags below zero, words in links or in boilerplate
elements below; the weights are log-odds from labelled pages (those with an article
element, whose label is that element; its own tag is withheld). One linear scan finds the
contiguous region of the highest sum. The blocks that overlap it, completed to the element
that encloses them all, are the main text, without elements that are never content.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm import lean, words

PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
NAME_PART = re.compile(r"[a-z]+")

# Element names by what they mean for text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp template".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol "
    "optgroup option p pre section select summary table tbody tfoot thead tr ul".split()
)
SPACED = frozenset("br td th img hr input".split())
NEVER = frozenset(
    "head nav footer aside form script style noscript iframe template svg math canvas object select "
    "button textarea dialog menu audio video".split()
)
NEVER_PARTS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "sidebar nav navbar navigation menu breadcrumb breadcrumbs footer comment comments disqus notice "
    "cookie cookies consent popup modal newsletter subscribe share sharing social related widget "
    "toolbar pager pagination masthead copyright disclaimer alert skip".split()
)
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu".split())
# An element of the left kind ends when one of the right kind begins.
ENDED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option", "optgroup"},
    "head": {"body"},
}
INSIDE_LIST = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
CONTAINERS = ("article", "main")
#: The tags whose weights are learned one by one; others share a weight.
KNOWN = sorted((BLOCKS | VOID | NEVER | {"a", "b", "i", "em", "strong", "span", "td", "th"}) - {"article", "main"})


#: Features of words begin so; the name of the block element around them follows.
WORD = "word:"


@dataclass(frozen=True)
class Weights:
    """Scores by feature: ``word``, ``word:`` by element, ``link``, ``never``, ``other`` and the tags."""

    of: dict[str, float]

    def score(self, feature: str) -> float:
        found = self.of.get(feature)
        if found is None:
            # A word in an element that was not learned.
            return self.of["word" if feature.startswith(WORD) else "other"]
        return found


DEFAULT = Weights({"word": 1.0, "link": -1.0, "never": -4.0, "other": -2.0})


@dataclass
class Block:
    """A run of text between block borders, its place in the line and its innermost block element."""

    text: list[str]
    element: int
    never: bool
    at: int
    stop: int = 0


class Elements:
    """The elements of a page, numbered as they begin, so that each holds a range of numbers.

    ``parent``: the block element around each; ``last``: the last number inside it, known
    once it has ended. What encloses what is then told without a walk.
    """

    def __init__(self):
        self.parent, self.last = [0], [0]

    def begin(self, parent: int) -> int:
        self.parent.append(parent)
        self.last.append(0)
        return len(self.parent) - 1

    def end(self, number: int) -> None:
        self.last[number] = len(self.parent) - 1

    def holds(self, outer: int, inner: int) -> bool:
        return outer <= inner <= self.last[outer]

    def around(self, inner: int) -> Iterator[int]:
        """The block elements around one, itself first, without the page."""
        while inner:
            yield inner
            inner = self.parent[inner]

    def shared(self, inner: list[int]) -> list[int]:
        """The block elements around all of these, the outermost first."""
        low, high = min(inner), max(inner)
        return [e for e in self.around(low) if self.holds(e, high)][::-1]


def is_never(name: str, attributes: str, inside_container: bool) -> bool:
    if name in NEVER or name == "header" and not inside_container:
        return True
    if name in ("html", "body", "article", "main") or "=" not in attributes:
        return False
    for m in ATTRIBUTE.finditer(attributes):
        value = (m[2] or m[3] or m[4] or "").lower()
        if m[1].lower() == "role":
            if value.strip() in NEVER_ROLES:
                return True
        elif not NEVER_PARTS.isdisjoint(NAME_PART.findall(value)):
            return True
    return False


def read_page(page: str):
    """Features of the line of tags and words, the blocks, the containers and all elements.

    Gives (features, counts, inside, blocks, containers, elements): the feature and number of
    words at each place, whether it lies in a container, and element numbers of the
    containers. Linear in the page, however deep it is and whatever is left open.
    """
    features: list[str] = []
    counts: list[int] = []
    inside: list[bool] = []
    blocks: list[Block] = []
    containers: set[int] = set()
    elements = Elements()
    stack: list[tuple[str, int, bool]] = []  # name, number, never
    # Where in the stack the open elements of each name are, and those that are blocks.
    open_at: dict[str, list[int]] = defaultdict(list)
    blocks_at: list[int] = []
    held = links = never = 0
    open_block: Block | None = None

    def note(feature: str, count: int = 1) -> None:
        features.append(feature)
        counts.append(count)
        inside.append(held > 0)

    def innermost() -> int:
        return stack[blocks_at[-1]][1] if blocks_at else 0

    def text(raw: str) -> None:
        nonlocal open_block
        if not raw:
            return
        value = html.unescape(raw) if "&" in raw else raw
        if open_block is None:
            if not value.strip():
                return
            open_block = Block([], innermost(), never > 0, len(features))
            blocks.append(open_block)
        open_block.text.append(value)
        n = len(value.split())
        if n:
            around = stack[blocks_at[-1]][0] if blocks_at else "body"
            place = WORD + (around if around not in CONTAINERS else "other")
            note("never" if never else "link" if links else place, n)
            open_block.stop = len(features)

    def pop_to(size: int) -> None:
        nonlocal never, held, links
        while len(stack) > size:
            name, own, hidden = stack.pop()
            open_at[name].pop()
            if name in BLOCKS:
                blocks_at.pop()
            elements.end(own)
            never -= hidden
            held -= own in containers
            links -= name == "a"

    position, end = 0, len(page)
    while position < end:
        m = PIECE.search(page, position)
        if m is None:
            text(page[position:])
            break
        text(page[position : m.start()])
        position = m.end()
        name = m[2]
        if name is None:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        name = name.lower()
        border = name in BLOCKS
        if border:
            open_block = None
        elif name in SPACED and open_block is not None:
            open_block.text.append(" ")
        if m[1]:
            note(name if name not in CONTAINERS else "other")
            if open_at[name]:
                pop_to(open_at[name][-1])
            continue
        if name in RAW and not m[3].endswith("/"):
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(page, position)
            note(name)
            position = close.end() if close else end
            continue
        if border and blocks_at and stack[blocks_at[-1]][0] == "p":
            # A paragraph ends where another block begins, with what is open in it.
            pop_to(blocks_at[-1])
        for ended, by in ENDED_BY.items():
            if name in by and open_at[ended]:
                stops = max((open_at[stop][-1] for stop in INSIDE_LIST.get(ended, ()) if open_at[stop]), default=-1)
                if open_at[ended][-1] > stops:
                    pop_to(open_at[ended][-1])
        note(name if name not in CONTAINERS else "other")
        if name in VOID or m[3].endswith("/") and name not in BLOCKS:
            continue
        own = elements.begin(innermost())
        hidden = is_never(name, m[3], held > 0)
        open_at[name].append(len(stack))
        if border:
            blocks_at.append(len(stack))
        stack.append((name, own, hidden))
        never += hidden
        links += name == "a"
        if name in CONTAINERS and not never:
            containers.add(own)
            held += 1
    pop_to(0)
    return features, counts, inside, blocks, containers, elements


def best_region(scores: np.ndarray) -> tuple[int, int]:
    """First place and end of the contiguous run of the highest sum; of ties the first, longest."""
    best, best_at, total, begin = 0.0, (0, 0), 0.0, 0
    for k, score in enumerate(scores.tolist()):
        if total <= 0:
            total, begin = 0.0, k
        total += score
        if total > best:
            best, best_at = total, (begin, k + 1)
    return best_at


def main_text(page: str, weights: Weights = DEFAULT) -> str:
    """The main text of a page; empty if no region scores above zero."""
    features, counts, _, blocks, containers, elements = read_page(page)
    if not blocks:
        return ""
    scores = np.array([weights.score(f) * n for f, n in zip(features, counts)])
    first, end = best_region(scores)
    chosen = [b for b in blocks if not b.never and b.at < end and b.stop > first]
    if not chosen:
        return ""
    shared = elements.shared([b.element for b in chosen])
    # The innermost container around the region, else the element around all its
    # blocks unless that is the page itself.
    held = [e for e in shared if e in containers]
    around = held[-1] if held else most_common_container(chosen, containers, elements)
    if around is None and len(shared) > 2:
        around = shared[-1] if len(chosen) > 1 else shared[-2]
    if around is not None:
        chosen = [b for b in blocks if not b.never and elements.holds(around, b.element)]
    texts = (" ".join("".join(b.text).split()) for b in chosen)
    return "\n".join(t for t in texts if t)


def most_common_container(chosen: list[Block], containers: set[int], elements: Elements) -> int | None:
    """The container that holds most of the region's characters, if over half of them."""
    lengths = [(b.element, sum(map(len, b.text))) for b in chosen]
    # Blocks come in the order of their elements' numbers only on tidy pages.
    lengths.sort()
    numbers, sums = [e for e, _ in lengths], [0, *accumulate(n for _, n in lengths)]
    size = {
        c: sums[bisect_right(numbers, elements.last[c])] - sums[bisect_left(numbers, c)] for c in containers
    }
    size = {c: n for c, n in size.items() if n}
    if not size:
        return None
    most = max(size, key=lambda e: (size[e], e))
    return most if 2 * size[most] > sums[-1] else None


def learn(pages: DataFrame, html_col: str = "html") -> Weights:
    """Weights from all pages with exactly one container element.

    Counted per feature, inside and outside the container, by Spark; only one row
    per known feature reaches the driver. Without such pages: ``DEFAULT``.
    """
    known = {*KNOWN, "link", "never", WORD + "other", *(WORD + name for name in BLOCKS)}

    @lean.released
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list[int]] = defaultdict(lambda: [0, 0])
            for page in batch.column(0):
                features, numbers, inside, _, containers, _ = read_page(page.as_py() or "")
                if len(containers) == 1:
                    for f, n, held in zip(features, numbers, inside):
                        found[f if f in known else "other"][not held] += n
            columns = ([*found], [a for a, _ in found.values()], [b for _, b in found.values()])
            types = (pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, types)], names=["feature", "a", "b"]
            )

    counted = pages.select(F.col(html_col).cast("string")).mapInArrow(count, "feature string, a long, b long")
    rows = counted.groupBy("feature").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect()
    spoken = [r for r in rows if r.feature.startswith(WORD) or r.feature in ("link", "never")]
    tags = [r for r in rows if r not in spoken]

    def odds(some: list) -> dict[str, float]:
        n_in, n_out = sum(r.a for r in some), sum(r.b for r in some)
        if not n_in or not n_out:
            return {}
        return {r.feature: float(np.log((r.a + 1) / (n_in + 1) * (n_out + 1) / (r.b + 1))) for r in some}

    of_words, of_tags = odds(spoken), odds(tags)
    if not of_words or not of_tags:
        return DEFAULT
    # A word counts half at most, so that a few words behind two borders outside stay outside.
    weights = {f: min(-0.5, v) for f, v in of_tags.items()}
    weights |= {f: float(np.clip(v, -0.5, 0.5)) for f, v in of_words.items() if f not in ("link", "never")}
    weights["link"] = min(-0.5, of_words.get("link", -1.0)) if of_words.get("link", -1) < 0 else 0.1
    return Weights({"other": -2.0, **weights, "word": 0.5, "never": -4.0})


def extracted(page: Column, weights: Weights) -> Column:
    @F.arrow_udf("string")
    @lean.released
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            yield pa.array((main_text(p.as_py() or "", weights) for p in pages), type=pa.string())

    return extract(page)


def extract_pages(
    pages: DataFrame, weights: Weights, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    Null and empty pages give an empty text; repeated rows and null ids stay;
    further columns are left behind. No shuffle.
    """
    made = pages.select(
        F.col(id_col), F.col(url_col), extracted(words.text_or_empty(html_col), weights).alias("text")
    )
    return made.withColumn("n_chars", F.length("text").cast("long"))
