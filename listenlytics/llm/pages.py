"""Main text of web pages by the consensus of each host's pages.

Each page scores its containers and votes for the best one's path, a chain of tags and
classes without numbers. Spark adds the votes up by host. Then every page is read again and
gives the text of the container on the most voted path that it has; a page without any of
its host's paths uses its own best container.
"""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_work_folder
from ..staging import written
from .hosts import host_of
from .words import small_batches

MIN_VOTE_SHARE = 0.05
BROADCAST_BYTES = 32 << 20

# Kinds of elements, and class words of what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
LEFT_OUT = frozenset(
    "aside button canvas dialog footer form head header iframe map menu nav noscript object "
    "option script select style svg template textarea title".split()
)
CONTAINERS = frozenset("article body div main section td".split())
NEVER_LEFT_OUT = frozenset("html body main article".split())
CLOSED_BY_BLOCK = "p"
CLOSED_BY_SAME = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
SIDE_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|sidebar|side|nav\w*|menu|breadcrumbs?|"
    r"header|footer|masthead|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|"
    r"subscri\w*|comments?|replies|respond|discussion|social|share|sharing|related|recommend\w*|"
    r"widget|toolbar|pag(?:er|ination)|login|signup|search|skip|copyright|legal|disclaimer|hidden)"
    r"(?:$|[\s_-])",
    re.IGNORECASE,
)
# Words of what a layout has or lacks, which say nothing of the element itself.
MODIFIED = re.compile(r"(?:^|(?<=[\s_-]))(?:has|no|not|with|without)[_-]\S*", re.IGNORECASE)
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)"
    r"|<(?P<raw>script|style|textarea|title|noscript|template|iframe|svg)\b[^>]*>.*?(?:</(?P=raw)\s*>|$)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?][^>]*>"
    r"|(?P<text>[^<]+|<)",
    re.IGNORECASE | re.DOTALL,
)
_NO_TAG = re.compile(
    r"<!--.*?(?:-->|$)"
    r"|<(?P<raw>script|style|textarea|title|noscript|template|iframe|svg)\b[^>]*>.*?(?:</(?P=raw)\s*>|$)"
    r"|<[!?][^>]*>"
    r"|(?P<close>(?!))|(?P<tag>(?!))|(?P<attributes>(?!))"
    r"|(?P<text>[^<]+|<)",
    re.IGNORECASE | re.DOTALL,
)
_AFTER_TAGS = re.compile(r"<!--.*?(?:-->|$)|(?P<close>(?!))|(?P<tag>(?!))|(?P<text>[^<]+|<)", re.DOTALL)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_NUMBER = re.compile(r"[0-9]+")
_MARK = re.compile("[>'\"]")
MAX_LONE = 8
MAX_PATH = 512


def _closes(source: str) -> Callable[[int], bool]:
    """Whether a tag that opens at a place has a ``>`` outside of quotes, for any place.

    From each ``>`` and quote on it is known what follows, found once from the right.
    """
    marks = [(m.start(), m[0]) for m in _MARK.finditer(source)]
    places = [place for place, _ in marks]
    good = [False] * (len(marks) + 1)
    later = {"'": -1, '"': -1}  # the next quote of a kind, as its number
    for k in range(len(marks) - 1, -1, -1):
        mark = marks[k][1]
        if mark == ">":
            good[k] = True
        else:
            good[k] = later[mark] >= 0 and good[later[mark] + 1]
            later[mark] = k
    return lambda place: good[bisect_right(places, place)]


def tokens(source: str) -> Iterator[re.Match[str]]:
    """The tags, comments and stretches of text of a page, in linear time.

    A tag without its ``>`` is text. Trying that for each of many unclosed tags reads on to
    the end every time, so after some of them it is looked up first.
    """
    last = source.rfind(">")
    place = lone = 0
    for token in _TOKEN.finditer(source, 0, len(source)) if last >= 0 else ():
        place = token.end()
        yield token
        lone += token["text"] == "<"
        if place > last or lone > MAX_LONE:
            break
    closes = _closes(source) if place <= last else None
    while place < len(source):
        if place > last:
            pattern = _AFTER_TAGS
        elif source[place] == "<" and not closes(place):
            pattern = _NO_TAG
        else:
            pattern = _TOKEN
        token = pattern.match(source, place)
        place = token.end()
        yield token


@dataclass
class Element:
    tag: str
    path: str
    left_out: bool
    in_link: bool
    start: int  # the first block that may lie in it
    container: int = -1
    side: int = -1  # the innermost element with side words that it is or lies in
    owns_side: bool = False
    block: int = -1  # the place of the innermost open element that is not inline


@dataclass
class Side:
    """A block element with side words; ``above`` is the next one round it."""

    above: int
    start: int
    end: int = -1
    holds_head: bool = False


@dataclass
class Container:
    path: str
    depth: int
    start: int
    end: int = -1


@dataclass
class Page:
    """Blocks of text in page order with their linked characters, and the containers."""

    blocks: list[str] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    containers: list[Container] = field(default_factory=list)


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)}


def _is_side(tag: str, attributes: dict[str, str]) -> bool:
    """Left out by its kind, whatever it holds."""
    if tag in LEFT_OUT:
        return True
    if not attributes or tag in NEVER_LEFT_OUT:
        return False
    return "hidden" in attributes or attributes.get("role", "").lower() in SIDE_ROLES


def _has_side_words(tag: str, attributes: dict[str, str]) -> bool:
    if not attributes or tag in NEVER_LEFT_OUT:
        return False
    return any(SIDE_WORDS.search(MODIFIED.sub("", attributes.get(name, ""))) for name in ("class", "id"))


def _without_sides(page: Page, sides: list[Side]) -> Page:
    """The page without the blocks of side elements, except those that hold the article.

    These have a main or h1, the largest article, or more than half of the unlinked text of a
    page without an article or main elsewhere.
    """
    free = [0]
    for block, linked in zip(page.blocks, page.linked, strict=True):
        free.append(free[-1] + len(block) - linked)
    tagged = [(c.path.rpartition("/")[2].partition(".")[0], c) for c in page.containers]
    bodies = [(tag, c) for tag, c in tagged if tag in ("article", "main") and free[c.end] > free[c.start]]
    articles = [c for tag, c in bodies if tag == "article"]
    largest = max(articles, key=lambda c: free[c.end] - free[c.start], default=None)
    change = [0] * (len(page.blocks) + 1)
    for side in sides:
        holds_article = largest and side.start <= largest.start < largest.end <= side.end
        most = not bodies and 2 * (free[side.end] - free[side.start]) > free[-1]
        if not (side.holds_head or holds_article or most):
            change[side.start] += 1
            change[side.end] -= 1
    keep = [n == 0 for n in accumulate(change[:-1])]
    if all(keep):
        return page
    place = [0]
    for kept in keep:
        place.append(place[-1] + kept)
    containers = [Container(c.path, c.depth, place[c.start], place[c.end]) for c in page.containers]
    blocks, linked = ([x for x, kept in zip(xs, keep, strict=True) if kept] for xs in (page.blocks, page.linked))
    return Page(blocks, linked, containers)


def _bounded(path: str) -> str:
    """A path, or a digest that stands for a very long one, so that depth does not cost its square."""
    if len(path) <= MAX_PATH:
        return path
    return f"/#{hashlib.md5(path.encode('utf-8', 'replace'), usedforsecurity=False).hexdigest()}"


def read_page(source: str | None) -> Page:
    """The page's blocks and containers; without regard to side words when they leave nothing."""
    page, left_out = _read(source, True)
    return _read(source, False)[0] if left_out and not page.blocks else page


def _read(source: str | None, by_words: bool) -> tuple[Page, bool]:
    """One pass over the markup; unclosed and stray tags are taken as browsers mostly do.

    Also gives whether any element has side words.
    """
    page = Page()
    sides: list[Side] = []
    any_words = False
    stack: list[Element] = []
    open_tags: Counter[str] = Counter()
    parts: list[str] = []
    link_chars = 0

    def flush() -> None:
        nonlocal link_chars
        block = " ".join(html.unescape("".join(parts)).split())
        if block:
            page.blocks.append(block)
            page.linked.append(min(link_chars, len(block)))
        parts.clear()
        link_chars = 0

    def close(depth: int) -> None:
        """Close all open elements from ``depth`` on."""
        flush_needed = any(e.tag not in INLINE for e in stack[depth:])
        if flush_needed:
            flush()
        for element in stack[depth:]:
            open_tags[element.tag] -= 1
            if element.container >= 0:
                page.containers[element.container].end = len(page.blocks)
            if element.owns_side:
                sides[element.side].end = len(page.blocks)
        del stack[depth:]

    for token in tokens(source or ""):
        text = token["text"]
        if text is not None:
            if not (stack and stack[-1].left_out):
                parts.append(text)
                if stack and stack[-1].in_link:
                    link_chars += len(text)
            continue
        if token["tag"] is None:
            continue
        tag = token["tag"].lower()
        if token["close"]:
            if open_tags[tag]:
                close(next(d for d in range(len(stack) - 1, -1, -1) if stack[d].tag == tag))
            elif tag not in INLINE:
                flush()
            continue
        if tag in VOID:
            if tag in ("br", "hr") and not (stack and stack[-1].left_out):
                parts.append(" ")
            continue
        inline = tag in INLINE
        if not inline:
            depth = stack[-1].block if stack else -1
            if depth >= 0:
                open_tag = stack[depth].tag
                if open_tag == CLOSED_BY_BLOCK or open_tag in CLOSED_BY_SAME.get(tag, ()):
                    close(depth)
            flush()
        attributes = _attributes(token["attributes"]) if token["attributes"] else {}
        above = stack[-1] if stack else None
        path = above.path if above else ""
        element = Element(
            tag,
            path,
            bool(above and above.left_out) or _is_side(tag, attributes),
            tag == "a" or bool(above and above.in_link and inline),
            len(page.blocks),
            side=above.side if above else -1,
        )
        if by_words and not element.left_out and _has_side_words(tag, attributes):
            any_words = True
            if inline:
                element.left_out = True
            elif not token["attributes"].endswith("/"):
                sides.append(Side(element.side, len(page.blocks)))
                element.side, element.owns_side = len(sides) - 1, True
        if tag in ("h1", "main") and not element.left_out:
            side = element.side
            while side >= 0 and not sides[side].holds_head:
                sides[side].holds_head = True
                side = sides[side].above
        if tag in CONTAINERS:
            words = sorted(_NUMBER.sub("0", attributes.get("class", "")).lower().split())
            element.path = f"{_bounded(path)}/{'.'.join([tag, *words])}"
            if not element.left_out:
                element.container = len(page.containers)
                page.containers.append(Container(element.path, len(stack), len(page.blocks)))
        if not token["attributes"].endswith("/"):
            element.block = (above.block if above else -1) if inline else len(stack)
            stack.append(element)
            open_tags[tag] += 1
    close(0)
    flush()
    return (_without_sides(page, sides) if sides else page), any_words


BONUS = {"article": 1.6, "main": 1.4, "body": 0.7}


NEAR = 0.98


def best_container(page: Page) -> tuple[str, float] | None:
    """The path and score of the container with the most unlinked text, articles preferred.

    Of containers round the best one that score nearly the same the one with the most unlinked
    text counts, and in it the innermost that still holds all its blocks with unlinked text.
    """
    total, links, free_blocks = [0], [0], [0]
    for block, linked in zip(page.blocks, page.linked, strict=True):
        total.append(total[-1] + len(block))
        links.append(links[-1] + linked)
        free_blocks.append(free_blocks[-1] + (linked < len(block)))
    scored = []
    for c in page.containers:
        size = total[c.end] - total[c.start]
        if size:
            unlinked = size - (links[c.end] - links[c.start])
            bonus = BONUS.get(c.path.rpartition("/")[2].partition(".")[0], 1.0)
            scored.append((unlinked * unlinked / size * bonus, c, unlinked, bonus))
    if not scored:
        return None
    score, top, _, bonus = max(scored, key=lambda x: (x[0], x[1].depth))
    near = [x for x in scored if x[0] >= NEAR * score]
    outer = max(
        (x for x in near if x[3] == bonus and x[1].start <= top.start and top.end <= x[1].end),
        key=lambda x: (x[2], x[1].depth),
    )[1]
    whole = free_blocks[outer.end] - free_blocks[outer.start]
    score, inner, *_ = max(
        (
            x
            for x in near
            if outer.start <= x[1].start
            and x[1].end <= outer.end
            and free_blocks[x[1].end] - free_blocks[x[1].start] == whole
        ),
        key=lambda x: (x[1].depth, x[0]),
    )
    return inner.path, score


def text_on_path(page: Page, paths: list[str]) -> tuple[str, str | None]:
    """The text on the first of ``paths`` that the page has text on, and that path.

    The page's own best container stands behind them, and behind that the whole page. It goes
    before a path inside it when its host's pages have voted for both.
    """
    own = best_container(page)

    def widened(path: str) -> str:
        return own[0] if own and own[0] in paths and path.startswith(f"{own[0]}/") else path

    for path in [*map(widened, paths), *([own[0]] if own else [])]:
        blocks, last = [], 0
        for c in page.containers:
            if c.path == path and c.end > max(c.start, last):
                blocks += page.blocks[max(c.start, last) : c.end]
                last = c.end
        if blocks:
            return " ".join(blocks), path
    return " ".join(page.blocks), None


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, paths): the paths with at least a twentieth of a host's votes, most votes first."""
    small_batches(pages.sparkSession)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple[str, str], int] = {}
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                best = best_container(read_page(source))
                if best:
                    counts[host, best[0]] = counts.get((host, best[0]), 0) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([host for host, _ in counts], pa.string()),
                    pa.array([path for _, path in counts], pa.string()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                names=["host", "path", "votes"],
            )

    source = pages.select(
        host_of(F.col(url_col).cast("string")).alias("host"), F.col(html_col).cast("string").alias("html")
    )
    votes = (
        source.mapInArrow(vote, "host string, path string, votes long")
        .groupBy("host", "path")
        .agg(F.sum("votes").alias("votes"))
    )
    totals = votes.groupBy("host").agg(F.sum("votes").alias("total"))
    chosen = votes.join(totals, "host").where(F.col("votes") >= MIN_VOTE_SHARE * F.col("total"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("less"), "path")))
    return chosen.groupBy("host").agg(ranked.alias("ranked")).select("host", F.col("ranked.path").alias("paths"))


def extract_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(``id_col``, ``url_col``, text, n_chars, path) of every page.

    Null html counts as empty and gives the empty text. One row for each input row, repeated
    rows and null ids included; null urls are pages of a host without a name.
    """
    small_batches(pages.sparkSession)
    url = F.col(url_col).cast("string")
    named = pages.select(
        F.col(id_col).alias("_id"), url.alias("_url"), host_of(url).alias("host"),
        F.col(html_col).cast("string").alias("_html"),
    )
    # hosts are far fewer than pages; only a measured table of paths is broadcast, larger ones shuffle
    paths = written(host_paths(pages, url_col, html_col), new_work_folder(pages.sparkSession, "paths"))
    size = paths.agg(F.sum(F.octet_length("host") + F.octet_length(F.array_join("paths", " ")) + 64)).first()[0]
    joined = named.join(F.broadcast(paths) if (size or 0) <= BROADCAST_BYTES else paths, "host", "left")
    fields = joined.select("_id", "_url").schema.add("text", "string").add("n_chars", "long").add("path", "string")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                text_on_path(read_page(source), paths or [])
                for source, paths in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([text for text, _ in found], pa.string()),
                    pa.array([len(text) for text, _ in found], pa.int64()),
                    pa.array([path for _, path in found], pa.string()),
                ],
                names=["_id", "_url", "text", "n_chars", "path"],
            )

    return (
        joined.select("_id", "_url", "_html", "paths")
        .mapInArrow(extract, fields)
        .withColumnsRenamed({"_id": id_col, "_url": url_col})
    )
