"""Main text of web pages: structure first, then differences to the page with the nearest URL.

Pages of a host share their frame. Every page is paired with the page whose path
is nearest in the order of paths of its host, the lines of both are aligned by
their longest common subsequence, and shared lines are frame unless the elements
around them say otherwise. Lines inside an article element are text whatever
their neighbour holds (copies of a page share every line), lines inside
navigation, footers, forms and the like never are, as adverts and footers may
differ from page to page; the alignment decides on the rest of the article's main
part, and on the rest of a page that has neither.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.workers import lists, steps
from sluice.operators.skew import hot_among, skew_join
from sluice.session import durable

# Where a line stands, the later the more likely it is main text: frame by element, frame by name, frame by a name of
# layout; no word on it; main part and article inside layout, main part, article inside layout of a main part, article.
FRAME, NAMED, LAYOUT, OPEN, HELD_MAIN, HELD, MAIN, INNER, ARTICLE = range(9)

# A path with fewer pages is no burden for one task.
HOT_PAGES = 1000

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Elements that never hold main text, and those that end a line.
DROPPED = set(
    "head script style noscript template svg math iframe object canvas audio video nav aside form button select "
    "textarea dialog menu".split()
)
PAGE_ONLY = {"header", "footer"}
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody "
    "tfoot thead title tr ul".split()
)
# Words of a class or id, and roles, that mark a part as frame.
MARKS = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo cookie cookies consent gdpr notice "
    "notices alert disclaimer popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs toolbar "
    "comment comments commentlist disqus respond replies share sharing social newsletter subscribe signup login search "
    "pagination pager related recommended widget skip footer masthead".split()
)
# Marks of parts whose articles are never the page's own; an article in a part of another mark may be.
FOREIGN = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo cookie cookies consent gdpr comment comments "
    "commentlist disqus respond replies related recommended".split()
)
# Words that may stand beside a mark in the name of such a part: with any other word the name means something else.
BESIDE = set(
    "area bar block bottom box button buttons container content form global group header icons inner item items left links "
    "list main outer page panel post posts primary right secondary section site slot top unit wrap wrapper".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ROLES = set("navigation banner complementary contentinfo search dialog alert alertdialog menu menubar form".split())
# Classes of an article element that is not the page's own, and frame whose end tag may be missing before it.
NOT_OWN = set("comment reply respond ad advert sponsored promo teaser related".split())
MAY_BE_UNCLOSED = {"nav", "header", "head", "menu"}
_WORDS = re.compile(r"[a-z]+")


def named(names: list[str]) -> int:
    """``NAMED`` or ``LAYOUT`` if one of the names consists of marks, ``OPEN`` if none does."""
    found = OPEN
    for name in names:
        words = set(_WORDS.findall(name))
        if not MARKS.isdisjoint(words) and words <= MARKS | BESIDE:
            found = min(found, LAYOUT if FOREIGN.isdisjoint(words) else NAMED)
    return found


class Lines(HTMLParser):
    """Lines of a page with where they stand."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, int]] = []
        self.open: list[tuple[str, int]] = []
        self.part: list[str] = []

    @property
    def place(self) -> int:
        return self.open[-1][1] if self.open else OPEN

    def flush(self) -> None:
        text = " ".join("".join(self.part).split())
        self.part.clear()
        if text:
            self.found.append((text, self.place))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.flush()
            if self.open and self.open[-1][0] == "p":
                self.open.pop()
            if tag in ("li", "dt", "dd", "tr", "option"):
                self._close(tag, within={"ul", "ol", "dl", "table", "select", "menu"})
        elif tag in ("br", "td", "th"):
            self.part.append(" ")
        if tag in VOID:
            return
        given = {k: v or "" for k, v in attrs}
        role, place = given.get("role"), self.place
        if (tag in ("article", "main") or role in ("main", "article")) and self._is_own(given):
            place = self._own_place(tag == "article" or role == "article")
        else:
            place = min(place, self._frame(tag, given, place))
            if place != self.place:
                self.flush()
        self.open.append((tag, place))

    def _is_own(self, given: dict[str, str]) -> bool:
        """An article of the page itself: no comment or teaser, and not inside frame that is closed properly."""
        outer = next((name for name, place in self.open if place in (FRAME, NAMED)), None)
        return (outer is None or outer in MAY_BE_UNCLOSED) and NOT_OWN.isdisjoint(given.get("class", "").lower().split())

    def _own_place(self, article: bool) -> int:
        around = {place for _, place in self.open}
        if LAYOUT not in around:
            return ARTICLE if article else MAIN
        if not article:
            return HELD_MAIN
        return HELD if around.isdisjoint({MAIN, INNER, ARTICLE}) else INNER

    def _frame(self, tag: str, given: dict[str, str], place: int) -> int:
        """What kind of frame an element is, ``ARTICLE`` if none. Names are the last to decide."""
        if tag in DROPPED or (tag in PAGE_ONLY and (place <= OPEN or tag == "footer")):
            return FRAME
        if tag in ("article", "main") and not self._is_own(given):
            return NAMED
        if tag in ("body", "html"):
            return ARTICLE
        if given.get("role") in ROLES or "hidden" in given or given.get("aria-hidden") == "true":
            return FRAME
        names = given.get("class", "").lower().split()
        # Inside an article, headings and sections have ids to link to, made of their words.
        if place not in (HELD, INNER, ARTICLE) or not (tag in HEADINGS or tag == "section"):
            names.append(given.get("id", "").lower())
        kind = named(names)
        return kind if kind < OPEN else ARTICLE

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        self._close(tag)

    def _close(self, tag: str, within: set[str] = frozenset()) -> None:
        """Leave the innermost open ``tag``, if there is one that no ``within`` shields."""
        for at in range(len(self.open) - 1, -1, -1):
            name, place = self.open[at]
            if name == tag:
                if place != (self.open[at - 1][1] if at else OPEN):
                    self.flush()
                del self.open[at:]
                return
            if name in within:
                return

    def handle_data(self, data: str) -> None:
        self.part.append(data)


def page_lines(html: str) -> list[tuple[str, int]]:
    """Lines of a page, white space made plain, each ``FRAME``, ``OPEN`` or ``ARTICLE``.

    Where a page has an article, lines of its main part beside the article are
    open, and where it has an article or main part, all others are frame. Where
    all lines are frame, those that are so by a class or id alone are open.
    """
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    best = max((place for _, place in parser.found), default=OPEN)
    if best <= OPEN:
        least = OPEN if best == OPEN else NAMED
        return [(text, OPEN if place >= least else FRAME) for text, place in parser.found]
    # Lesser articles and main parts inside layout are frame like the layout.
    return [(text, ARTICLE if place == best else OPEN if place == MAIN else FRAME) for text, place in parser.found]


def common(a: list[int], b: list[int]) -> np.ndarray:
    """Which items of ``a`` lie in a longest common subsequence with ``b``."""
    marks = np.zeros(len(a), dtype=bool)
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    marks[:head] = True
    marks[len(a) - tail :] = True
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    if not a or not b:
        return marks
    if len(a) > 1 and len(a) * len(b) > 1 << 28:
        # Halve the first list where both halves together share most.
        half = len(a) // 2
        ahead, back = _lengths(a[:half], b), _lengths(a[half:][::-1], b[::-1])[::-1]
        cut = int((ahead + back).argmax())
        marks[head : head + half] = common(a[:half], b[:cut])
        marks[head + half : head + len(a)] = common(a[half:], b[cut:])
        return marks
    rows = list(_rows(a, b))
    i, j = len(a), len(b)
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1:
            i -= 1
        else:
            i, j = i - 1, j - 1
            marks[head + i] = True
    return marks


def _rows(a: list[int], b: list[int]) -> Iterator[int]:
    """Rows of the alignment table as bits: a zero where the length grows by one."""
    where: dict[int, int] = {}
    for j, item in enumerate(b):
        where[item] = where.get(item, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    yield row
    for item in a:
        hit = row & where.get(item, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` with every head of ``b``."""
    for row in _rows(a, b):
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")
    return np.concatenate([[0], np.cumsum(1 - bits[: len(b)].astype(np.int64))])


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return F.lower(F.regexp_extract(url, pattern, 1)), F.rtrim(F.regexp_extract(url, pattern, 2), F.lit("/"))


def neighbours(paths: DataFrame) -> DataFrame:
    """``paths`` (``host``, ``path``, ``lines``; no path twice) with ``near``: lines of the nearest path of the host.

    The nearest is the one before or after in the order of paths that shares
    the longer head. The table is dealt by ranges, so that a host with very many
    paths is spread; the rows at the ends of ranges then see those next to them
    through a table of two rows per range.
    """
    dealt = durable(paths.repartitionByRange("host", "path").withColumn("part", F.spark_partition_id()))
    row = F.struct("host", "path", "lines")
    edges = dealt.groupBy("part").agg(F.min_by(row, F.struct("host", "path")).alias("low"), F.max_by(row, F.struct("host", "path")).alias("high"))
    ordered = Window.orderBy("part")
    edges = edges.select("part", F.lag("high").over(ordered).alias("ahead"), F.lead("low").over(ordered).alias("behind"))
    inside = Window.partitionBy("part").orderBy("host", "path")
    seen = dealt.withColumn("before", F.lag(row).over(inside)).withColumn("after", F.lead(row).over(inside))
    seen = seen.join(edges, "part", "left")
    before, after = F.coalesce("before", "ahead"), F.coalesce("after", "behind")

    def shared(other: Column) -> Column:
        """Characters of the path up to the first that differs; null for another host."""
        letters, theirs = F.split("path", ""), F.split(other["path"], "")
        same = F.zip_with(letters, theirs, lambda x, y: F.coalesce(x == y, F.lit(False)))
        length = F.array_position(same, False)
        return F.when(other["host"] == F.col("host"), F.when(length == 0, F.size(same)).otherwise(length - 1))

    closer = F.coalesce(shared(after), F.lit(-1)) > F.coalesce(shared(before), F.lit(-1))
    near = F.when(closer, after).when(shared(before).isNotNull(), before)
    return seen.select("host", "path", near["lines"].alias("near"))


def main_text(df: DataFrame, html_col: str, url_col: str, id_col: str) -> DataFrame:
    """``id_col``, ``url_col``, ``text`` and ``n_shared`` of every row.

    ``n_shared`` counts the lines that the alignment finds in the nearest page,
    too. Null and empty pages give an empty text. A block's white space becomes one
    space, blocks are joined by an empty line. A page without a readable URL
    counts to a host without name. Pages of one path (query and fragment aside)
    share a neighbour; a page whose host has no other path, or that holds the
    very lines of its neighbour, loses none of its open lines, unless it has an
    article or main part, which is its text then. Rows repeated or with null ids
    come back as they are. Further columns are not read.
    """
    host, path = host_and_path(F.col(url_col))
    rows = df.select(
        F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.coalesce(F.col(html_col), F.lit("")).alias("_html"),
        host.alias("host"), path.alias("path"),
    )
    kinds = ", ".join(f"{n} {df.schema[c].dataType.simpleString()}" for n, c in (("_id", id_col), ("_url", url_col)))

    def hashed(found: list[list[tuple[str, int]]]) -> pa.ListArray:
        return lists([np.array([xxhash.xxh64_intdigest(t) for t, _ in f], dtype=np.uint64).view(np.int64) for f in found], np.int64)

    def lines_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "_html"):
            found = [page_lines(h) for h in part.column("_html").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("host"), part.column("path"), hashed(found)], names=["host", "path", "lines"])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, names = zstandard.ZstdCompressor(level=3).compress, ["_id", "_url", "host", "path"]
        for part in steps(batches, "_html"):
            found = [page_lines(h) for h in part.column("_html").to_pylist()]
            # A line holds no line break, and the text of frame is never asked for.
            texts = [pack("\n".join(t for t, place in f if place != FRAME).encode()) for f in found]
            places = [np.array([place for _, place in f], dtype=np.int8) for f in found]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in names), hashed(found), pa.array(texts, pa.binary()), lists(places, np.int8)],
                names=[*names, "lines", "texts", "places"],
            )

    # Pages are parsed for the lines of their paths and again on the way to their neighbours': stored, their texts would
    # lie on disk twice.
    paths = rows.select("host", "path", "_html").mapInArrow(lines_of, "host string, path string, lines array<bigint>")
    # One page stands for all of a path.
    paths = paths.groupBy("host", "path").agg(
        F.max(F.struct(F.size("lines").alias("size"), "lines")).alias("top"), F.count(F.lit(1)).alias("pages")
    )
    paths = durable(paths.select("host", "path", "top.lines", "pages"))
    near = neighbours(paths.select("host", "path", "lines"))
    # Paths with over a 1024th of all pages (so at most 1024 of them) are dealt out by salts.
    total = paths.agg(F.sum("pages")).first()[0] or 0
    hot = hot_among(paths, ["host", "path"], "pages", total, floor=HOT_PAGES)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            texts, counts = [], []
            for packed, places, mine, theirs in zip(*(batch.column(c).to_pylist() for c in ("texts", "places", "lines", "near"))):
                shared = common(mine, theirs or [])
                counts.append(int(shared.sum()))
                if not theirs or (shared.all() and len(theirs) == len(mine)):
                    # The neighbour tells nothing: a page has its article, or all open lines.
                    shared[:] = ARTICLE in places
                own = iter(unpack(packed).decode().split("\n"))
                kept = ((next(own), place, s) for place, s in zip(places, shared) if place != FRAME)
                texts.append("\n\n".join(t for t, place, s in kept if place == ARTICLE or not s))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_url"), pa.array(texts, pa.string()), pa.array(counts, pa.int64())],
                names=["_id", "_url", "text", "n_shared"],
            )

    schema = f"{kinds}, host string, path string, lines array<bigint>, texts binary, places array<tinyint>"
    paired = skew_join(rows.mapInArrow(parse, schema), near, ["host", "path"], "left", hot=hot)
    paired = paired.select("_id", "_url", "texts", "places", "lines", "near")
    return paired.mapInArrow(cut, f"{kinds}, text string, n_shared long").withColumnsRenamed({"_id": id_col, "_url": url_col})
