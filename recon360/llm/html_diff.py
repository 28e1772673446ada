"""Main text of web pages by differencing with the page of the nearest URL.

Pages of a host with the same lines are one page. The different pages are put in the order of their URL
paths; each is paired with the nearest of the pages around it, the one whose path begins like its own for
longest. The lines of both (one per block element) are aligned by a longest common subsequence, and what
both have is template and goes. Lines inside an ``article`` or ``main`` element are held against the
template as a whole: two articles may quote the same passage, so such an element goes only where the
neighbour has all of it and the page has another, and one of its lines only where the pages around agree.
Menus, forms and the like that differ from page to page go by what their elements say they are.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter, deque
from collections.abc import Iterator, Sequence, Set
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recon360.llm.common import pick, text_slices
from recon360.sources.store import TableStore

# Pages that share more of their text than this may be near copies: the page around that shares least is
# asked instead. Lines that hold more of an article than this are no template.
COPY_SHARE = 0.5
# Different pages looked at on either side of a page.
REACH = 2

# --- blocks of a page; the sets are fixed values: names from the HTML standard and common class names

RAW = "script|style|noscript|template|iframe|object|textarea|select|canvas|audio|video"
FOREIGN = {"svg", "math"}
# Elements of HTML inside of those, and start tags that end an open one.
INTEGRATED = {"foreignobject", "annotation-xml"}
BREAKS_OUT = {
    "blockquote", "body", "center", "dd", "div", "dl", "dt", "h1", "h2", "h3", "h4", "h5", "h6", "head", "hr", "li", "menu",
    "ol", "p", "pre", "table", "ul",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
    "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary",
    "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul",
}
MAIN = {"article", "main"}
NEVER = {"head", "title", "nav", "footer", "aside", "form", "menu", "dialog", "search", "button", "label"}
ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu",
    "menubar", "toolbar",
}
CLASSES = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
    "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "masthead", "menu", "modal", "nav", "navbar",
    "navigation", "newsletter", "notice", "notification", "pagination", "pager", "popup", "promo", "promotion", "related",
    "replies", "respond", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar",
    "widget",
    "ad-banner", "ad-box", "ad-container", "ad-slot", "ad-unit", "ad-wrapper", "comment-form", "comment-list", "comment-respond",
    "comments-area", "comments-section", "cookie-banner", "cookie-bar", "cookie-consent", "cookie-notice", "footer-widgets",
    "main-menu", "main-nav", "main-navigation", "nav-bar", "nav-links", "nav-menu", "newsletter-signup", "page-footer",
    "post-navigation", "related-articles", "related-posts", "share-buttons", "sharing-buttons",
    "site-footer", "site-header", "site-nav", "site-navigation", "social-links", "social-media", "social-share", "widget-area",
}

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|</[^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([a-z][a-z-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b", re.I)
_JOINT = re.compile(r"[_-]+")


def _names(value: str) -> set[str]:
    """The class names of a value, as written but for the case and the way their parts are joined."""
    return {_JOINT.sub("-", name).strip("-") for name in value.split()}


def _unwanted(tag: str, attributes: str, in_main: bool) -> bool:
    """Whether what an element says of itself makes it no text."""
    if tag in NEVER or (tag == "header" and not in_main):
        return True
    if not attributes or tag in MAIN or tag in ("html", "body"):
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values[:3]).lower()
        if values[3] or (name == "aria-hidden" and value == "true"):
            return True
        if name in ("class", "id") and CLASSES & _names(value):
            return True
        if name == "role" and value in ROLES or name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


@dataclass(frozen=True)
class Line:
    text: str
    main: int  # number of the outermost article or main element it is in, 0 for none
    unwanted: bool


class _Element:
    """An unwanted element: what it holds may show that its name means something else."""

    def __init__(self, tag: str):
        self.weak = tag == "form" or tag not in NEVER | {"header"}  # judged by attributes, or a form
        self.holds_main = self.holds_article = False
        self.characters = 0
        self.holds = True


def _believe(found: list[tuple[str, int, tuple[_Element, ...]]]) -> None:
    """Decide which unwanted elements are so.

    One that holds a ``main`` element is not. Where no article is left, neither is one that holds an
    article, nor one known by its attributes, or a form, that holds more than half of the page's text.
    """
    elements = {id(e): e for _, _, around in found for e in around}.values()
    for e in elements:
        e.holds = not e.holds_main
    if any(main and not any(e.holds for e in around) for _, main, around in found):
        return
    whole = 0
    for text, _, around in found:
        if all(e.weak for e in around if e.holds):
            whole += len(text)
            for e in around:
                e.characters += len(text)
    for e in elements:
        e.holds = e.holds and not e.holds_article and not (e.weak and 2 * e.characters > whole)


def lines(page: str | None) -> list[Line]:
    """The blocks of a page with text, in order. Character references decoded, white space collapsed."""
    found: list[tuple[str, int, tuple[_Element, ...]]] = []
    stack: list[tuple[str, _Element | None, bool]] = []  # tag, itself if unwanted, begins a main element
    around: tuple[_Element, ...] = ()  # the unwanted elements that are open
    parts: list[str] = []
    mains = in_main = 0
    foreign: list[str] = []  # open elements of a drawing or formula, which has no text

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            found.append((text, mains if in_main else 0, around))

    def pop(to: int) -> None:
        nonlocal around, in_main
        while len(stack) > to:
            _, bad, main = stack.pop()
            around = around[:-1] if bad else around
            in_main -= main

    source, at = page or "", 0
    for token in _TOKEN.finditer(source):
        if not foreign:
            parts.append(source[at : token.start()])
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        alone = not token["close"] and token["attributes"].endswith("/")
        if foreign and tag in BREAKS_OUT and not token["close"] and not INTEGRATED & set(foreign):
            foreign.clear()
        if foreign or tag in FOREIGN:
            if token["close"]:
                if tag in foreign:
                    del foreign[len(foreign) - 1 - foreign[::-1].index(tag) :]
            elif not alone and (tag in FOREIGN or tag in INTEGRATED):
                foreign.append(tag)
            continue
        if tag == "br":
            parts.append(" ")
        if tag in BLOCK:
            flush()
        if token["close"]:
            place = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if place is not None:
                pop(place)
            continue
        if tag in BLOCK:  # a block ends an open paragraph; an item ends the item before it
            ended = {"p"} | ({tag} if tag in ("li", "dd", "dt", "tr", "td", "th") else set()) | ({"head"} if tag == "body" else set())
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ended:
                    pop(i)
                    break
                if stack[i][0] in BLOCK:
                    break
        if tag in VOID:
            continue
        for e in around if tag in MAIN else ():
            e.holds_main |= tag == "main"
            e.holds_article |= tag == "article"
        main = tag in MAIN and not in_main
        bad = _Element(tag) if _unwanted(tag, token["attributes"], in_main > 0) else None
        mains += main
        in_main += main
        around = (*around, bad) if bad else around
        stack.append((tag, bad, main))
    if not foreign:
        parts.append(source[at:])
    flush()
    _believe(found)
    return [Line(text, main, any(e.holds for e in inside)) for text, main, inside in found]


def line_hashes(page: str | None) -> list[int]:
    return [xxhash.xxh64_intdigest(line.text.encode("utf-8", "surrogatepass")) - (1 << 63) for line in lines(page)]


# --- differencing


# Bits of rows that an alignment keeps at once; larger ones are halved first.
ROW_BITS = 1 << 28


def common_lines(a: Sequence[int], b: Sequence[int]) -> set[int]:
    """Positions in ``a`` of a longest common subsequence, by bit vectors (Hyyro's recurrence): a step for
    each line of ``a`` whatever repeats, and memory in proportion to both."""
    first, last = 0, 0
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    kept = {*range(first), *range(len(a) - last, len(a))}
    both = set(a[first : len(a) - last]) & set(b[first : len(b) - last])
    places = [i for i in range(first, len(a) - last) if a[i] in both]
    found = _aligned([a[i] for i in places], [x for x in b[first : len(b) - last] if x in both])
    return kept | {places[i] for i in found}


class _Masks(dict):
    """The places of a line in ``b`` as bits."""

    def __init__(self, b: Sequence[int]):
        self.at: dict[int, list[int]] = {}
        for j, x in enumerate(b):
            self.at.setdefault(x, []).append(j)

    def __missing__(self, x: int) -> int:
        found = self.at.get(x, ())
        mask = 0
        for j in found:
            mask |= 1 << j
        if len(found) > 64:  # few lines can have that many places
            self[x] = mask
        return mask


def _rows(a: Sequence[int], b: Sequence[int]) -> Iterator[int]:
    """After each line of ``a`` a vector whose zeros are where a prefix of ``b`` has one more line in common."""
    masks, every = _Masks(b), (1 << len(b)) - 1
    row = every
    for x in a:
        mask = masks[x]
        row = ((row + (row & mask)) | (row & ~mask)) & every
        yield row


def _aligned(a: Sequence[int], b: Sequence[int]) -> list[int]:
    if not a or not b:
        return []
    if len(a) > 1 and len(a) * len(b) > ROW_BITS:
        middle = len(a) // 2
        cut = _best_cut(a[:middle], a[middle:], b)
        return _aligned(a[:middle], b[:cut]) + [middle + i for i in _aligned(a[middle:], b[cut:])]
    rows = list(_rows(a, b))
    found = []
    i, j = len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                found.append(i)
                j -= 1
    return found[::-1]


def _best_cut(head: Sequence[int], tail: Sequence[int], b: Sequence[int]) -> int:
    """Where to cut ``b`` so that both halves together have most in common."""
    before, after = (_common_by_length(x, y) for x, y in ((head, b), (tail[::-1], b[::-1])))
    return int(np.argmax(before + after[::-1]))


def _common_by_length(a: Sequence[int], b: Sequence[int]) -> np.ndarray:
    """Lines in common with each prefix of ``b``, the empty one first."""
    row = 0
    for row in _rows(a, b):
        pass
    data = np.frombuffer(row.to_bytes(-(-len(b) // 8), "little"), np.uint8)
    zeros = 1 - np.unpackbits(data, bitorder="little")[: len(b)].astype(np.int64)
    return np.concatenate(([0], np.cumsum(zeros)))


def _alike(path: str, other: str) -> int:
    n = 0
    for x, y in zip(path, other, strict=False):
        if x != y:
            break
        n += 1
    return n


def shared_lines(page: list[Line], path: str, neighbours: Sequence[tuple[str, Sequence[int]]]) -> set[int]:
    """Positions of the template's lines: those that the nearest page around has too.

    A page that shares more than ``COPY_SHARE`` of the text may be a near copy or have little text of its
    own. If all do, the one that shares least tells the template, unless either side has no line besides.
    """
    own = [xxhash.xxh64_intdigest(line.text.encode("utf-8", "surrogatepass")) - (1 << 63) for line in page]
    wanted = {i for i, line in enumerate(page) if not line.unwanted}
    whole = sum(len(page[i].text) for i in wanted)
    least: tuple[int, set[int]] | None = None
    for _, hashes in sorted(neighbours, key=lambda n: -_alike(path, n[0])):
        found = common_lines(own, hashes)
        share = sum(len(page[i].text) for i in found & wanted)
        if share <= COPY_SHARE * whole:
            return found
        if wanted - found and len(found) < len(hashes) and (least is None or share < least[0]):
            least = share, found
    return least[1] if least else set()


def recurring_lines(page: list[Line], neighbours: Sequence[tuple[str, Sequence[int]]]) -> set[int]:
    """Positions of lines that most of the pages around have, and two at least."""
    own = [xxhash.xxh64_intdigest(line.text.encode("utf-8", "surrogatepass")) - (1 << 63) for line in page]
    around = [set(hashes) for _, hashes in neighbours]
    counts = [sum(h in others for others in around) for h in own]
    return {i for i, n in enumerate(counts) if n >= 2 and 2 * n > len(around)}


def main_text(page: list[Line], shared: set[int], recurring: Set[int] = frozenset()) -> str:
    """What is left when shared and unwanted lines have gone; blocks joined by an empty line.

    A line in an ``article`` or ``main`` element goes if it is shared and recurring, unless such lines hold
    more than ``COPY_SHARE`` of the element's text: then the pages around are near copies of it.
    """
    wanted = [i for i, line in enumerate(page) if not line.unwanted]
    mains = {page[i].main for i in wanted if page[i].main}
    if not mains:
        return "\n\n".join(page[i].text for i in wanted if i not in shared)
    own = {page[i].main for i in wanted if page[i].main and i not in shared}
    mains = own or mains  # an element the neighbour has whole is template, unless all are
    template = shared & recurring
    whole, common = Counter(), Counter()
    for i in wanted:
        whole[page[i].main] += len(page[i].text)
        common[page[i].main] += len(page[i].text) * (i in template)
    kept = {m for m in mains if common[m] > COPY_SHARE * whole[m]}
    return "\n\n".join(page[i].text for i in wanted if page[i].main in mains and (i not in template or page[i].main in kept))


# --- on Spark


def _hash_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        found = [line_hashes(p) for p in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(found, pa.list_(pa.int64()))],
            ["page", "host", "path", "hashes"],
        )


def _chain(batches: Iterator[pa.RecordBatch], reach: int) -> Iterator[pa.RecordBatch]:
    """Rows in URL order, each with the ``reach`` pages before and after it in the same partition and host,
    nearest first."""
    part, place = TaskContext.get().partitionId(), 0
    before: deque[tuple] = deque(maxlen=reach)  # nearest first
    waiting: deque[tuple] = deque()  # the row that is next and those after it

    def row() -> dict:
        nonlocal place
        host, path, page = waiting.popleft()
        after = list(waiting)[:reach]
        out = {
            "part": part, "place": place, "host": host, "path": path, "page": page,
            "previous": [b[2] if b[0] == host else None for b in before] + [None] * (reach - len(before)),
            "following": [a[2] if a[0] == host else None for a in after] + [None] * (reach - len(after)),
            "edge": place < reach or len(after) < reach,
        }
        before.appendleft((host, path, page))
        place += 1
        return out

    for batch in batches:
        out = []
        for item in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            waiting.append(item)
            if len(waiting) > reach:
                out.append(row())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_CHAIN)
    if waiting:
        yield pa.RecordBatch.from_pylist([row() for _ in range(len(waiting))], schema=_CHAIN)


_CHAIN = pa.schema(
    [
        ("part", pa.int32()), ("place", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("page", pa.int64()),
        ("previous", pa.list_(pa.int64())), ("following", pa.list_(pa.int64())), ("edge", pa.bool_()),
    ]
)


def neighbours(hashed: DataFrame, store: TableStore, reach: int = 1) -> DataFrame:
    """(page, other): each page with the ``reach`` pages before and after it in its host's order of paths.

    The pages are sorted once over the whole cluster, so a host of any size takes many tasks. The first
    and last pages of each sorted partition, a few rows per partition, are put together afterwards.
    """
    keys = hashed.select("host", "path", "page").distinct()
    ordered = keys.repartitionByRange("host", "path", "page").sortWithinPartitions("host", "path", "page")
    chain = store(
        "chain",
        ordered.mapInArrow(
            lambda batches: _chain(batches, reach),
            "part int, place long, host string, path string, page long, previous array<long>, following array<long>, edge boolean",
        ),
    )
    by_place = Window.orderBy("part", "place")  # over the edges of partitions alone
    steps = range(1, reach + 1)
    near = [(f, side, k) for f, side in ((F.lag, "previous"), (F.lead, "following")) for k in steps]
    edges = chain.where("edge").select(
        "page", "host", "previous", "following",
        *[f(name, k).over(by_place).alias(f"{side}_{name}_{k}") for f, side, k in near for name in ("page", "host")],
    )
    joined = edges.select(
        "page",
        F.array(
            *[
                F.coalesce(F.get(side, F.lit(k - 1)), F.when(F.col(f"{side}_host_{k}") == F.col("host"), F.col(f"{side}_page_{k}")))
                for _, side, k in near
            ]
        ).alias("others"),
    )
    both = chain.where("not edge").select("page", F.concat("previous", "following").alias("others")).unionByName(joined)
    return both.select("page", F.explode("others").alias("other")).where("other is not null")


def pack_lines(page: list[Line], press: zstandard.ZstdCompressor) -> bytes:
    """The lines of a page, compressed: they cross the network once and are less than the page with its markup."""
    marks = [2 * line.main + line.unwanted for line in page]
    texts = "\n".join(line.text for line in page)  # no line has a line end
    return press.compress(json.dumps([marks, texts], ensure_ascii=False, separators=(",", ":")).encode("utf-8", "surrogatepass"))


def unpack_lines(packed: bytes, unpress: zstandard.ZstdDecompressor) -> list[Line]:
    marks, texts = json.loads(unpress.decompress(packed).decode("utf-8", "surrogatepass"))
    return [Line(text, mark >> 1, bool(mark & 1)) for mark, text in zip(marks, texts.split("\n"), strict=bool(marks))]


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first column, a page, as its packed lines."""
    press = zstandard.ZstdCompressor(level=9)
    for batch in text_slices(batches):
        packed = pa.array([pack_lines(lines(p), press) for p in batch.column(0).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([packed, *batch.columns[1:]], ["packed", *batch.schema.names[1:]])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpress = zstandard.ZstdDecompressor()
    for batch in text_slices(batches):
        texts = []
        for packed, path, others in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
            found = unpack_lines(packed, unpress)
            near = [(o["path"], o["hashes"]) for o in others or ()]
            texts.append(main_text(found, shared_lines(found, path or "", near), recurring_lines(found, near)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def extract(pages: DataFrame, store: TableStore) -> DataFrame:
    """page_id, url, text and n_chars (code points), one row per page.

    A null or empty page has an empty text. A null URL, or one without a host, belongs to the host ''.
    Pages of a host with the same lines give a row each but are one page, at the first of their URLs, when
    it comes to what lies around it. Pages of a host that has no other page lose only what their own
    elements give away. Other columns are ignored.
    """
    rows = pick(pages, "page_id", "url", "html")
    filled = F.coalesce("url", F.lit(""))
    path = F.regexp_replace(F.regexp_replace(filled, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), r"[?#][\s\S]*$", "").alias("path")
    located = rows.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        "url",
        "html",
        F.xxhash64("page_id", "url", "html").alias("page"),
        F.lower(F.regexp_extract(filled, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        path,
    )
    hashed = store(
        "lines",
        located.select("page", "host", "path", "html").mapInArrow(
            _hash_pages, "page long, host string, path string, hashes array<long>"
        ),
    )
    # the first page of each host that has these lines stands for all of them
    digest = F.struct(F.xxhash64("hashes").alias("a"), F.hash("hashes").alias("b"), F.size("hashes").alias("n"))
    marked = hashed.select("page", "host", "path", digest.alias("digest"))
    first = marked.groupBy("host", "digest").agg(
        F.min(F.struct("path", "page")).alias("one"), (F.min("page") < F.max("page")).alias("copied")
    )
    first = store("first", first.select("host", "digest", "one.path", "one.page", "copied"))
    pairs = neighbours(first, store, REACH)
    each = hashed.groupBy("page").agg(F.first("path").alias("path"), F.first("hashes").alias("hashes"))  # repeated rows are equal

    def met_with(pairs: DataFrame) -> DataFrame:
        # four at most per page; the pages join them where they are put together, as the key is spread evenly
        return (
            pairs.join(each.withColumnRenamed("page", "other"), "other")
            .groupBy("page")
            .agg(F.array_sort(F.collect_list(F.struct("path", "hashes"))).alias("others"))
        )

    others = met_with(pairs)
    copied = first.where("copied")
    if not copied.isEmpty():  # written first, so that a large group of copies is split
        of_first = store("of_first", met_with(pairs.join(copied.select("page"), "page", "left_semi")).withColumnRenamed("page", "one"))
        copies = marked.join(copied.select("host", "digest", F.col("page").alias("one")), ["host", "digest"]).where("page <> one")
        others = others.unionByName(store("copies", copies.select("page", "one").distinct()).join(of_first, "one").select("page", "others"))
    kinds = "packed binary, page_id long, url string, page long"
    packed = located.select("html", "page_id", "url", "page").mapInArrow(_pack, kinds)
    met = packed.join(others, "page", "left")
    texts = met.select("page_id", "url", "packed", path, "others").mapInArrow(_extract, "page_id long, url string, text string")
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
