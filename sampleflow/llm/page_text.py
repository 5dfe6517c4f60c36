"""Main text of web pages: every page compared with the nearest pages of its host, then checked by the elements around its lines."""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampleflow.llm.graph import kept, small
from sampleflow.llm.urls import host_and_path
from sampleflow.llm.words import give_back, pieces
from sampleflow.operators.ordering import KeyOrder, with_row_pos

# Names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
REMOVED = frozenset(
    "head nav aside footer form dialog menu search button select datalist object svg math canvas audio video map applet".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar widget footer header masthead cookie cookies consent gdpr notice notices popup modal newsletter "
    "subscribe share sharing social related recommended comment comments disqus respond replies pagination pager toolbar".split()
)
#: Names that say nothing about an article itself, or of what encloses a page.
UNMARKED = frozenset("html body main article h1 h2 h3 h4 h5 h6 p".split())
SPECIFIC = frozenset("ad ads advert advertisement sponsored promo related recommended comment comments".split())

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+>?|</?([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"?|'[^']*+'?)*+)>?|</[^>]*+>?", re.DOTALL
)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)|'([^']*)|([^\s\"'>]+))", re.IGNORECASE)
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.IGNORECASE) for name in RAW}

KEPT, OPEN, GONE = 2, 1, 0
#: Pages as alike as this are copies of each other, not pages of one frame.
COPIES = 0.8
#: Articles as alike as this are copies or versions of each other.
VERSIONS = 0.5
NEIGHBOURS = (-1, 1, -2, 2)
#: A line of articles is of the frame if so many percent of so many pages of a site or section, or more, share it with their nearest one.
FRAME_PERCENT, FRAME_PAGES = 90, 8
#: So many pages in URL order are compared together, which shapes the tasks and nothing else.
BLOCK = 32


def _marked(name: str, attributes: str) -> bool:
    """Whether an element's role, classes or id say that it is no main text."""
    for kind, *values in ATTRIBUTE.findall(attributes):
        for value in "".join(values).lower().split():
            if kind.lower() == "role":
                found = value in ROLES
            elif name in UNMARKED:
                found = name == "article" and value in SPECIFIC
            else:
                ends = re.split(r"[-_]+", value)
                found = ends[0] in MARKS or ends[-1] in MARKS and ends[0] not in ("no", "has", "with", "without")
            if found:
                return True
    return False


def page_lines(page: str) -> list[tuple[str, int]]:
    """The text blocks of a page in order, each ``KEPT``, ``OPEN`` or ``GONE`` by the elements around it.

    ``KEPT`` is inside an article (or ``main``, where a page has no article) and ``GONE`` inside
    menus, forms and the like, or outside the article of a page that has one. Tags need
    not be closed; a piece of a tag at the end of a page is markup.
    """
    lines: list[tuple[str, tuple]] = []
    text: list[str] = []
    # Each open element: its name and what holds inside it: (removed, by a form only, in an article, in main).
    stack: list[tuple[str, tuple]] = []
    opened: Counter = Counter()
    here, at, end = (False, False, False, False), 0, len(page)

    def close_block() -> None:
        if text:
            line = " ".join("".join(text).split())
            if line:
                lines.append((line, here))
            text.clear()

    while at < end:
        found = TOKEN.search(page, at)
        start = found.start() if found else end
        if start > at:
            text.append(html.unescape(page[at:start]))
        if not found:
            break
        at = found.end()
        if not found[1]:
            continue
        name = found[1].lower()
        if found[0][1] == "/":
            if name in BLOCKS or name in REMOVED:
                close_block()
            if name == "p" or not opened[name]:
                continue
            while True:
                top, _ = stack.pop()
                opened[top] -= 1
                if top in BLOCKS:
                    close_block()
                if top == name:
                    break
            here = stack[-1][1] if stack else (False, False, False, False)
            continue
        if name in BLOCKS or name in REMOVED:
            close_block()
        if name == "br":
            text.append(" ")
        if name in VOID or name == "p":
            continue
        if name in RAW:
            closing = RAW_END[name].search(page, at)
            at = closing.start() if closing else end
            continue
        removed, by_form, article, main = here
        if name in ("article", "main") and by_form:
            removed = by_form = False
        if not removed:
            by_form = name == "form"
            removed = (
                name in REMOVED
                or (name == "header" and not (article or main))
                or (_marked(name, found[2]) and not (name == "header" and (article or main)))
            )
        here = (removed, by_form and removed, article or name == "article", main or name == "main")
        stack.append((name, here))
        opened[name] += 1
    close_block()
    within = 2 if any(h[2] and not h[0] for _, h in lines) else 3 if any(h[3] and not h[0] for _, h in lines) else None
    return [
        (line, GONE if h[0] or (within and not h[within]) else KEPT if within else OPEN) for line, h in lines
    ]


def _prefix_lcs(a: list, b: list) -> np.ndarray:
    """The length of the longest common subsequence of ``a`` and each prefix of ``b``, by bits (Hyyro, 2004)."""
    places: dict = {}
    for i, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        match = row & places.get(x, 0)
        row = ((row + match) | (row - match)) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate(([0], np.cumsum(bits == 0)))


def common_lines(a: list, b: list) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``: halves are aligned apart (Hirschberg, 1975), in linear memory."""
    found: list[int] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            found.append(i)
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            found.append(j)
        if i == j or k == m:
            continue
        if j - i == 1:
            if a[i] in b[k:m]:
                found.append(i)
            continue
        half = (i + j) // 2
        ahead = _prefix_lcs(a[i:half], b[k:m])
        back = _prefix_lcs(a[half:j][::-1], b[k:m][::-1])[::-1]
        cut = k + int(np.argmax(ahead + back))
        todo += [(i, half, k, cut), (half, j, cut, m)]
    return sorted(found)


def _line_keys(lines: list[tuple[str, int]]) -> bytes:
    return b"".join(hashlib.blake2b(line.encode(), digest_size=16).digest() for line, _ in lines)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, "html"):
        pages = [page_lines(h or "") for h in piece.column("html").to_pylist()]
        keys = pa.array([_line_keys(lines) for lines in pages], pa.binary())
        zones = pa.array([bytes(zone for _, zone in lines) for lines in pages], pa.binary())
        yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in KEY), keys, zones], names=[*KEY, "lines", "zones"])


def _split(lines: bytes) -> list[bytes]:
    return [lines[i : i + 16] for i in range(0, len(lines), 16)]


def _nearest_first(others: list[dict]) -> list[dict]:
    """Who shares most of the path, then who is next in URL order, the earlier first."""
    return sorted(others, key=lambda o: (-o["near"], abs(o["step"]), o["step"]))


def shared_lines(lines: bytes, zones: bytes, others: list[dict]) -> bytes:
    """A 1 for each open line that the nearest page shares in order.

    Pages of which ``COPIES`` or more is common to both are passed over.
    """
    own = _split(lines)
    for theirs in _nearest_first(others):
        other = _split(theirs["lines"])
        common = common_lines(own, other)
        if common and 2 * len(common) < COPIES * (len(own) + len(other)):
            gone = set(common)
            return bytes(zone == OPEN and i in gone for i, zone in enumerate(zones))
        if not common:
            break
    return bytes(len(own))


def repeated_lines(lines: bytes, zones: bytes, others: list[dict]) -> tuple[bool, list[dict]]:
    """Whether a page with an article met another one, and the lines of the article that near pages share in order.

    Articles are aligned with what is not ``GONE`` in the near pages, the nearest first, up to the first
    page that is no copy or version; ``vote`` says which lines that one shares.
    """
    at = [i for i, zone in enumerate(zones) if zone == KEPT]
    every = _split(lines)
    own = [every[i] for i in at]
    seen: dict[int, bool] = {}
    met = False
    for theirs in _nearest_first(others):
        other = [line for line, zone in zip(_split(theirs["lines"]), theirs["zones"]) if zone != GONE]
        if not other:
            continue
        common = common_lines(own, other)
        met = 2 * len(common) < VERSIONS * (len(own) + len(other))
        seen |= dict.fromkeys(common, met)
        if met:
            break
    return met, [{"i": at[k], "line": own[k], "vote": vote} for k, vote in sorted(seen.items())]


REPEATED = pa.list_(pa.struct([("i", pa.int32()), ("line", pa.binary()), ("vote", pa.bool_())]))


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        gone, met, repeated = [], [], []
        for row in range(batch.num_rows):
            a, z, others = (batch.column(c)[row].as_py() for c in ("lines", "zones", "others"))
            gone.append(shared_lines(a, z, others) if OPEN in z else b"")
            found = repeated_lines(a, z, others) if KEPT in z else (False, [])
            met.append(found[0])
            repeated.append(found[1])
        columns = [pa.array(gone, pa.binary()), pa.array(met, pa.bool_()), pa.array(repeated, REPEATED)]
        same = (*KEY, "host", "section")
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in same), *columns], names=[*same, "gone", "met", "repeated"])
    give_back()


KEY = ("page_id", "url", "page_hash")
KEY_KIND = "page_id long, url string, page_hash binary"
DIFFERENCES = f"{KEY_KIND}, host string, section string, gone binary, met boolean, repeated array<struct<i: int, line: binary, vote: boolean>>"


def _near(path: Column, their_path: Column) -> Column:
    """How many segments two paths share from the start."""
    same = F.transform(F.arrays_zip(F.split(path, "/").alias("a"), F.split(their_path, "/").alias("b")), lambda p: F.equal_null(p["a"], p["b"]))
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")


def differences(pages: DataFrame) -> DataFrame:
    """Each page of ``pages`` (``KEY``, ``html``) once, with what its nearest pages in URL order share, however many its host has.

    Only digests of lines move. Pages are numbered in URL order and meet their neighbours in blocks
    of consecutive numbers, with the neighbours of a block's ends in both blocks.
    """
    prints = pages.mapInArrow(_fingerprints, f"{KEY_KIND}, lines binary, zones binary").dropDuplicates(KEY)
    host, path = host_and_path(F.col("url"))
    prints = kept(prints.select(*KEY, "lines", "zones", host.alias("host"), path.alias("path")), "lines")
    if prints.isEmpty():
        return prints.sparkSession.createDataFrame([], DIFFERENCES)
    # A row's place in URL order; the hash tells pages of one URL and id apart.
    placed = with_row_pos(prints, KeyOrder(("host", "path", "url", "page_id", "page_hash")), "at")
    reach = max(NEIGHBOURS)
    blocks = F.array_distinct(F.array(*(F.floor((F.col("at") + F.lit(s)) / F.lit(BLOCK)) for s in (-reach, 0, reach))))
    in_order = Window.partitionBy("block").orderBy("at")
    page = F.struct("host", "path", "lines", "zones")
    rows = placed.withColumn("block", F.explode(blocks)).select(
        "*", *((F.lag if s < 0 else F.lead)(page, abs(s)).over(in_order).alias(f"at{s}") for s in NEIGHBOURS)
    )
    others = [
        F.when(
            F.col(f"at{s}.host") == F.col("host"),
            F.struct(
                F.col(f"at{s}.lines").alias("lines"), F.col(f"at{s}.zones").alias("zones"),
                _near(F.col("path"), F.col(f"at{s}.path")).alias("near"), F.lit(s).alias("step"),
            ),
        )
        for s in NEIGHBOURS
    ]
    parts = F.filter(F.split("path", "/"), lambda part: part != "")
    section = F.when(F.size(parts) > 1, parts[0]).otherwise(F.lit(""))
    rows = rows.where(F.col("block") == F.floor(F.col("at") / F.lit(BLOCK)))
    return rows.select(*KEY, "host", section.alias("section"), "lines", "zones", F.array_compact(F.array(*others)).alias("others")).mapInArrow(
        _differences, DIFFERENCES
    )


def frame_of_articles(found: DataFrame) -> DataFrame:
    """``host``, ``section``, ``line``: the lines that ``FRAME_PERCENT`` of the articles of a host (section ``""``) or of one section share with another.

    A page has one vote, if it met another one than copies and versions of itself. Copies and quoted lines
    do not get as many votes; hosts and sections with fewer than ``FRAME_PAGES`` such pages have no frame.
    """
    voters = found.where("met AND host <> ''").withColumn("section", F.explode(F.array_distinct(F.array(F.lit(""), F.col("section")))))
    of = voters.groupBy("host", "section").agg(F.count("*").alias("pages")).where(F.col("pages") >= FRAME_PAGES)
    lines = F.array_distinct(F.transform(F.filter("repeated", lambda r: r["vote"]), lambda r: r["line"]))
    votes = voters.select("host", "section", F.explode(lines).alias("line")).groupBy("host", "section", "line").agg(F.count("*").alias("votes"))
    most = F.col("votes") * 100 >= F.col("pages") * FRAME_PERCENT
    return votes.join(of, ["host", "section"]).where(most).select("host", "section", "line")


def framed_lines(pages: DataFrame) -> DataFrame:
    """``KEY``, ``gone``, ``frame`` of pages with lines to delete: a 1 for each open line that the nearest page shares, places of an article's frame lines."""
    found = kept(differences(pages), "differences")
    frame = small(kept(frame_of_articles(found), "frame"))
    repeated = found.where(F.size("repeated") > 0).withColumn("section", F.explode(F.array_distinct(F.array(F.lit(""), F.col("section")))))
    repeated = repeated.select(*KEY, "host", "section", F.inline("repeated")).join(frame, ["host", "section", "line"])
    places = repeated.groupBy(*KEY).agg(F.collect_set("i").alias("frame"))
    # A page has open lines or an article, never both.
    open_ = found.where(F.instr(F.hex("gone"), "01") > 0).select(*KEY, "gone", F.lit(None).cast("array<int>").alias("frame"))
    return open_.unionByName(places.withColumn("gone", F.lit(None).cast("binary")))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, "html"):
        texts = []
        for page, gone, frame in zip(*(piece.column(c).to_pylist() for c in ("html", "gone", "frame"))):
            lines, frame = page_lines(page or ""), set(frame or ())
            left = [line for i, (line, zone) in enumerate(lines) if zone and not (gone and gone[i]) and i not in frame]
            texts.append("\n\n".join(left))
        sizes = pa.array([len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [piece.column("page_id"), piece.column("url"), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"]
        )


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` for every row of ``pages`` (``page_id``, ``url``, ``html``).

    Blocks of text, with character references decoded and white space turned into single
    spaces, joined by two newlines. Every page is aligned with its nearest pages by URL path within
    the host, by longest common subsequence. On a page without an ``article`` (and ``main``), lines
    that it shares with the nearest one go, with copies of the page passed over. A line within an
    article goes if it is shared and nearly all articles of the host, or of the path's first
    segment, share it (``frame_of_articles``): copies of an article and quoted lines
    would delete each other otherwise. The elements check what is left: an ``article`` (else
    ``main``) has the text, without forms, footers and the like inside it, and elsewhere elements
    named or marked as menus, headers, footers, sidebars, notices, adverts, forms or comments go.
    A page with no neighbour keeps its other lines.

    Null or empty html has an empty text, a null url an empty host and path. Repeated rows are
    one page to be compared, and all come out. Other columns are not used.
    """
    rows = pages.select("page_id", "url", "html")
    hashed = rows.withColumn("page_hash", F.unhex(F.md5(F.coalesce("html", F.lit("")))))
    gone = small(kept(framed_lines(hashed), "gone")).select(*(F.col(c).alias(f"of_{c}") for c in KEY), "gone", "frame")
    same = F.equal_null("page_id", "of_page_id") & F.equal_null("url", "of_url") & (F.col("page_hash") == F.col("of_page_hash"))
    joined = hashed.join(gone, same, "left").select("page_id", "url", "html", "gone", "frame")
    return joined.mapInArrow(_texts, "page_id long, url string, text string, n_chars long")
