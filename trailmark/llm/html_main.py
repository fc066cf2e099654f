"""Main text of web pages: nearest-URL page differencing, guided by structure.

One pass over the markup cuts a page into blocks (lines).  What elements and
roles say is not the article (menus, footers, forms, ...), adverts and reader
comments go at once.  Other class names are only a guess: they make a block
suspect.  Class names count as whole names, and never against an ``article`` or
``main`` element itself.

Every page is paired with the page of the same host whose URL path sorts next
to it (the neighbour with the longer common path prefix first; copies of one page
count as one), and their lines are aligned by longest common subsequence.
Inside an ``article`` or ``main`` element a line goes if it is suspect and shared:
structure and differencing must agree.  Pages without such an element
lose their suspect lines, and the shared ones, which are the site's and not the
page's.  A neighbour that shares more than ``COPY`` of the page's characters
may be a version of the same article; then only what the other neighbour
shares as well goes, and if that leaves next to nothing, all lines stay.

Neighbours come from a range exchange of (host, path, row) keys alone, so a
host with a third of all pages is spread over many tasks; the two rows at each
partition's edge are matched afterwards.  Texts are never shuffled, but for
those of pages that can lose a line.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm.common import map_arrow
from trailmark.plans.shared import stored

#: Share of a page's characters above which a neighbour is its copy.
COPY = 0.6
#: Share of its characters that a page must keep where both neighbours may be its copies.
LEAST = 0.05

_RAW = "script|style|noscript|template|svg|math|iframe|object|canvas|textarea|select|title|audio|video"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})(?=[\s/>])[^>]*(?:(?<=/)>|>.*?(?:</(?P=raw)\s*>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|</?[a-z][^>]*(?:>|\Z)|<[!?][^>]*(?:>|\Z)|</\Z",
    re.S | re.I,
)
_ATTR = re.compile(r"([a-z:_-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_DROP = frozenset("nav footer aside form button menu dialog head".split())
_MAIN = frozenset(("article", "main"))
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tooltip".split())
#: Whole class names or ids of reader comments and adverts, and those that make a block suspect.
_NEVER = frozenset("comment comments comment-list commentlist comments-area comment-section respond replies disqus disqus_thread ad ads advert adverts advertisement advertising adsbygoogle ad-banner ad-container sponsored".split())
_SUSPECT = frozenset(
    "banner promo promos promotion sponsor cookie cookies cookie-notice cookie-banner consent gdpr notice notices notification alert sidebar side-bar nav navbar navigation menu submenu breadcrumb breadcrumbs footer site-footer page-footer site-header page-header masthead topbar top-bar social share sharing related related-posts recommended newsletter subscribe subscription signup sign-up popup pop-up modal overlay widget pagination pager skip-link login search toolbar copyright disclaimer".split()
)


def _verdict(tag: str, attrs: str, in_main: bool) -> str:
    """'' to keep what the element holds, 'suspect', or else why it goes."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)} if attrs.strip() else {}
    if tag in _DROP or tag == "header" and not in_main:
        return tag
    if found.get("role", "").lower() in _ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return "role"
    if "display:none" in found.get("style", "").replace(" ", "").lower():
        return "hidden"
    names = f"{found.get('class', '')} {found.get('id', '')}".lower().split()
    if not names or tag in ("body", "html") or tag in _MAIN and not in_main:
        return ""
    if not _NEVER.isdisjoint(names):
        return "comments" if any("comment" in x or x in ("respond", "replies") or x.startswith("disqus") for x in names) else "advert"
    return "suspect" if tag in BLOCKS and tag not in _MAIN and not _SUSPECT.isdisjoint(names) else ""


def _is_main(tag: str, attrs: str) -> bool:
    return tag in _MAIN or bool(attrs) and re.search(r"role\s*=\s*[\"']?main\b|itemprop\s*=\s*[\"']?articlebody", attrs, re.I) is not None


def blocks(page: str, everything: bool = False) -> list[tuple[str, bool, bool]]:
    """(text of the block, is it inside a main element, is it suspect), in page order; ``everything`` keeps all visible text."""
    out: list[tuple[str, bool, bool]] = []
    doubts: list[list] = []  # open suspect elements: [tag, elements of that tag open inside, main elements around it]
    pieces: list[str] = []
    drop, why, depth = "", "", 0  # the element being left out, and how many of its kind are open
    mains: list[list] = []  # open main elements: [tag, elements of that tag open inside]
    at = 0

    def flush() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                out.append((text, bool(mains), any(x[2] == len(mains) for x in doubts)))

    for m in _TOKEN.finditer(page):
        if m.start() > at and not drop:
            pieces.append(page[at : m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if m["end"]:
            if drop:
                if tag == drop:
                    depth -= 1
                    if not depth:
                        drop = ""
                    continue
                if not (tag in ("body", "html") or any(x[0] == tag for x in mains) and why != "comments"):
                    continue
                drop = ""  # its end tag is missing
            if tag in BLOCKS:
                flush()
            if mains and tag == mains[-1][0]:
                mains[-1][1] -= 1
                if not mains[-1][1]:
                    mains.pop()
                    doubts = [x for x in doubts if x[2] <= len(mains)]  # what isn't closed ends with it
            if doubts and tag == doubts[-1][0]:
                doubts[-1][1] -= 1
                if not doubts[-1][1]:
                    doubts.pop()
            continue
        attrs = m["attrs"] or ""
        if drop:
            if drop in ("p", "li") and tag in BLOCKS and (drop == "p" or tag == "li" and depth == 1):
                drop = ""  # these may lack an end tag
            elif tag in _MAIN and why != "comments" and _verdict(tag, attrs, False) in ("", "suspect"):
                drop = ""
            else:
                depth += tag == drop and not attrs.endswith("/")
                continue
        if tag == "br":
            pieces.append(" ")
        if tag in BLOCKS:
            flush()
        if tag in _VOID or attrs.endswith("/"):
            continue
        if everything:
            if tag == "head":
                drop, why, depth = tag, tag, 1
            continue
        reason = _verdict(tag, attrs, bool(mains))
        if doubts and tag == doubts[-1][0]:
            doubts[-1][1] += 1
        elif reason == "suspect":
            doubts.append([tag, 1, len(mains)])
        if reason and reason != "suspect":
            if doubts and tag == doubts[-1][0]:
                doubts[-1][1] -= 1  # its end tag won't be seen
            if tag not in BLOCKS:
                pieces.append(" ")
            drop, why, depth = tag, reason, 1
        elif _is_main(tag, attrs):
            mains.append([tag, 1])
        elif mains and tag == mains[-1][0]:
            mains[-1][1] += 1
    if not drop:
        pieces.append(page[at:])
    flush()
    return out


def visible_text(page: str) -> str:
    """All text outside head, scripts and styles, blocks parted by line feeds."""
    return "\n".join(t for t, *_ in blocks(page, everything=True))


def shared_lines(a: list, b: list) -> list[int]:
    """Indices into ``a`` of a longest common subsequence with ``b``, by bit-parallel rows."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    where: dict = {}
    for j, v in enumerate(y):
        where[v] = where.get(v, 0) | 1 << j
    full = (1 << len(y)) - 1
    rows = [full]
    for v in x:
        last = rows[-1]
        hit = last & where.get(v, 0)
        rows.append(((last + hit) | (last - hit)) & full)
    length = lambda i, j: (~rows[i] & ((1 << j) - 1)).bit_count()
    i, j, middle = len(x), len(y), []
    while i and j:
        here = length(i, j)
        if not here:
            break
        if length(i - 1, j) == here:
            i -= 1
        elif length(i, j - 1) == here:
            j -= 1
        else:
            i, j = i - 1, j - 1
            middle.append(head + i)
    return [*range(head), *reversed(middle), *range(len(a) - tail, len(a))]


def differenced(lines: list[str], places: list[int], doubted: list[bool], sure: bool, marks: list[int], sizes: list[int], mates: list[list[int]]) -> list[str]:
    """The lines that stay.  ``marks`` and ``sizes`` are those of all blocks of the page, ``places`` the blocks of ``lines``."""
    gone: set[int] = set()
    if mates:
        gone, total = set(shared_lines(marks, mates[0])), sum(sizes)
        if sum(sizes[i] for i in gone) > COPY * total:
            gone = gone.intersection(shared_lines(marks, mates[1])) if len(mates) > 1 else set()
            if total - sum(sizes[i] for i in gone) < LEAST * total:
                gone = set()
    if sure:
        left = [x for x, i, d in zip(lines, places, doubted) if not (d and i in gone)]
    else:
        left = [x for x, i, d in zip(lines, places, doubted) if not d and i not in gone] or [x for x, i in zip(lines, places) if i not in gone]
    return left or lines


def _path_key(url: str | None) -> tuple[str, str]:
    m = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)([^?#]*)", url or "", re.I)
    return (m[1].lower(), m[2].rstrip("/") or "/") if m else ("", url or "")


def _parse(pages: DataFrame) -> DataFrame:
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.monotonically_increasing_id().alias("row"), F.coalesce(F.col("html"), F.lit("")).alias("html"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = []
        for url, page in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()):
            found = blocks(page)
            certain = any(inside for _, inside, _ in found)
            mine = [i for i, (_, inside, _) in enumerate(found) if inside or not certain]
            marks = [xxhash.xxh3_64_intdigest(t.encode()) - (1 << 63) for t, *_ in found]
            doubted = [found[i][2] for i in mine]
            digest = xxhash.xxh3_64_intdigest(repr(marks)) - (1 << 63)
            made.append((*_path_key(url), certain, [found[i][0] for i in mine], mine, doubted, not certain or any(doubted), marks, [len(t) for t, *_ in found], digest))
        kinds = [pa.string(), pa.string(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64()]
        return pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(c, k) for c, k in zip(zip(*made), kinds))], names=["page_id", "url", "row", *_PARSED])

    kind = ", ".join(f"{n} {t}" for n, t in _PARSED.items())
    return map_arrow(rows, run, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, row long, {kind}")


_PARSED = dict(
    host="string", path="string", sure="boolean", lines="array<string>", places="array<int>", doubted="array<boolean>", open="boolean", marks="array<long>", sizes="array<int>", digest="long"
)


def _closeness(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _neighbours(keys: DataFrame) -> DataFrame:
    """(row, mate, near) for the rows next to each other in (host, path, row) order within a host."""
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["host", "path", "row"]
    ranged = keys.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    kind = "host string, path string, row long, mate long, far int, part int"

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, part = None, 0
        for pdf in batches:
            if not len(pdf):
                continue
            got, part = [], int(pdf["part"].iloc[0])
            for host, path, row in zip(pdf["host"], pdf["path"], pdf["row"]):
                if last is None:
                    got.append((host, path, row, -1, 0, part))  # the partition's first row
                elif last[0] == host:
                    far = -_closeness(path, last[1])
                    got += [(host, path, row, last[2], far, -1), (host, last[1], last[2], row, far, -1)]
                last = (host, path, row)
            yield pd.DataFrame(got, columns=["host", "path", "row", "mate", "far", "part"])
        if last is not None:
            yield pd.DataFrame([(*last, -2, 0, part)], columns=["host", "path", "row", "mate", "far", "part"])

    found = stored(ranged.mapInPandas(pairs, kind), "neighbours")
    edges = found.where("mate < 0").orderBy("part", F.desc("mate")).collect()  # two rows for each partition
    cross = []
    for a, b in zip(edges[1::2], edges[2::2]):
        if a["host"] == b["host"]:
            far = -_closeness(a["path"], b["path"])
            cross += [(a["host"], a["path"], a["row"], b["row"], far, -1), (b["host"], b["path"], b["row"], a["row"], far, -1)]
    inner = found.where("mate >= 0")
    return inner.unionAll(inner.sparkSession.createDataFrame(cross, kind)) if cross else inner


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per row of ``pages``.

    Null and empty html give an empty text, as do pages of nothing but
    boilerplate; very long pages are read whole.  A null URL counts as empty.
    Repeated rows and pages are one page in the pairing, and each gets a row;
    of pages equally near the one with the smaller path, then row, counts as
    nearer.  Extra columns are ignored, whatever they are called; an empty
    table gives an empty result.
    """
    parsed = stored(_parse(pages), "pages")
    text = F.array_join("lines", "\n\n")
    plain = parsed.where("NOT open").select("page_id", "url", text.alias("text"))
    open_ = parsed.where("open")
    if open_.isEmpty():
        return plain.withColumn("n_chars", F.char_length("text").cast("long"))
    distinct = parsed.groupBy("host", "digest").agg(F.min(F.struct("path", "row")).alias("x")).select("host", "digest", "x.path", "x.row")
    pairs = _neighbours(distinct.select("host", "path", "row"))
    marks = parsed.select(F.col("row").alias("mate"), F.col("marks").alias("mate_marks"))
    mates = pairs.join(marks, "mate").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("far", "mate", "mate_marks"))).alias("mates"))  # two at most
    # copies have the mates of the one that stands for them; a hot group of copies is split by adaptive execution
    own = mates.join(distinct.select("row", "host", "digest"), "row").select("host", "digest", F.transform("mates", lambda x: x["mate_marks"]).alias("mates"))
    given = ["lines", "places", "doubted", "sure", "marks", "sizes"]
    rows = open_.join(own, ["host", "digest"], "left").select("page_id", "url", *given, F.coalesce("mates", F.array().cast("array<array<bigint>>")).alias("mates"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = ["\n\n".join(differenced(*x)) for x in zip(*(c.to_pylist() for c in batch.columns[2:]))]
        return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kind = f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string"
    return plain.unionAll(map_arrow(rows, run, kind)).withColumn("n_chars", F.char_length("text").cast("long"))
