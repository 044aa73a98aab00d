"""Main text of web pages: what a page doesn't share with its neighbours by URL.

Pages are read as lines (blocks of text between block-level tags). Pages of a host are put in order of
their URL paths; each is compared with its nearest neighbours before and behind, lines aligned by
longest common subsequence, and shared lines go, as the template of the site. Marks of the page
itself go first: what is in navigation, footers, forms and the like (by tag, role or class) is never
main text. Where a page marks its article, what lies outside is not main text either, and the prose
blocks inside are, also where a neighbour quotes them: there the comparison takes only other lines.

A neighbour that has nearly all of the page's text is a copy of the article and tells
nothing about the template; the next one is taken.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowharbor.llm.common import global_rank, materialise

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "li", "dd", "dt", "figcaption", "caption", "tr"}
BLOCK = PROSE | {
    "html", "head", "body", "div", "section", "article", "main", "header", "footer", "nav", "aside", "ul", "ol", "dl", "table",
    "tbody", "thead", "tfoot", "figure", "form", "fieldset", "address", "hr", "details", "summary", "dialog", "menu", "center",
    "noscript", "template", "search", "hgroup", "option", "select", "optgroup", "legend", "title"}
# Never main text, wherever they stand; SOFT ones may hold the whole article by mistake or habit.
SOFT = {"nav", "header", "form", "noscript"}
NEVER = SOFT | {"head", "footer", "aside", "menu", "script", "style", "template", "svg", "button", "select", "textarea", "iframe", "object",
                "canvas", "dialog", "title", "label", "fieldset", "datalist", "math", "audio", "video", "search", "noembed",
                "noframes", "option"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "alertdialog", "dialog", "menu", "menubar",
         "toolbar", "form"}
WORDS = {
    "nav", "navbar", "navigation", "menu", "menubar", "submenu", "breadcrumb", "breadcrumbs", "sidebar", "rail", "footer", "masthead",
    "topbar", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "disclaimer", "ad", "ads", "adv",
    "advert", "adverts", "advertisement", "advertising", "adsense", "promo", "promos", "promotion", "sponsor", "sponsored", "sponsors",
    "comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "share", "sharing", "social", "related",
    "recommended", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "paywall", "pagination",
    "pager", "widget", "toolbar", "skip", "hidden"}
HEADER_WORDS = {"header"}
ENDS_P = BLOCK - {"title"}  # a paragraph ends where another block begins
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"}, "p": {"p"}}
COPY_SHARE, REACH = 0.8, 8
HELD_BITS = 1 << 28  # of an alignment, some 32 MB

VERDICT_SCHEMA = "key bigint, cut array<int>"


@dataclass(slots=True)
class Line:
    text: str
    inside: bool  # in a region the page marks as its article
    prose: bool


def _never(tag: str, attributes: str, inside: bool) -> int:
    """0: may be main text; 1: not, unless an article begins inside; 2: not."""
    if tag in NEVER:
        return 1 if tag in SOFT else 2
    if not attributes or tag in ("html", "body"):
        return 0
    found = {m[1].lower(): next((v for v in m.groups()[1:] if v is not None), "") for m in ATTRIBUTE.finditer(attributes)}
    if "style" in found and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found["style"], re.I):
        return 2
    if found.get("aria-hidden", "").lower() == "true" or re.search(r"(?:^|\s)hidden(?:\s|$)", re.sub(ATTRIBUTE, " ", attributes), re.I):
        return 2
    if found.get("role", "").lower() in ROLES:
        return 2
    if tag == "main":
        return 0
    named = set(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", f"{found.get('class', '')} {found.get('id', '')}").lower()))
    if named & WORDS:
        return 2
    return 1 if named & HEADER_WORDS and not inside else 0


def read_lines(html: str) -> list[Line]:
    """All lines of a page that its own marks don't rule out, in order."""
    lines: list[Line] = []
    parts: list[str] = []
    stack: list[tuple[str, int, bool]] = []  # tag, never, inside
    never, inside, block, at = 0, False, "", 0

    def flush() -> None:
        nonlocal parts
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text and (not never or (never == 1 and heading)):
                lines.append(Line(text, inside, block in PROSE))
            parts = []

    heading = False
    while at < len(html):
        m = TOKEN.search(html, at)
        if not m:
            parts.append(html[at:])
            break
        if m.start() > at:
            parts.append(html[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag, closing, attributes = m[2].lower(), bool(m[1]), m[3] or ""
        if tag == "br" or (tag in ("td", "th")):
            parts.append(" ")
        if tag in RAW and not closing:
            flush() if tag in BLOCK else None
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>|$", re.I).search(html, at)
            if tag in ("xmp",):
                parts.append(html[at:end.start()])
            at = end.end()
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if tag in BLOCK or tag in NEVER:
                flush()
            if depth is not None and (tag in BLOCK or tag in NEVER or all(t not in BLOCK for t, _, _ in stack[depth:])):
                del stack[depth:]
        else:
            own = _never(tag, attributes, inside)
            if tag in BLOCK or own:
                flush()
            if tag in ENDS_P:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p" or stack[i][0] in SIBLINGS.get(tag, ()):
                        del stack[i:]
                        break
                    if stack[i][0] in BLOCK:
                        break
            before, was = (stack[-1][1], stack[-1][2]) if stack else (0, False)
            region = tag in ("article", "main")
            if region and own == 0 and before == 1:
                before = 0
            now = max(before, own)
            if not attributes.rstrip().endswith("/") or tag in BLOCK:
                stack.append((tag, now, (was or region) and now == 0 or (was and now == 1)))
        never, inside = (stack[-1][1], stack[-1][2]) if stack else (0, False)
        block = next((t for t, _, _ in reversed(stack) if t in BLOCK), "")
        # the title of an article may stand in the article's own header
        heading = block in ("h1", "h2") and inside and any(t == "header" for t, _, _ in stack)
    flush()
    if any(line.inside for line in lines):
        lines = [line for line in lines if line.inside]
    return lines


def main_text(lines: list[Line], cut: set[int]) -> str:
    return "\n\n".join(line.text for i, line in enumerate(lines) if i not in cut)


def common_lines(a: list, b: list) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``.

    Lines that only one side has are left out first, equal ends matched; for the rest rows of bits
    are kept, or, where those would take more than some 32 MB, ``b`` is halved (Hirschberg).
    """
    start, end_a, end_b = 0, len(a), len(b)
    while start < end_a and start < end_b and a[start] == b[start]:
        start += 1
    while end_a > start and end_b > start and a[end_a - 1] == b[end_b - 1]:
        end_a, end_b = end_a - 1, end_b - 1
    both = set(a[start:end_a]) & set(b[start:end_b])
    at = [i for i in range(start, end_a) if a[i] in both]
    other = [x for x in b[start:end_b] if x in both]
    inner = [at[i] for i in _subsequence([a[i] for i in at], other)]
    return [*range(start), *inner, *range(end_a, len(a))]


def _rows(a: list, b: list) -> Iterator[int]:
    """Row by row of ``b``: a bit for each place of ``a``, zero where the length of the common subsequence steps up."""
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & places.get(x, 0)
        row = (row + hit | row - hit) & full
        yield row


def _subsequence(a: list, b: list) -> list[int]:
    if not a or not b:
        return []
    if len(b) == 1:
        return [a.index(b[0])] if b[0] in a else []
    if len(a) * len(b) > HELD_BITS:
        half = len(b) // 2
        ahead = _steps(a, b[:half])
        behind = _steps(a[::-1], b[half:][::-1])
        split = int(np.argmax(ahead + behind[::-1]))
        return _subsequence(a[:split], b[:half]) + [split + i for i in _subsequence(a[split:], b[half:])]
    rows, i, found = list(_rows(a, b)), len(a) - 1, []
    for j in range(len(b) - 1, -1, -1):
        row = rows[j]
        while i >= 0 and row >> i & 1:  # no step here: a shorter stretch of a does as well
            i -= 1
        if i < 0:
            break
        if j and not rows[j - 1] >> i & 1:
            continue  # b[j] isn't needed
        found.append(i)
        i -= 1
    return found[::-1]


def _steps(a: list, b: list) -> np.ndarray:
    """The length of the longest common subsequence of ``b`` with each prefix of ``a``."""
    row = (1 << len(a)) - 1
    for row in _rows(a, b):
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(-(-len(a) // 8), "little"), np.uint8), bitorder="little")[:len(a)]
    return np.concatenate(([0], np.cumsum(1 - bits.astype(np.int64))))


def _key() -> Column:
    return F.xxhash64(F.coalesce("url", F.lit("")), F.coalesce("html", F.lit("")), F.col("url").isNull()).alias("key")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host in lower case, null if there is none, and the path, without query and fragment, cut at each slash."""
    host = F.lower(F.nullif(F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]+)", 1), F.lit("")))
    path = F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#\s]*)", 1)
    return host, F.split(F.regexp_replace(path, r"^/+|/+$", ""), "/+")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of each page as digests, with their lengths and whether the comparison may take them."""
    for batch in batches:
        lines: list[list[int]] = []
        sizes: list[list[int]] = []
        free: list[list[bool]] = []
        for html in batch.column("html"):
            own = read_lines(html.as_py())
            lines.append([xxhash.xxh64_intdigest(x.text) - (1 << 63) for x in own])
            sizes.append([len(x.text) for x in own])
            free.append([not (x.inside and x.prose) for x in own])
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("host"), batch.column("path"), pa.array(lines, pa.list_(pa.int64())),
             pa.array(sizes, pa.list_(pa.int32())), pa.array(free, pa.list_(pa.bool_()))],
            names=["key", "host", "path", "lines", "sizes", "free"])


def nearness(path: list[str], other: list[str]) -> int:
    """Leading parts of the path that both have, the more the nearer."""
    n = 0
    for x, y in zip(path, other, strict=False):
        if x != y:
            break
        n += 1
    return n


def shared_lines(page: dict, neighbours: list[dict]) -> list[int]:
    """Lines of ``page`` that go: those in common with the nearest neighbour that isn't a copy."""
    total = sum(page["sizes"])
    for other in neighbours:
        have = set(other["lines"])
        same = sum(n for x, n in zip(page["lines"], page["sizes"], strict=True) if x in have)
        if same < COPY_SHARE * total:
            return [i for i in common_lines(page["lines"], other["lines"]) if page["free"][i]]
    return []


def _verdicts(size: int):
    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        rows = sorted(table.to_pylist(), key=lambda r: r["rank"])
        keys, cuts = [], []
        for i, page in enumerate(rows):
            if page["rank"] // size != block:
                continue
            cut: set[int] = set()
            if any(page["free"]):
                for step in (-1, 1):
                    side = [rows[j] for j in range(i + step, i + step * (REACH + 1), step)
                            if 0 <= j < len(rows) and rows[j]["host"] == page["host"]]
                    side.sort(key=lambda r: -nearness(page["path"], r["path"]))  # stable: the nearer in order first
                    cut.update(shared_lines(page, side))
            keys.append(page["key"])
            cuts.append(sorted(cut))
        return pa.table([pa.array(keys, pa.int64()), pa.array(cuts, pa.list_(pa.int32()))], names=["key", "cut"])

    return run


def template_lines(pages: DataFrame, block: int = 256) -> DataFrame:
    """``key, cut``: for each distinct page the numbers of the lines it shares with its neighbours.

    Pages are ranked by host and path over all rows and dealt to blocks of neighbours, so a host
    with a third of all pages is spread; a block also gets the ``REACH`` rows on both sides of it.
    """
    host, path = host_and_path(F.col("url"))
    slim = pages.select(_key(), host.alias("host"), path.alias("path"), F.coalesce("html", F.lit("")).alias("html"))
    digests = slim.filter("host is not null").mapInArrow(
        _digests, "key bigint, host string, path array<string>, lines array<bigint>, sizes array<int>, free array<boolean>")
    ranked = global_rank(materialise(digests, "page-lines").dropDuplicates(["key"]),
                         [F.col("host"), F.col("path"), F.col("key")], "rank", "page-order")
    near = F.array_distinct(F.transform(F.array(*[F.lit(d) for d in (-REACH, 0, REACH)]),
                                        lambda d: F.floor((F.col("rank") + d) / block).cast("bigint")))
    return ranked.withColumn("block", F.explode(near)).groupBy("block").applyInArrow(_verdicts(block), VERDICT_SCHEMA)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(read_lines(html.as_py()), set(cut or ()))
                 for html, cut in zip(batch.column("html"), batch.column("cut").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of each row of ``pages``; other columns are not read.

    Null and empty pages have an empty text. Pages without a host are not compared, and neither are
    those that have no neighbour but copies. Rows with the same URL and page count as one in the
    comparison and have the same text; among equal paths the order is by a digest.
    """
    cuts = materialise(template_lines(pages).filter(F.size("cut") > 0), "page-cuts")
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), _key())
    kind = dict(pages.dtypes)["page_id"]
    return rows.join(cuts, "key", "left").select("page_id", "url", "html", "cut").mapInArrow(
        _texts, f"page_id {kind}, url string, text string, n_chars bigint")
