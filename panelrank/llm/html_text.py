"""Main text of web pages by markup and nearest-URL page differencing.

``lines`` turns a page into text lines (blocks), each marked by the markup around it: MARKUP lines stand in menus, headers,
footers, forms, adverts and the like and go; ARTICLE lines are plain prose (headings, paragraphs, list items, cells) of the
page's article and stay, for passages recur in real articles; all other lines are OPEN, inside an article (shares, notices,
boxes) as on pages without one. The distinct pages of a host are sorted by URL path, and every page is aligned by longest common
subsequence with its nearest distinct page on either side; the OPEN lines that it shares with the nearer one are template and go.

A page with as good as the same own lines is a copy and no template, so the walk goes on to the last page that is none. Own lines
are the ARTICLE lines; without any, the OPEN ones, of which a page that shares most but not all may be a copy or have a large
template: it counts only if no clearly distinct page is found. Equal html on a host is one page with one decision.

The sort is a range partitioning over (host, path), walked in both directions, so a host with a third of all pages is spread over
many tasks; the pages before the first distinct one of a partition are aligned with the last ones of the partitions before it in
a second step. Only line hashes are sorted and aligned; the html moves once at most.

Defined results: null and empty html give the empty text; a page alone on its host loses no OPEN line; null urls are the host
without a name; repeated rows give equal texts.
"""

from __future__ import annotations

import html
import re
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelrank.llm.arrays import fresh_name
from panelrank.llm.store import Store

MARKUP, ARTICLE, OPEN = 0, 1, 2
COPY = 0.8               # a neighbour that shares this part of a page's own lines is, or may be, a copy
TABLE_BITS = 1 << 28     # bits of an alignment table held at once; beyond, the alignment is split

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "xmp", "noframes", "iframe", "noembed"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4",
         "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
PROSE = HEADINGS | {"article", "main", "blockquote", "caption", "dd", "dt", "figcaption", "li", "p", "pre", "table", "tbody", "td", "tfoot", "th", "thead", "tr"}
DROPPED = {"head", "nav", "header", "footer", "aside", "form", "menu", "dialog", "noscript", "template", "button", "select", "svg", "canvas", "object", "audio", "video", "fieldset"} | RAW
DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "form", "menu", "menubar", "toolbar"}
# words of class and id names that mark what is not the article
DROPPED_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "copyright", "disqus", "feedback",
                 "footer", "form", "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pager", "pagination", "popup", "promo", "promoted",
                 "related", "reply", "replies", "respond", "responses", "rail", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "tags", "toolbar", "topbar", "widget"}
# a comment, a declaration, a tag with quoted attributes, or a tag whose quotes don't close; after one of those quotes count no more.
# Nothing is tried twice: each match moves on, and beyond the last ">" there is no tag
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|(<)/?[a-zA-Z][^>]*>", re.S)
_UNQUOTED = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)>()", re.S)
_ATTR = re.compile(r"(?<![\w-])(class|id|role|aria-hidden|hidden)(?![\w-])(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")


def _dropped(attrs: str, element: str, inside: bool) -> bool:
    """Whether an element's attributes mark it as no part of an article.

    Inside an article an id is an anchor, made from the words of a title, and counts as a whole only; headings have nothing
    but such ids, and a header there is the article's own.
    """
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "id" and (inside or element in HEADINGS):
            if element not in HEADINGS and value.lower() in DROPPED_NAMES:
                return True
        elif name in ("class", "id"):
            words = {w.lower() for w in _NAME.findall(value)}
            if (words - {"header"} if inside and element == "header" else words) & DROPPED_NAMES:
                return True
        elif name == "role":
            if value.lower() in DROPPED_ROLES:
                return True
        elif name == "hidden" or value.lower() == "true":
            return True
    return False


def lines(page: str) -> list[tuple[str, int]]:
    """(text, MARKUP, ARTICLE or OPEN) of the page's blocks in order. Without an article element, main is the article."""
    stack: list[tuple[str, bool, int, bool]] = []    # name, dropped, region (2: article, 1: main), plain prose
    dropped = 0
    out: list[tuple[str, bool, int, bool]] = []
    parts: list[str] = []
    region = 0

    def close_block():
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                out.append((text, dropped > 0, region, next((s[3] for s in reversed(stack) if s[0] in BLOCK or s[0] in PROSE), False)))
            parts.clear()

    at, n = 0, len(page)
    last, tag = page.rfind(">") + 1, _TAG
    open_names: dict[str, int] = {}
    while at < n:
        m = tag.search(page, at, last) if at < last else None
        if m is None:
            hidden = page.find("<!--", at)  # a comment that nothing closes
            parts.append(page[at:hidden] if hidden >= 0 else page[at:])
            break
        if m.start() > at:
            parts.append(page[at:m.start()])
        if m[4]:
            at, tag = m.start(), _UNQUOTED
            continue
        at = m.end()
        if at == last and page.startswith("<!--", m.start()) and not page.endswith("-->", m.start() + 4, at):
            break
        if not m[2]:
            continue
        name = m[2].lower()
        if name == "br" or name in ("td", "th"):
            parts.append(" ")
        if name in BLOCK or name in DROPPED:
            close_block()
        if m[1]:
            if open_names.get(name):
                at_name = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name)
                if any(s[1] or s[0] in BLOCK for s in stack[at_name:]):
                    close_block()
                for s in stack[at_name:]:
                    dropped -= s[1]
                    open_names[s[0]] -= 1
                del stack[at_name:]
                region = stack[-1][2] if stack else 0      # a region holds for all inside it
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if name in BLOCK and stack and stack[-1][0] == "p":
            dropped -= stack.pop()[1]
            open_names["p"] -= 1
        if name in VOID or m[3].endswith("/"):
            continue
        gone = (name in DROPPED and not (name == "header" and region)) or (bool(m[3]) and name not in ("html", "body") and _dropped(m[3], name, region > 0))
        if gone:
            close_block()
        kind = 0 if dropped or gone else 2 if name == "article" else 1 if name == "main" or (m[3] and re.search(r"role\s*=\s*[\"']?main\b", m[3], re.I)) else 0
        plain = name in PROSE and (name in HEADINGS or name in ("article", "main") or not (m[3] and _ATTR.search(m[3])))
        stack.append((name, gone, max(kind, region), plain))
        open_names[name] = open_names.get(name, 0) + 1
        dropped += gone
        region = max(kind, region)
    close_block()
    best = max((r for _, gone, r, _ in out if not gone), default=0)
    return [(t, MARKUP if gone or (best and r < best) else ARTICLE if best and plain else OPEN) for t, gone, r, plain in out]


def shared(a: list[int], b: list[int]) -> list[int]:
    """Places of ``a`` that belong to a longest common subsequence with ``b``."""
    lo = 0
    while lo < len(a) and lo < len(b) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < len(a) - lo and hi < len(b) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    head, tail = list(range(lo)), list(range(len(a) - hi, len(a)))
    inner_b = b[lo:len(b) - hi]
    have = set(inner_b)
    at = [i for i in range(lo, len(a) - hi) if a[i] in have]
    mine = {a[i] for i in at}
    return head + [at[i] for i in _align([a[i] for i in at], [x for x in inner_b if x in mine])] + tail


def _rows(a: list[int], b: list[int], every: bool) -> list[int]:
    """Bit rows of the alignment table: bit j of row i is 0 where the common length grows from column j to j + 1."""
    match: dict[int, int] = {}
    for j, x in enumerate(b):
        match[x] = match.get(x, 0) | 1 << j
    v = full = (1 << len(b)) - 1
    out = []
    for x in a:
        u = v & match.get(x, 0)
        v = ((v + u) | (v - u)) & full
        if every:
            out.append(v)
    return out if every else [v]


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Common length of ``a`` with every prefix of ``b``."""
    v = _rows(a, b, False)[0] if a else (1 << len(b)) - 1
    bits = np.unpackbits(np.frombuffer(v.to_bytes((len(b) + 7) // 8 or 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _align(a: list[int], b: list[int]) -> list[int]:
    if not a or not b:
        return []
    if len(a) * len(b) > TABLE_BITS and len(a) > 1:  # halve a, and b where the two halves together are longest
        half = len(a) // 2
        j = int(np.argmax(_lengths(a[:half], b) + _lengths(a[half:][::-1], b[::-1])[::-1]))
        return _align(a[:half], b[:j]) + [half + i for i in _align(a[half:], b[j:])]
    rows, out = _rows(a, b, True), []
    i, j = len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                j -= 1
                out.append(i)
    return out[::-1]


def _near(x: str, y: str) -> int:
    """How near two URL paths are: characters of their common beginning."""
    n = min(len(x), len(y))
    return next((i for i in range(n) if x[i] != y[i]), n)


DISTINCT, PERHAPS, SAME = 2, 1, 0      # whether a neighbour is another page, a copy or a page with a large template, or a copy


def _compare(me: dict, other: dict, side: int) -> dict | None:
    """Which OPEN lines of ``me`` a page of its host shares, how near that page is and whether it is a copy."""
    if me["host"] != other["host"]:
        return None
    mine = set(shared(me["hashes"], other["hashes"]))
    kinds = me["kinds"]
    prose = ARTICLE in kinds
    own = [i for i, k in enumerate(kinds) if k == (ARTICLE if prose else OPEN)]
    both = sum(i in mine for i in own)
    grade = DISTINCT if both < COPY * len(own) else SAME if prose or both == len(own) else PERHAPS
    drop = [i for i, k in enumerate(kinds) if k == OPEN and i in mine] if grade else []
    return {"host": me["host"], "digest": me["digest"], "rank": (grade << 40) + 2 * _near(me["path"], other["path"]) + side, "drop": drop}


def _grade(found: dict | None) -> int | None:
    return found and found["rank"] >> 40


_PAGE = [("host", pa.string()), ("path", pa.string()), ("digest", pa.binary()), ("hashes", pa.list_(pa.int64())), ("kinds", pa.list_(pa.int32()))]
_KEYED = "host string, path string, page long, digest binary, hashes array<long>, kinds array<int>"
LEAD, LAST, BASE = 0, 1, 2             # a partition's pages before its first distinct one, its last page, the last one distinct from that
_FOUND = pa.schema([("part", pa.int32()), ("edge", pa.int32()), *_PAGE, ("rank", pa.int64()), ("drop", pa.list_(pa.int32()))])
_FOUND_DDL = "part int, edge int, host string, path string, digest binary, hashes array<long>, kinds array<int>, rank long, drop array<int>"
_EDGE = pa.schema([("part", pa.int32()), *_PAGE])
_EDGE_DDL = "part int, host string, path string, digest binary, hashes array<long>, kinds array<int>"
_DROP = pa.schema([("host", pa.string()), ("digest", pa.binary()), ("rank", pa.int64()), ("drop", pa.list_(pa.int32()))])
_DROP_DDL = "host string, digest binary, rank long, drop array<int>"


def _walk(side: int):
    """Task function over a sorted partition: each page against the page before it and, past copies, the last distinct one."""
    def walk(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        before, base, lead = None, None, True
        for b in batches:
            out = []
            for me in b.to_pylist():
                found = before and _compare(me, before, side)
                if before and not found:                       # another host
                    base, lead = None, False
                elif _grade(found) == DISTINCT:
                    base, lead = before, False
                tried = [found, base and base is not before and _compare(me, base, side)]
                out += [{"part": part, **x} for x in tried if x and _grade(x) and OPEN in me["kinds"]]
                if lead:
                    out.append({"part": part, "edge": LEAD, **me})
                before = me
            yield pa.RecordBatch.from_pylist(out, schema=_FOUND)
        ends = [{"part": part, "edge": e, **x} for e, x in ((LAST, before), (BASE, base)) if x]
        yield pa.RecordBatch.from_pylist(ends, schema=_FOUND)
    return walk


def _ends(side: int):
    """The pages that each partition's first ones follow: the last page of the partition before and the last one distinct from it."""
    def ends(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["edge"]))     # two a partition at most, whatever the input
        out, before = [], []
        for p in sorted({r["part"] for r in rows}):
            out += [{**x, "part": p} for x in before]
            here = [r for r in rows if r["part"] == p]
            before = here if len(here) == 2 else here + [x for x in before if _grade(_compare(here[0], x, side)) == DISTINCT][:1]
        return pa.Table.from_pylist([{c: x[c] for c in _EDGE.names} for x in out], schema=_EDGE)
    return ends


def _across(side: int):
    def across(leads: pa.Table, before: pa.Table) -> pa.Table:
        follow = before.to_pylist()
        found = [_compare(me, x, side) for me in leads.to_pylist() if OPEN in me["kinds"] for x in follow]
        return pa.Table.from_pylist([x for x in found if x and _grade(x)], schema=_DROP)
    return across


def _host(url) -> Column:
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def template_lines(pages: DataFrame, store: Store, url_col: str = "url", html_col: str = "html", id_col: str = "page_id") -> DataFrame:
    """(host, digest, drop): places of the OPEN lines that each page shares with its nearest distinct page; pages without any are left out."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    rows = pages.select(
        _host(url).alias("host"), F.regexp_extract(url, r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1).alias("path"),
        F.col(id_col).cast("long").alias("page"), F.unhex(F.sha2(F.coalesce(F.col(html_col), F.lit("")).cast("binary"), 256)).alias("digest"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))

    def hashed(batches):
        for b in batches:
            got = [lines(x) for x in b.column("html").to_pylist()]
            hashes = [[xxhash.xxh64_intdigest(f"{k}{t}") - (1 << 63) for t, k in g] for g in got]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(hashes, pa.list_(pa.int64())), pa.array([[k for _, k in g] for g in got], pa.list_(pa.int32()))], names=["host", "path", "page", "digest", "hashes", "kinds"])

    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    one = rows.mapInArrow(hashed, _KEYED).groupBy("host", "digest").agg(F.min(F.struct("path", "page")).alias("at"), F.first("hashes").alias("hashes"), F.first("kinds").alias("kinds"))
    keyed = store.write(one.select("host", "at.path", "at.page", "digest", "hashes", "kinds"), "hashed")
    order, parts = ["host", "path", "page", "digest"], []
    for side, way in ((1, F.asc_nulls_first), (0, F.desc_nulls_last)):
        by = [way(c) for c in order]
        walked = keyed.repartitionByRange(n, *by).sortWithinPartitions(*by).drop("page").mapInArrow(_walk(side), _FOUND_DDL)
        found = store.write(walked, f"found{side}")
        before = found.where(F.col("edge") > LEAD).withColumn("together", F.lit(0)).groupBy("together").applyInArrow(_ends(side), _EDGE_DDL)
        leads = found.where(F.col("edge") == LEAD).select(*_EDGE.names)
        parts += [found.where("edge is null").select(*_DROP.names), leads.groupBy("part").cogroup(before.groupBy("part")).applyInArrow(_across(side), _DROP_DDL)]
    best = reduce(DataFrame.unionByName, parts).groupBy("host", "digest").agg(F.max_by("drop", F.struct("rank", "drop")).alias("drop"))
    return store.write(best.where(F.size("drop") > 0), "drop")


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", id_col: str = "page_id", into: str = "text") -> DataFrame:
    """``pages`` without the html, plus the column ``into`` with the main text (a column of that name is replaced)."""
    store = Store(pages.sparkSession, "html")
    drop = template_lines(pages, store, url_col, html_col, id_col)
    store.drop("hashed", "found0", "found1")
    url = F.coalesce(F.col(url_col), F.lit(""))
    kept = [c for c in pages.columns if c != html_col and c.lower() != into.lower()]
    body, host, digest, gone_at = (fresh_name(pages, c) for c in ("_html", "_host", "_digest", "_drop"))
    own = [F.col(f"`{c}`") for c in kept]
    rows = pages.select(*own, F.coalesce(F.col(html_col), F.lit("")).alias(body), _host(url).alias(host))
    keyed = rows.withColumn(digest, F.unhex(F.sha2(F.col(body).cast("binary"), 256)))
    d = drop.select(F.col("host").alias(host), F.col("digest").alias(digest), F.col("drop").alias(gone_at))
    joined = keyed.join(d, [host, digest], "left").select(*own, body, gone_at)

    def run(batches):
        for b in batches:
            text = []
            for page, gone in zip(b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True):
                gone = set(gone or ())
                text.append("\n".join(t for i, (t, k) in enumerate(lines(page)) if k != MARKUP and i not in gone))
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(text, pa.string())], names=[*b.schema.names[:-2], into])

    return joined.mapInArrow(run, T.StructType([*(pages.schema[c] for c in kept), T.StructField(into, T.StringType())]))


def op3_html_text(spark, sf_dir: str) -> DataFrame:
    out = extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
