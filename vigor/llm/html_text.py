"""Operator 8, main text of web pages: nearest-URL page differencing of every page, checked by page structure.

A page becomes blocks, each with its place (path of elements and classes) and where it stands: in boilerplate (an element that by its
tag, role or class is a menu, header, footer, sidebar, notice, advert, form or comment section), in the article container, or outside both.

Differencing: pages of a host with the same main lines are one content; contents are ordered by URL path within their host; each is
aligned, by longest common subsequence, with the ``RUN`` before it and the ``RUN`` after it that aren't nearly copies.  A place
at which neighbours share most of a host's text is boilerplate, however its lines rotate; one at which they share little is
content and keeps its lines, though articles quote the same passages.  Without a container this decides, with the lines
that the nearest neighbour shares; a page that has only copies around it keeps all its lines.

Check by structure: boilerplate elements go, though no neighbour shares their lines; a page with an article container keeps the lines in it,
at shared places too unless most neighbours share the line itself.  What is boilerplate by a class or id only
doesn't take main content with it that lies inside; an article inside or with such a name (it may be a teaser or
a comment) counts if the page has no other container and it holds more than what lies outside.  Stored is the main text by
structure, and the lines of it that go, so that texts aren't shuffled with their verdicts.

Defined cases: a null or empty page has no text; a null url or one without a host counts to the host ''; rows with the same
url or page_id are pages of their own; a page alone in its host shares nothing; a container never loses all its lines; lines and places are
equal if their 64-bit hashes are; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import chunks, global_rank, stored, table

RUN = 64
#: Neighbours from which on a line that most of them don't share is a quotation; fewer take no line from a container.
SURE = 8
#: Share of the characters from which two pages are copies, whose common lines say nothing of boilerplate.
COPY = 0.9
#: Pairs of equal lines per line from which on they aren't listed.
DENSE = 32

# The elements of HTML by how they matter to text.
RAW = {"script", "style", "title", "textarea"}
DROPPED = {"head", "noscript", "template", "select", "button", "svg", "math", "iframe", "object",
           "canvas", "audio", "video", "nav", "footer", "aside", "form", "dialog", "menu", "datalist"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
          "ins", "kbd", "label", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
          "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu",
         "menubar", "toolbar"}
BOILERPLATE = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
               "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "masthead", "menu", "modal",
               "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "pagination",
               "popup", "promo", "promoted", "recommended", "related", "replies", "respond", "share", "sharing", "sidebar",
               "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}

#: Words that place a boilerplate element and don't name a subject.
LAYOUT = {"area", "bar", "block", "bottom", "box", "button", "buttons", "container", "content", "cta", "feed", "fixed", "float", "floating",
          "form", "frame", "grid", "group", "holder", "horizontal", "icon", "icons", "inline", "inner", "item", "items", "label", "left",
          "link", "links", "list", "main", "middle", "mobile", "outer", "page", "panel", "post", "posts", "row", "section", "side", "site",
          "slot", "small", "sticky", "tag", "this", "title", "top", "right", "unit", "us", "vertical", "wrap", "wrapper", "zone"}
STATES = {"has", "no", "with", "without"}

# The end tags that HTML lets a page leave out.  A start tag ends the open elements of the first set, unless one of the
# second set is open inside them.
HEAD_ONLY = {"base", "basefont", "bgsound", "link", "meta", "noframes", "noscript", "script", "style", "template", "title"}
ENDS_P = {"address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "dt", "dd", "fieldset", "figcaption",
          "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "li", "main", "menu", "nav", "ol", "p", "pre",
          "search", "section", "summary", "table", "ul"}
P_SCOPE = {"button", "caption", "html", "object", "table", "td", "template", "th"}
CELLS = {"td", "th"}
ENDS = {"li": ({"li"}, {"ol", "ul", "menu", "table", "td", "th", "article", "section", "blockquote"}),
        "dt": ({"dt", "dd"}, {"dl", "table", "td", "th", "article", "section", "blockquote"}),
        "dd": ({"dt", "dd"}, {"dl", "table", "td", "th", "article", "section", "blockquote"}),
        "option": ({"option"}, {"select", "datalist", "optgroup"}), "optgroup": ({"option", "optgroup"}, {"select"}),
        "td": (CELLS, {"table"}), "th": (CELLS, {"table"}), "tr": ({"tr", "caption", "colgroup"} | CELLS, {"table"}),
        **{t: ({"thead", "tbody", "tfoot", "tr", "caption", "colgroup"} | CELLS, {"table"}) for t in ("thead", "tbody", "tfoot")}}

KEPT, NAMED, BOILER = range(3)
#: An article under a boilerplate name is SPARE: it counts if the page has no other container.
NONE, MAIN, ARTICLE, SPARE = range(4)
IN_BOILER, OUTSIDE, INSIDE = range(3)

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_TOKENS = re.compile(r"[a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


@dataclass
class Page:
    """Blocks of a page: text, place and where it stands (IN_BOILER, OUTSIDE or INSIDE); lines: those outside boilerplate, and whether they lie in an article container.

    A place is a hash of the path of a block's elements with their classes.  Scripts, styles and titles are no blocks.
    """
    blocks: list[tuple[str, int, int]] = field(default_factory=list)
    lines: list[tuple[str, bool]] = field(default_factory=list)
    has_article: bool = False


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): entities.unescape(v.strip("\"'")) for k, v in _ATTRIBUTE.findall(raw)} if raw else {}


def _names_boilerplate(have: dict[str, str], in_article: bool) -> bool:
    """Whether a class name or the id has a boilerplate word.  Names that state a thing of the page (has-sidebar) don't count.

    In an article the whole name has to say so (related-posts, ad-2), because a word of it may be of the subject (related-work).
    """
    for name in f"{have.get('class', '')} {have.get('id', '')}".lower().split():
        words = _TOKENS.findall(name)
        if in_article and not all(w in BOILERPLATE or w in LAYOUT or w[0].isdigit() for w in words):
            continue
        if not BOILERPLATE.isdisjoint(words) and not (len(words) > 1 and (words[0] in STATES or words[-1] == "target")):
            return True
    return False


def _standing(tag: str, raw: str, in_article: bool) -> tuple[int, int]:
    """Whether an element is boilerplate (KEPT, NAMED by class or id only, or BOILER), and what container it is (NONE, MAIN or ARTICLE)."""
    if tag in DROPPED or (tag == "header" and not in_article):
        return BOILER, NONE
    plain = MAIN if tag == "main" else ARTICLE if tag == "article" else NONE
    if not raw.strip(" /"):
        return KEPT, plain
    have = _attributes(raw)
    role = have.get("role", "").lower()
    if role in ROLES or "hidden" in have or have.get("aria-hidden") == "true" or _HIDDEN.search(have.get("style", "").lower()):
        return BOILER, NONE
    container = MAIN if role == "main" or have.get("itemprop") == "articleBody" else ARTICLE if role == "article" and not plain else plain
    return NAMED if container != MAIN and tag not in ("html", "body") and _names_boilerplate(have, in_article) else KEPT, container


def _mark(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _place(outer: int, tag: str, raw: str) -> int:
    """The place of an element in another: tag and classes.  Classes that number things (post-12) name no place."""
    names = _attributes(raw).get("class", "").lower().split() if raw.strip(" /") else []
    return _mark(".".join([f"{outer}/{tag}", *sorted(n for n in names if not any(c.isdigit() for c in n))]))


def _implied_end(tag: str, stack: list[tuple[str, int, int, int]]) -> int:
    """How many open elements stay open at a start tag: those that it ends by HTML's rules of omitted end tags go."""
    keep = len(stack)
    if tag not in HEAD_ONLY and tag not in ("head", "html"):
        keep = next((i for i, s in enumerate(stack[:3]) if s[0] == "head"), keep)
    for ended, scope in ([({"p"}, P_SCOPE)] if tag in ENDS_P else []) + ([ENDS[tag]] if tag in ENDS else []):
        for i in range(keep - 1, -1, -1):
            if stack[i][0] in ended:
                keep = i
            elif stack[i][0] in scope:
                break
    return keep


def parse(source: str | None) -> Page:
    """Blocks of the page and where they stand.  End tags may be left out where HTML lets them; other unclosed elements end with the one around them."""
    page, text, at = Page(), [], 0
    blocks: list[tuple[str, int, int, int]] = []  # text, place, inside boilerplate, inside which container
    stack: list[tuple[str, int, int, int]] = []  # open elements: tag, inside boilerplate, inside which container, place
    source = source or ""

    def flush():
        line = " ".join(entities.unescape("".join(text)).split()) if text else ""
        if line:
            dropped, inside, place = stack[-1][1:] if stack else (KEPT, NONE, 0)
            blocks.append((line, place, dropped, inside))
        text.clear()

    while True:
        found = _TAG.search(source, at)
        dropped, inside, place = stack[-1][1:] if stack else (KEPT, NONE, 0)
        text.append(source[at:found.start() if found else len(source)])
        if not found:
            break
        at = found.end()
        closing, tag, raw = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag not in INLINE and tag not in RAW:
            flush()
        if not closing and (keep := _implied_end(tag, stack)) < len(stack):
            flush()
            del stack[keep:]
            dropped, inside, place = stack[-1][1:] if stack else (KEPT, NONE, 0)
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None:
                if any(s[1] or s[1] != stack[depth][1] or s[2] for s in stack[depth:]) and text:
                    flush()
                del stack[depth:]
        elif tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, at)
            at = end.end() if end else len(source)
        elif tag not in VOID and not raw.endswith("/"):
            boiler, container = _standing(tag, raw, inside != NONE)
            if (boiler or (container and dropped)) and text:
                flush()
            boiler = max(boiler, dropped)
            if container == MAIN and boiler < BOILER:
                boiler, inside = KEPT, MAIN
            elif container == ARTICLE and inside == NONE and boiler < BOILER:
                boiler, inside = KEPT, SPARE if boiler else ARTICLE
            page.has_article |= inside in (MAIN, ARTICLE) and not boiler
            stack.append((tag, boiler, inside, place if tag in INLINE else _place(place, tag, raw)))
    flush()
    if not page.has_article:
        size = lambda spare: sum(len(x) for x, _, gone, where in blocks if not gone and (where == SPARE) == spare)
        page.has_article = size(True) > size(False)
        if page.has_article:
            blocks = [(x, place, gone, ARTICLE if where == SPARE else where) for x, place, gone, where in blocks]
    page.blocks = [(x, place, IN_BOILER if gone or where == SPARE else OUTSIDE if where == NONE else INSIDE) for x, place, gone, where in blocks]
    page.lines = [(x, stands == INSIDE) for x, _, stands in page.blocks if stands != IN_BOILER]
    return page


def _dense(ours: list[tuple[int, object]], theirs: list) -> set[int]:
    """``common_lines`` of lines that repeat so often that their pairs are too many to list: bit vectors of the rows, then back through them."""
    where: dict[object, int] = {}
    for j, x in enumerate(theirs):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(theirs)) - 1
    rows, row = [], full  # a zero bit of a row: the sequence gets longer by the line of that position
    for _, x in ours:
        met = row & where[x]
        row = (row + met | row - met) & full
        rows.append(row)
    shared, i, j = set(), len(ours), len(theirs)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                shared.add(ours[i][0])
                j -= 1
    return shared


def common_lines(a: list, b: list) -> set[int]:
    """Indexes of the lines of ``a`` that lie on a longest common subsequence with ``b``."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    shared = set(range(head)) | set(range(len(a) - tail, len(a)))
    in_a = set(a[head:len(a) - tail])
    ours = [(i, x) for i, x in enumerate(a) if head <= i < len(a) - tail]
    theirs = [x for x in b[head:len(b) - tail] if x in in_a]
    here = set(theirs)
    ours = [(i, x) for i, x in ours if x in here]  # lines of one side only can't be common
    equal = Counter(theirs)
    if sum(equal[x] for _, x in ours) > DENSE * (len(ours) + len(theirs)):
        return shared | _dense(ours, theirs)
    # Patience over positions: the longest chain that rises in both (each line may match any equal line after the last).
    where: dict[str, list[int]] = {}
    for j, x in enumerate(theirs):
        where.setdefault(x, []).append(j)
    ends: list[int] = []  # least last position in b of a chain of each length
    nodes: list[tuple[int, object]] = []
    from bisect import bisect_left
    for i, x in ours:
        for j in reversed(where[x]):
            k = bisect_left(ends, j)
            node = (i, nodes[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                nodes.append(node)
            elif ends[k] > j:
                ends[k], nodes[k] = j, node
    node = nodes[-1] if nodes else None
    while node:
        shared.add(node[0])
        node = node[1]
    return shared


#: Marks of the blocks of a page, an array each.
MARKS = {"lines": pa.int64(), "places": pa.int64(), "sizes": pa.int32(), "stands": pa.int8()}
MARKS_SQL = "lines array<long>, places array<long>, sizes array<int>, stands array<tinyint>"
MET = pa.struct([("at", pa.int32()), ("line", pa.int64()), ("place", pa.int64()), ("size", pa.int32()), ("times", pa.int32()), ("nearest", pa.bool_())])
DIFFERENCED = pa.schema([("host", pa.string()), ("digest", pa.string()), ("has_article", pa.bool_()), ("n", pa.int32()), ("met", pa.list_(MET))])


def parsed(pages: DataFrame) -> DataFrame:
    """(row, page_id, url, has_article, main, lines, places, sizes, stands): the lines that the structure takes for main text, and marks of every block.

    Those are the lines of the container, or all outside boilerplate where there is none.  Lines and places are marked by hashes of 64 bits.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in chunks(batches, "html"):
            found = [parse(h) for h in batch.column("html").to_pylist()]
            main = [[x for x, inside in p.lines if inside == p.has_article] for p in found]
            marks = [[[_mark(x) for x, _, _ in p.blocks] for p in found], [[place for _, place, _ in p.blocks] for p in found],
                     [[len(x) for x, _, _ in p.blocks] for p in found], [[stands for _, _, stands in p.blocks] for p in found]]
            yield pa.RecordBatch.from_arrays([
                pa.array(range(row, row + len(found)), pa.int64()), batch.column("page_id"), batch.column("url"),
                pa.array([p.has_article for p in found]), pa.array(main, pa.list_(pa.string())),
                *[pa.array(x, pa.list_(t)) for x, t in zip(marks, MARKS.values(), strict=True)]],
                names=["row", "page_id", "url", "has_article", "main", *MARKS])
            row += len(found)

    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"row long, page_id long, url string, has_article boolean, main array<string>, {MARKS_SQL}")


def contents(pages: DataFrame) -> DataFrame:
    """Add host, path and a digest of the main lines: pages of a host with the same ones have the same content."""
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    path = F.regexp_extract("url", r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)
    return pages.withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit("")),
                              "digest": F.md5(F.concat_ws("\n", "main").cast("binary"))})


def placed(pages: DataFrame) -> DataFrame:
    """A row per content of a host, with rank (by the first path within the host).  Copies, however many, are one."""
    firsts = pages.filter(F.size("lines") > 0).groupBy("host", "has_article", "digest").agg(
        F.min(F.struct("path", "url", "row", *MARKS)).alias("first")).select("host", "has_article", "digest", "first.*")
    return global_rank(firsts, [F.col(c) for c in ("host", "path", "url", "row")], "rank", per=["host"])


class Content:
    """Blocks of a content by where they stand, for alignments."""

    def __init__(self, row: dict):
        self.row, self.sizes = row, row["sizes"]
        self.main = INSIDE if row["has_article"] else OUTSIDE
        self.parts = [[i for i, x in enumerate(row["stands"]) if x == part] for part in (IN_BOILER, OUTSIDE, INSIDE)]
        self.lines = [[row["lines"][i] for i in part] for part in self.parts]
        self.all = set(row["lines"])
        self.size = sum(self.sizes[i] for i in self.parts[self.main])

    def shared(self, near: Content) -> set[int]:
        """Indexes of the blocks on a longest common subsequence with those of ``near`` that stand alike."""
        if self.all.isdisjoint(near.all):
            return set()
        return {part[i] for part, a, b in zip(self.parts, self.lines, near.lines, strict=True) if a and b for i in common_lines(a, b)}

    def is_copy(self, near: Content, shared: set[int]) -> bool:
        """Whether so few characters of either main text are its own that they are copies."""
        return self.main == near.main and sum(self.sizes[i] for i in self.parts[self.main] if i in shared) > COPY * min(self.size, near.size)


def differenced(placed: DataFrame) -> DataFrame:
    """(host, digest, has_article, n, met): every content aligned with the ``n`` around it that are no near copies.

    ``met`` has an entry per block: index among the main lines (-1 if the structure drops it), line, place, size, times (how many of
    the ``n`` share it) and nearest (whether the nearest does, of the ``RUN`` before, then of the ``RUN`` after).
    A task takes a run of 2 ``RUN`` and, as neighbours only, the ``RUN`` on either side, so a page's neighbours don't depend on where runs begin.
    """
    def run(group: pa.Table) -> pa.Table:
        rows = [Content(r) for r in group.sort_by("rank").select(["host", "digest", "has_article", *MARKS, "own"]).to_pylist()]
        out = []
        for i, one in enumerate(rows):
            if not one.row["own"]:
                continue
            n, times, nearest = 0, [0] * len(one.sizes), set()
            for near in [*reversed(rows[max(0, i - RUN):i]), *rows[i + 1:i + 1 + RUN]]:
                shared = one.shared(near)
                if shared and one.is_copy(near, shared):
                    continue
                n += 1
                nearest = nearest if n > 1 else shared
                for j in shared:
                    times[j] += 1
            at = {j: k for k, j in enumerate(one.parts[one.main])}
            out.append({**{c: one.row[c] for c in ("host", "digest", "has_article")}, "n": n, "met": [
                {"at": at.get(j, -1), "line": line, "place": place, "size": size, "times": times[j], "nearest": j in nearest}
                for j, (line, place, size) in enumerate(zip(one.row["lines"], one.row["places"], one.sizes, strict=True))]})
        return pa.Table.from_pylist(out, DIFFERENCED)

    run_of, inside = F.floor(F.col("rank") / (2 * RUN)), F.col("rank") % (2 * RUN)
    beside = F.explode(F.array(run_of, F.when(inside < RUN, run_of - 1).otherwise(run_of + 1))).alias("at")
    columns = ["host", "rank", "digest", "has_article", *MARKS]
    met = placed.select(*columns, beside).withColumn("own", F.col("at") == run_of)
    return met.groupBy("host", "at").applyInArrow(run, "host string, digest string, has_article boolean, n int, "
                                                  "met array<struct<at: int, line: long, place: long, size: int, times: int, nearest: boolean>>")


def shared_places(found: DataFrame) -> DataFrame:
    """(host, place): the places at which a host shares most of its distinct lines, by characters; ``found`` is from ``differenced``.

    Adverts and footers rotate, so it is enough that any neighbour shares a line.  Lines count once, so that copies of an article whose pages
    differ by adverts don't stand for the articles of the host.
    """
    blocks = found.filter("n > 0").select("host", F.explode("met").alias("b")).select("host", "b.*")
    lines = blocks.groupBy("host", "place", "line").agg(F.max("size").alias("size"), F.max(F.col("times") > 0).alias("met"))
    return lines.groupBy("host", "place").agg(F.sum("size").alias("size"), F.sum(F.expr("if(met, size, 0)")).alias("shared")).filter(
        "2 * shared > size").select("host", "place")


def gone_lines(found: DataFrame) -> DataFrame:
    """(host, digest, has_article, gone): indexes of the main lines that go, of the contents that lose any; ``found`` is from ``differenced``.

    Without a container: what a neighbour shares at a shared place, and all else there if the page's other lines hold more; at
    other places what the nearest neighbour shares, unless there are ``SURE`` or more and most don't: that is a quotation.
    In a container, as the check by structure has it for the article: only what most of ``SURE`` neighbours or more share at a shared place.
    """
    columns = ["host", "digest", "has_article"]
    may = F.expr(f"at >= 0 and if(has_article, times >= {SURE} and 2 * times > n, n > 0)")
    lines = found.select(*columns, "n", F.explode("met").alias("b")).select(*columns, "n", "b.*").filter(may)
    places = shared_places(found).withColumn("here", F.lit(True))
    judged = lines.join(places, ["host", "place"], "left").withColumns({
        "here": F.expr("here is not null"),
        "goes": F.expr(f"if(here, times > 0, not has_article and nearest and (n < {SURE} or 2 * times > n))")})
    sums = judged.groupBy(*columns).agg(
        F.expr("collect_list(if(goes, at, null))").alias("met"), F.expr("collect_list(if(here and not goes, at, null))").alias("rest"),
        F.expr("sum(if(here and not goes, size, 0))").alias("unmet"), F.expr("sum(if(here or goes, 0, size))").alias("own"))
    return sums.select(*columns, F.expr("if(own > unmet, concat(met, rest), met)").alias("gone")).filter("size(gone) > 0")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page."""
    found = stored(contents(parsed(pages)), "pages", "zstd")
    # Stored, because AQE splits hot keys only of a join whose sides come straight from their shuffles.
    gone = stored(gone_lines(stored(differenced(placed(found)), "differenced")), "gone")
    left = F.filter("main", lambda x, i: ~F.array_contains("gone", i.cast("int")))
    kept = F.when(F.col("gone").isNull() | (F.col("has_article") & (F.size(left) == 0)), F.col("main")).otherwise(left)
    return found.select("page_id", "url", "host", "digest", "has_article", "main").join(gone, ["host", "digest", "has_article"], "left").select(
        "page_id", "url", F.concat_ws(" ", kept).alias("text"))


def query(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
