"""Main text of web pages, by markup and by differencing each page with the nearest one of its site.

A page is cut into blocks, one line each. Lines within elements that are marked as something else
(menus, page headers, footers, sidebars, adverts, forms, notices, reader comments) go. What the site
repeats is found by differencing, for every page: pages are put in order of URL path within their host,
each is paired with the neighbour whose path agrees with its own for longest, their lines are aligned
by longest common subsequence, and the shared lines are deleted.

Pages that share nearly all they say are copies and tell nothing of what the site repeats. Pages of
equal lines are one page, under their least path; neighbours whose shared lines hold ``NEAR`` of the
characters of both are of one run, and a page's neighbours are the pages before and after its run.

If a page marks its article, a check against the markup follows: lines outside of the article go, shared or
not (menus drawn anew for each page would stay), and running lines of the article come back, shared or not
(articles that quote one another would lose what they share). Lines of an article in blocks whose names
hold a mark among other words ("related-stories") are in doubt, and of these differencing has the last word.

Lines travel as 64-bit hashes. The order is made of range partitions with a page's digest as last key,
so a host with most of the pages is spread over many tasks; only the first and last page of each
partition, and of the runs it cuts, are matched across partitions.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import keep

# Elements whose content is no text at all.
RAW = "head iframe math noscript object script select style svg template textarea title".split()
# Elements that begin a line.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
# Elements that hold the article, and those that hold none of it.
ARTICLES = {"article", "main"}
ASIDES = set("aside button dialog footer form header menu nav".split())
# Words of class and id that mark something else than the article.
MARKS = set(
    "ad adbox ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo related "
    "share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
# Words that make a class say what an element has or lacks (has-sidebar, ad-free, comments-off), not what it is.
STATES = {"free", "has", "no", "off", "with", "without"}
# Elements that hold whole pages; their classes tell of the page.
PAGES = {"html", "body", "main"}
# Words that only say what kind of part a mark names (comment-list, share-buttons).
PARTS = set(
    "area bar block body box button buttons container content form inner item items link links list posts row section "
    "signup site slot text thread top unit wrap wrapper".split()
)
# Blocks that hold running text; within an article a class of theirs does not make them something else.
RUNNING = set("blockquote dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre td th".split())
# Part of the characters of both pages that near copies share.
NEAR = 0.8
VOID = set("area base br col embed hr img input link meta source track wbr".split())
_SCAN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>]).*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_NAMED = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_WORD = re.compile(r"[a-z0-9]+")


def marked(tag: str, attrs: str, inside: bool = False) -> str:
    """How class, id or role name an element as something else than the article: "whole", "partly" or "" for not.

    A name is a whole mark if it has no words but marks and words for parts ("ad", "comment-list"), and a
    partial one if it holds a mark among others ("notice-of-motion"). An outermost article needs a name that is
    a mark itself; within an article only blocks are marked, and those of running text wholly by the mark itself only.
    """
    if tag in PAGES or inside and tag not in BLOCKS:
        return ""
    found = ""
    running = inside and tag in RUNNING and not _says(attrs, MARKS)
    for name in _names(attrs):
        words = {name} if tag == "article" and not inside else set(_WORD.findall(name))
        if MARKS.isdisjoint(words) or not STATES.isdisjoint(words):
            continue
        if words <= MARKS | PARTS and not running:
            return "whole"
        found = "partly"
    return found


def _names(attrs: str) -> list[str]:
    return [name for a, b, c in _NAMED.findall(attrs) for name in (a or b or c).lower().split()]


def _says(attrs: str, names: set[str]) -> bool:
    return not names.isdisjoint(_names(attrs))


# Where a line stands: outside of any article, in a block of an article that is in doubt, or in the article.
OUTSIDE, DOUBTED, WITHIN = 0, 1, 2


def lines_of(page: str) -> tuple[list[str], list[int]]:
    """The unmarked lines of a page, and where each stands.

    Where the names of elements leave no line at all, they are not believed: only the elements themselves count.
    """
    lines, stands = _lines(page, names=True)
    return (lines, stands) if lines else _lines(page, names=False)


def _lines(page: str, names: bool) -> tuple[list[str], list[int]]:
    lines: list[str] = []
    stands: list[int] = []
    text: list[str] = []
    article = 0
    # The element whose content goes, how many of its name are open within it, and whether an article ends it.
    aside, depth, doubtful = "", 0, False
    # The block of the article whose lines are in doubt, and how many of its name are open within it.
    doubted, open_doubted = "", 0

    def end_line() -> None:
        line = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if line:
            lines.append(line)
            stands.append((DOUBTED if doubted else WITHIN) if article else OUTSIDE)

    at = 0
    for m in _SCAN.finditer(page):
        if not aside and m.start() > at:
            text.append(page[at : m.start()])
        at = m.end()
        if m["tag"] is None:
            continue
        tag, closing = m["tag"].lower(), bool(m["end"])
        if aside:
            if aside == "p" and tag in BLOCKS and not (tag == "p" and closing):
                aside = ""  # a paragraph ends at the edge of the next block
            elif tag in ARTICLES and not closing and doubtful and not marked(tag, m["attrs"]):
                aside = ""  # a menu that was never closed, or no aside at all
            else:
                if tag == aside:
                    depth += -1 if closing else not m["attrs"].endswith("/")
                    if not depth:
                        aside = ""
                continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCKS:
            end_line()
            if doubted in RUNNING or doubted and closing and tag in ARTICLES:
                doubted = ""  # running text ends at the edge of the next block
            elif tag == doubted:
                open_doubted += -1 if closing else 1
                doubted = doubted if open_doubted else ""
        if closing:
            article = max(0, article - 1) if tag in ARTICLES else article
            continue
        mark = names and tag not in VOID and m["attrs"] and marked(tag, m["attrs"], article > 0)
        if mark == "partly" and article and tag not in ASIDES:
            if not doubted:
                doubted, open_doubted = tag, 1
        elif mark or tag in ASIDES and not (tag == "header" and article):
            if tag not in BLOCKS:
                text.append(" ")
            aside, depth, doubtful = tag, 1, mark == "partly" or tag in ("nav", "header", "menu")
        elif tag in ARTICLES:
            article += 1
    if not aside:
        text.append(page[at:])
    end_line()
    return lines, stands


def shared(own: list[int], other: list[int]) -> list[int]:
    """Places in ``own`` of a longest common subsequence with ``other``.

    Values that are not on both sides can't be in it and go first. What is left is split in halves
    (Hirschberg), each half's lengths come from bit vectors, so memory is linear.
    """
    both = set(own) & set(other)
    a = [i for i, v in enumerate(own) if v in both]
    return [a[i] for i in _common([own[i] for i in a], [v for v in other if v in both])]


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and each prefix of ``b``."""
    match: dict[int, int] = {}
    for j, v in enumerate(b):
        match[v] = match.get(v, 0) | 1 << j
    every = (1 << len(b)) - 1
    row = every
    for v in a:
        hit = row & match.get(v, 0)
        row = (row + hit | row & ~hit) & every
    raw = np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), dtype=np.uint8)
    steps = 1 - np.unpackbits(raw, bitorder="little")[: len(b)].astype(np.int64)
    return np.concatenate([[0], steps.cumsum()])


def _common(a: list[int], b: list[int]) -> list[int]:
    out: list[int] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append(a0)
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append(a1)
        if a0 == a1 or b0 == b1:
            continue
        if a1 - a0 == 1:
            out += [a0] if a[a0] in b[b0:b1] else []
            continue
        middle = (a0 + a1) // 2
        front = _lengths(a[a0:middle], b[b0:b1])
        back = _lengths(a[middle:a1][::-1], b[b0:b1][::-1])[::-1]
        cut = b0 + int((front + back).argmax())
        todo += [(a0, middle, b0, cut), (middle, a1, cut, b1)]
    return sorted(out)


PARSED = T.StructType([
    T.StructField("lines", T.ArrayType(T.StringType())),
    T.StructField("fixed", T.ArrayType(T.BooleanType())),
    T.StructField("hashes", T.ArrayType(T.LongType())),
    T.StructField("sizes", T.ArrayType(T.IntegerType())),
])


@F.pandas_udf(PARSED)
def parsed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """The unmarked lines, which of them the markup says to be of the article; hashes and lengths of all.

    On a page with a marked article the lines outside of it are null. Without one no line is fixed.
    """
    for pages in batches:
        rows = []
        for page in pages:
            lines, stands = lines_of(page or "")
            hashes = np.array([xxhash.xxh64_intdigest(line.encode()) for line in lines], dtype=np.uint64).view(np.int64)
            sizes = [len(line) for line in lines]
            if any(stands):
                lines = [line if where else None for line, where in zip(lines, stands, strict=True)]
            rows.append((lines, [where == WITHIN for where in stands], hashes, sizes))
        yield pd.DataFrame(rows, columns=["lines", "fixed", "hashes", "sizes"])


@F.pandas_udf(T.ArrayType(T.BooleanType()))
def shared_lines(own: pd.Series, other: pd.Series) -> pd.Series:
    """Which lines of a page are in the longest common subsequence with its neighbour's."""
    found = []
    for a, b in zip(own, other, strict=True):
        marks = np.zeros(len(a), dtype=bool)
        marks[shared(a.tolist(), b.tolist())] = True
        found.append(marks)
    return pd.Series(found, dtype=object)


@F.pandas_udf(T.BooleanType())
def near(own: pd.Series, own_sizes: pd.Series, other: pd.Series, other_sizes: pd.Series) -> pd.Series:
    """Whether the lines two pages share hold ``NEAR`` of the characters of both; false where there is no other."""
    found = []
    for a, m, b, n in zip(own, own_sizes, other, other_sizes, strict=True):
        if b is None:
            found.append(False)
            continue
        parts = [(m[np.isin(a, b)].sum(), m.sum()), (n[np.isin(b, a)].sum(), n.sum())]
        found.append(bool(all(shared >= NEAR * whole for shared, whole in parts)))
    return pd.Series(found, dtype=bool)


def common_length(one: Column, other: Column) -> Column:
    """Characters that two paths agree in from the start."""
    places = F.sequence(F.lit(1), F.least(F.length(one), F.length(other)) + 1)
    # The first place where they part; one past the shorter, both have none there.
    differs = F.filter(places, lambda i: (F.substring(one, i, 1) != F.substring(other, i, 1)) | (i > F.least(F.length(one), F.length(other))))
    return F.array_min(differs) - 1


def nearest(pages: DataFrame) -> DataFrame:
    """(host, path, digest, hashes, sizes) to (host, digest, hashes, other): each page's nearest neighbour by URL.

    Pages of equal host and digest are one, and near copies side by side have the neighbours of their run.
    Pages with no other content on their host are left out.
    """
    order = ["host", "path", "digest"]
    single = pages.groupBy("host", "digest").agg(
        F.min("path").alias("path"), F.min_by(F.struct("hashes", "sizes"), "path").alias("said")
    ).select(*order, "said.*")
    ranged = keep(single.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "url-order")
    key, page = F.struct(*order), F.struct(*order, "hashes", "sizes")
    within = W.partitionBy("part").orderBy(*order)
    placed = ranged.withColumn("before", F.lag(page).over(within)).withColumn("after", F.lead(page).over(within))
    # First and last page of each part: as many rows as there are parts.
    first = ranged.groupBy("part").agg(F.min_by(page, key).alias("first"), F.max_by(page, key).alias("last"))
    parts = W.orderBy("part")
    edges = first.select("part", F.lag("last").over(parts).alias("part_before"), F.lead("first").over(parts).alias("part_after"))

    def of_host(side: str) -> Column:
        other = F.coalesce(side, f"part_{side}")
        return F.when(other["host"] == F.col("host"), other)

    both = placed.join(edges, "part").withColumns({side: of_host(side) for side in ("before", "after")})
    both = both.withColumns({
        f"near_{side}": near("hashes", "sizes", F.col(side)["hashes"], F.col(side)["sizes"]) for side in ("before", "after")
    })

    def other(side: str) -> Column:
        """What lies beyond the run, at its edge; wrapped, as it may be nothing; null within the run."""
        content = F.when(F.col(side).isNotNull(), F.struct(F.col(side)["path"].alias("path"), F.col(side)["hashes"].alias("hashes")))
        return F.when(~F.col(f"near_{side}"), F.struct(content.alias("page")))

    runs = keep(both.select("part", *order, "hashes", *(other(side).alias(side) for side in ("before", "after"))), "runs")
    # The last edge before each part, and the first after it: as many rows as there are parts.
    handed = runs.groupBy("part").agg(
        F.max_by("before", F.when(F.col("before").isNotNull(), key)).alias("before"),
        F.min_by("after", F.when(F.col("after").isNotNull(), key)).alias("after"),
    )
    earlier, later = parts.rowsBetween(W.unboundedPreceding, -1), parts.rowsBetween(1, W.unboundedFollowing)
    handed = handed.select(
        "part", F.last("before", ignorenulls=True).over(earlier).alias("part_before"),
        F.first("after", ignorenulls=True).over(later).alias("part_after"),
    )
    upto, onward = within.rowsBetween(W.unboundedPreceding, 0), within.rowsBetween(0, W.unboundedFollowing)
    beyond = runs.withColumns({
        "before": F.last("before", ignorenulls=True).over(upto), "after": F.first("after", ignorenulls=True).over(onward),
    }).join(handed, "part")
    beyond = beyond.select(*order, "hashes", *(
        F.coalesce(side, f"part_{side}")["page"].alias(side) for side in ("before", "after")
    ))
    beyond = beyond.withColumns({
        f"at_{side}": F.when(F.col(side).isNotNull(), common_length(F.col("path"), F.col(side)["path"])) for side in ("before", "after")
    })
    after = F.col("at_before").isNull() | (F.col("at_after") > F.col("at_before"))
    chosen = F.when(after, F.col("after")["hashes"]).otherwise(F.col("before")["hashes"])
    known = beyond.where("before is not null or after is not null")
    return known.select("host", "digest", "hashes", chosen.alias("other"))


def extracted(pages: DataFrame, key: str = "page_id", url: str = "url", markup: str = "html") -> DataFrame:
    """(key, url, text, n_chars) for every row: the main text, blocks joined by line breaks.

    A null or empty page has an empty text. Pages without a URL are of one host without a name.
    Repeated rows stay repeated and are copies of each other. An empty table gives no rows. Very long pages are
    read whole; an alignment's memory is linear in a page's lines.
    """
    address = F.coalesce(F.col(url), F.lit(""))
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).alias("url"),
        F.lower(F.regexp_extract(address, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(address, "^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1).alias("path"),
        parsed(markup).alias("page"),
    )
    rows = rows.select("key", "url", "host", "path", "page.*").withColumn("digest", F.xxhash64("hashes"))
    # Read twice, as texts are larger than what it takes to pair the pages.
    pairs = nearest(rows.select("host", "path", "digest", "hashes", "sizes"))
    marks = pairs.select("host", "digest", shared_lines("hashes", "other").alias("shared"))
    diffed = rows.select("key", "url", "host", "digest", "lines", "fixed").join(marks, ["host", "digest"], "left")

    def stays(line: Column, i: Column) -> Column:
        return line.isNotNull() & (F.get("fixed", i) | ~F.coalesce(F.get("shared", i), F.lit(False)))

    out = diffed.select("key", "url", F.array_join(F.filter("lines", stays), "\n").alias("text"))
    return out.select(F.col("key").alias(key), F.col("url").alias(url), "text", F.length("text").cast("long").alias("n_chars"))
