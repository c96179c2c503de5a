"""Line dedup by site-relative frequency: lines on too large a share of a host's pages are boilerplate.

For every host: pages that contain a line / pages of the host. A line is dropped from all pages of the
host when that ratio exceeds ``RATIO`` and it is on at least ``LEAST_PAGES`` pages (a line on one page is no
repeat, however few pages its host has). What is left of each page, and what went, is returned.

Counting is a grouped sum over (host, 128-bit line hash) of lines distinct within their page, combined
map-side, so a line on every page of a host that holds a third of all pages is one row a task. The lines of all
pages are then joined to the boilerplate lines by (host, line hash) and pages are rebuilt in line order: the work grows
with the lines, however many a page or host has. A boilerplate line's side is one row; Spark splits the other side
where a line is on very many pages, or broadcasts the first where it is small.

Lines of HTML are the text between block-level tags, without scripts, styles, comments and inline tags, with white
space squeezed. Plain texts are split at line breaks.

Cases: null or empty html has no lines; a null or unparsable url makes the host null, a host of its own; blank
lines are neither counted nor kept; a line repeated in one page counts once for the ratio and goes at
every place; repeated rows and null page_ids are pages like others; a page of any length is taken whole; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dugout.llm.common import small, staged

RATIO = 0.1
LEAST_PAGES = 2

# Elements whose bounds break a line, and elements whose content is no text.
BLOCKS = ("address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head "
          "header hr html li main nav ol option p pre section table tbody td tfoot th thead title tr ul").split()
HIDDEN = "script style noscript template".split()
# A tag ends before the next "<"; a comment or hidden element that is never closed ends with the page, so no opener is tried twice.
HIDDEN_PART = r"(?is)<!--.*?(?:-->|$)|" + "|".join(rf"<{t}\b[^<>]*>.*?(?:</{t}\s*>|$)" for t in HIDDEN)
BLOCK_TAG = r"(?i)</?(?:" + "|".join(BLOCKS) + r")\b[^<>]*>"
TAG = r"<[^<>]*>"
HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host_of(url: str | Column = "url") -> Column:
    """Lower-case host without user and port; null where there is none."""
    c = F.col(url) if isinstance(url, str) else url
    host = F.regexp_extract(c, HOST, 1)
    return F.when(F.length(host) > 0, F.lower(host))


def html_lines(html: str | Column = "html") -> Column:
    """Text lines of an HTML page."""
    c = F.coalesce(F.col(html) if isinstance(html, str) else html, F.lit(""))
    text = F.regexp_replace(F.regexp_replace(c, HIDDEN_PART, " "), r"[\n\r]+", " ")
    text = F.regexp_replace(F.regexp_replace(text, BLOCK_TAG, "\n"), TAG, "")
    return squeezed(F.split(text, "\n"))


def squeezed(lines: Column) -> Column:
    """Lines without outer and repeated white space; blank lines go."""
    return F.filter(F.transform(lines, lambda x: F.trim(F.regexp_replace(x, r"[ \t\x0B\f\r]+", " "))), lambda x: x != "")


def line_hash(line: Column) -> Column:
    """128 bits of a line as two longs."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(line, F.lit("line")).alias("b"))


def boilerplate(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, line, pages, host_pages, ratio): the boilerplate lines' hashes. ``pages``: host, lines."""
    hashed = pages.select("host", F.explode(F.array_distinct("lines")).alias("text")).select("host", line_hash(F.col("text")).alias("line"))
    counts = hashed.groupBy("host", "line").agg(F.count("*").alias("pages")).where(F.col("pages") >= least_pages)
    hosts = small(staged(pages.groupBy("host").agg(F.count("*").alias("host_pages")).where(F.col("host_pages") >= least_pages), "lines-hosts"))
    c, h = counts.alias("c"), hosts.alias("h")
    share = F.col("pages") / F.col("host_pages")
    return (c.join(h, F.col("c.host").eqNullSafe(F.col("h.host"))).where(share > ratio)
            .select("c.host", "line", "pages", "host_pages", share.alias("ratio")))


def drop_boilerplate(pages: DataFrame, lines: Column | None = None, ratio: float = RATIO,
                     least_pages: int = LEAST_PAGES) -> DataFrame:
    """(page_id, url, html) -> page_id, host, host_pages, n_lines, n_dropped, text: every page without its host's boilerplate."""
    rows = pages.select("page_id", host_of().alias("host"), (html_lines() if lines is None else lines).alias("lines"))
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "lines-pages")       # page_ids may be null or repeated
    marked = staged(boilerplate(rows, ratio, least_pages).select("host", "line"), "lines-marked").alias("m")
    each = rows.select("row", "host", F.posexplode("lines").alias("nth", "text")).withColumn("line", line_hash(F.col("text"))).alias("l")
    same = F.col("l.host").eqNullSafe(F.col("m.host")) & (F.col("l.line.a") == F.col("m.line.a")) & (F.col("l.line.b") == F.col("m.line.b"))
    gone = each.join(small(marked), same, "left_semi").groupBy("row").agg(F.collect_set("nth").alias("gone"))
    # a page's dropped places, at most its lines; only pages that lose a line take part
    hosts = small(staged(rows.groupBy("host").agg(F.count("*").alias("host_pages")), "lines-all-hosts")).alias("h")
    p = rows.join(gone, "row", "left").alias("p").join(hosts, F.col("p.host").eqNullSafe(F.col("h.host")))
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(_without("lines", "gone"))
    return (p.select("page_id", "p.host", "host_pages", "lines", kept.alias("kept"))
            .select("page_id", "host", "host_pages", F.size("lines").alias("n_lines"),
                    (F.size("lines") - F.size("kept")).alias("n_dropped"), F.concat_ws("\n", "kept").alias("text")))


def _without(lines: str, gone: str) -> Column:
    """The lines whose places are not in ``gone``: both lists are walked once, as maps from place to line."""
    places = F.sequence(F.lit(0), F.size(lines) - 1)
    stay = F.array_sort(F.array_except(places, F.col(gone)))
    return F.transform(stay, lambda i: F.get(lines, i))
