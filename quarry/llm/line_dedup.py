"""Site-relative line frequency: drop the lines that a site repeats on its pages.

A page's lines are those of its visible text: scripts, styles and comments go (to the end of
the page where they are not closed), block-level tags end a line, other tags vanish. Pages are grouped by host; a line
whose pages are more than ``ratio`` of the host's pages (and at least
``least_pages`` of them) is boilerplate of that host and is dropped from its
pages.

Counts combine on the map side, so a hot host or line sends one row per task. A
host has fewer than (its mean lines per page / ratio) boilerplate lines, which
bounds the one array per host that is joined back to the pages; the pages keep
their text where it is if that table is small, else the join can split hot hosts.

Built-in expressions only. Defined cases: a null page is empty; pages without a
host (null, empty or relative url) are no site and lose nothing; blank lines are
no lines; a line counts once per page; repeated rows are separate pages; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import fresh, let, named
from quarry.operators.staging import broadcast_if_small, stage

RATIO = 0.1
LEAST_PAGES = 3

# Fixed values, the same in the SQL: what is no text, and the tags that end a line.
HIDDEN = r"(?is)<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|<!--.*?(?:-->|\z)"
BLOCK = (r"(?i)</?(?:html|head|title|body|main|article|section|header|footer|nav|aside|div|p|ul|ol|li|h1|h2|h3|h4|h5|h6|"
         r"br|hr|table|tr|td|th|pre|blockquote|form)\b[^>]*>")
TAG = r"<[^>]*>"
EDGES = " \t\n\x0b\f\r"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def visible_lines(html: Column) -> Column:
    """The lines of a page's visible text, in time linear in the page's length: what is hidden and not
    closed runs to the end, and tags are looked for up to the last ``>`` only, as none closes after it."""
    text = F.regexp_replace(F.coalesce(html.cast("string"), F.lit("")), HIDDEN, "")

    def tags(text: Column, pattern: str, put: str) -> Column:
        return let(text, lambda t: let(F.substring_index(t, ">", -1), lambda rest: F.concat(
            F.regexp_replace(F.left(t, F.length(t) - F.length(rest)), pattern, put), rest)))

    return F.filter(F.transform(F.split(tags(tags(text, BLOCK, "\n"), TAG, ""), "\n"), lambda x: F.btrim(x, F.lit(EDGES))), lambda x: x != "")


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), HOST, 1))


def boilerplate(lines: DataFrame, host: str, line: str, ratio: float, least_pages: int) -> DataFrame:
    """Per host: the array of its boilerplate lines."""
    site = lines.where(F.col(host) != "")
    totals = site.groupBy(host).agg(F.count(F.lit(1)).alias("pages"))
    totals = broadcast_if_small(stage(totals.where(F.col("pages") >= least_pages), "line-hosts"))
    counts = (site.select(host, F.explode(F.array_distinct(line)).alias("one"))
              .groupBy(host, "one").agg(F.count(F.lit(1)).alias("on")).where(F.col("on") >= least_pages))
    common = counts.join(totals, host).where(F.col("on") > F.lit(ratio) * F.col("pages"))
    return common.groupBy(host).agg(F.collect_list("one").alias("common"))


def line_dedup(df: DataFrame, html: str = "html", url: str = "url", ratio: float = RATIO,
               least_pages: int = LEAST_PAGES) -> DataFrame:
    """All columns of ``df``, then host, n_lines, kept_lines (array, in order)."""
    host, line, shared = fresh(df, "host"), fresh(df, "__lines"), fresh(df, "__common")
    pages = df.select("*", host_of(named(url)).alias(host), visible_lines(named(html)).alias(line))
    common = broadcast_if_small(stage(boilerplate(pages.select(host, line), host, line, ratio, least_pages), "line-common"))
    joined = pages.join(common.withColumnRenamed("common", shared), host, "left")
    kept = F.when(F.col(shared).isNull(), F.col(line)).otherwise(
        F.filter(line, lambda x: ~F.array_contains(shared, x)))
    return joined.select(*[named(c) for c in df.columns], host, F.size(line).alias(fresh(df, "n_lines")),
                         kept.alias(fresh(df, "kept_lines")))
