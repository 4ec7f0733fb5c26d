"""Line de-duplication by site-relative frequency, in DataFrame operations only.

A page's lines are what its block elements hold. Pages are grouped by host; the share of a host's pages that
contain a line is its site-relative frequency. Lines above ``ratio`` on at least ``least_pages`` pages of their
host are boilerplate (menus, banners, footers) and are dropped from that host's pages.

The shares of a host's lines add up to the mean number of distinct lines of its pages, so a host has at most
(that mean / ``ratio``) boilerplate lines; their digests go into one row per host. That row meets the host's
pages in ``SALTS`` copies, so that no host's pages come together in one task, or is broadcast where all such
rows together are small, which their bytes decide.

Defined cases: null html has no lines; a null url, or one without a host, belongs to the host named by the empty
text. Repeated rows are pages of their own. A null page id is kept. An empty table gives an empty result.
Further columns do not matter. Pages can be of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanemart.llm.common import cut

SALTS = 32
#: Bytes of digests and hosts up to which they are broadcast.
BROADCAST_BYTES = 32 << 20

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)"
UNSEEN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
BREAKS = r"(?i)</?(?:p|div|br|li|ul|ol|dl|dt|dd|h[1-6]|tr|td|th|table|nav|header|footer|section|article|aside|main|title|body|html|head|pre|blockquote|form|hr)\b[^>]*>"
TAGS = r"<[^>]*>"
SPACES = "[ \\t\\r\\f\\x0b\u00a0]+"
#: Replaced in this order, the ampersand last.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")))


def lines_of(html: Column) -> Column:
    """The lines of a page, in order, without empty ones."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), UNSEEN, " ")
    text = F.regexp_replace(F.regexp_replace(text, BREAKS, "\n"), TAGS, "")
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    text = F.regexp_replace(text, SPACES, " ")
    return F.filter(F.transform(F.split(text, "\n", -1), lambda x: F.trim(x)), lambda x: x != "")


def _digest(line: Column) -> Column:
    return F.unhex(F.sha2(line, 256))


def boilerplate(lined: DataFrame, ratio: float, least_pages: int) -> DataFrame:
    """``(host, digests)`` of the boilerplate lines, from pages with ``host`` and ``lines``."""
    each = lined.select("host", F.explode(F.array_distinct(F.transform("lines", _digest))).alias("digest"))
    holding = each.groupBy("host", "digest").agg(F.count(F.lit(1)).alias("pages"))
    totals = lined.groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    frequent = holding.filter(F.col("pages") >= least_pages).join(totals, "host")
    frequent = frequent.filter(F.col("pages") > ratio * F.col("total"))
    return frequent.groupBy("host").agg(F.collect_list("digest").alias("digests"))


def drop_boilerplate(
    pages: DataFrame, ratio: float = 0.3, least_pages: int = 3, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """Per page its id, ``host``, ``n_lines``, ``n_dropped`` and ``text``, the lines that stay."""
    lined = pages.select(F.col(id_column).alias("id"), host_of(F.col(url_column)).alias("host"), lines_of(F.col(html_column)).alias("lines"))
    known = cut(boilerplate(lined, ratio, least_pages))
    size = known.agg(F.sum(F.octet_length("host") + 48 * F.size("digests"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        met = lined.join(F.broadcast(known), "host", "left")
    else:
        salted = known.select("host", "digests", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        lined = lined.withColumn("salt", F.pmod(F.xxhash64("id", "lines"), F.lit(SALTS)).cast("int"))
        met = lined.join(salted, ["host", "salt"], "left")
    digests = F.coalesce("digests", F.array().cast("array<binary>"))
    kept = F.filter("lines", lambda x: ~F.array_contains(digests, _digest(x)))
    met = met.withColumn("kept", kept)
    return met.select(
        F.col("id").alias(id_column), "host", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"), F.array_join("kept", "\n").alias("text"),
    )
