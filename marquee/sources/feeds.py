"""RSS feed text -> item titles (the parsing half of a feed search).

Fetching is not done here; feeds arrive as XML strings in a column. Each
``<item>``'s ``<title>`` text (CDATA as it is, otherwise entities decoded) has
its trailing outlet suffix removed and is stripped; items without a title and
titles that end up empty are skipped. Items are found by pattern, so a broken
feed gives the items that are whole instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import text as T
from marquee.sources.pages import html_text

ITEM = r"(?is)<item(?:[\t-\r ][^>]*)?>(.*?)</item>"
TITLE = r"(?is)<title(?:[\t-\r ][^>]*)?>(.*?)</title>"
CDATA = r"(?s)^[\t-\r ]*<!\[CDATA\[(.*)\]\]>[\t-\r ]*\z"

# Characters not allowed in XML 1.0 documents.
XML_INVALID = r"[^\x{09}\x{0a}\x{0d}\x{20}-\x{d7ff}\x{e000}-\x{fffd}\x{10000}-\x{10ffff}]"


def xml_escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def feed_from_lines(text: Column, suffix: Column) -> Column:
    """One RSS document: a titled item per non-empty line, an untitled item per empty line."""
    clean = F.regexp_replace(F.regexp_replace(text, "\r", ""), XML_INVALID, "")
    items = F.transform(F.split(clean, "\n"), lambda ln: F.when(
        ln == "", F.lit("<item><link>-</link></item>")).otherwise(
        F.concat(F.lit("<item><title>"), xml_escape(F.concat(ln, suffix)), F.lit("</title></item>"))))
    return F.concat(F.lit("<rss><channel>"), F.array_join(items, ""), F.lit("</channel></rss>"))


def feed_titles(feeds: DataFrame, feed_col: str = "feed", id_col: str = "row_id", suffixes=None) -> DataFrame:
    """(row_id, headline) for every titled item with a non-empty cleaned title."""
    def title(item):
        raw = F.regexp_extract(item, TITLE, 1)
        return F.when(raw.rlike(CDATA), F.regexp_extract(raw, CDATA, 1)).otherwise(html_text(raw))

    titles = F.explode_outer(F.transform(F.regexp_extract_all(F.col(feed_col), F.lit(ITEM), 1), title))
    x = feeds.select(F.col(id_col).alias("row_id"), titles.alias("_title")).where(F.col("_title").isNotNull())
    x = x.select("row_id", T.strip_title_suffix(F.col("_title"), suffixes).alias("headline"))
    return x.where(F.col("headline") != "")
