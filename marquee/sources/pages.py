"""Landed article pages -> headline rows (the parsing half of a scrape).

Crawling is not done here; pages arrive as a table ``(page_id, url, html)``.
The headline is the first ``<h1>``; for outlet A pages the ``<h1>`` must
carry ``class="headline speakable"``. Text is the element's text with tags
removed and entities decoded; a page without a matching ``<h1>`` (or without
HTML, i.e. a failed fetch) gives a null headline.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import patterns as P

H1_ANY = r"(?is)<h1(?:[\t-\r ][^>]*)?>(.*?)</h1>"
H1_SPEAKABLE = r'(?is)<h1[\t-\r ][^>]*class="headline speakable"[^>]*>(.*?)</h1>'
H1_ENDS = r"(?is)^<h1(?:[\t-\r ][^>]*)?>|</h1>\z"
TAG = r"<[^>]+>"
NUMERIC_OR_TEXT = r"&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};|[^&]+|&"
# Named and numeric entities decoded, ``&amp;`` last so that
# ``&amp;lt;`` becomes ``&lt;`` (one decoding pass, as an HTML parser does).
ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
    ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&reg;", "®"),
    ("&hellip;", "…"), ("&ndash;", "–"), ("&mdash;", "—"),
    ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"), ("&rdquo;", "”"),
    ("&amp;", "&"),
]


def html_text(fragment: Column) -> Column:
    t = F.regexp_replace(fragment, TAG, "")
    for ent, ch in ENTITIES[:-1]:
        t = F.replace(t, F.lit(ent), F.lit(ch))
    return F.replace(_numeric_references(t), *map(F.lit, ENTITIES[-1]))


def _numeric_references(t: Column) -> Column:
    """``&#8217;`` and ``&#x2019;`` to their characters; values that are no character to U+FFFD."""
    def char(piece: Column) -> Column:
        digits = F.regexp_extract(piece, r"^&#[xX]?([0-9a-fA-F]+);\z", 1)
        radix = F.when(F.lower(F.substring(piece, 3, 1)) == "x", 16).otherwise(10)
        code = F.when(radix == 16, F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10)).cast("long")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        hexed = F.lpad(F.hex(F.when(valid, code).otherwise(F.lit(0xFFFD))), 8, "0")
        return F.when(digits == "", piece).otherwise(F.decode(F.unhex(hexed), "UTF-32"))

    pieces = F.regexp_extract_all(t, F.lit(NUMERIC_OR_TEXT), 0)
    return F.when(t.contains("&#"), F.array_join(F.transform(pieces, char), "")).otherwise(t)


def _headline_array(html: Column, url: Column | None, marker: str | None) -> Column:
    """One-element array: the element is matched once, its text taken from the match."""
    element = F.regexp_extract(html, H1_ANY, 0)
    if marker is not None and url is not None:
        is_a = F.coalesce(url.contains(marker), F.lit(False))
        element = F.when(is_a, F.regexp_extract(html, H1_SPEAKABLE, 0)).otherwise(element)
    return F.transform(F.array(element), lambda m: F.when(m != "", html_text(F.regexp_replace(m, H1_ENDS, ""))))


def page_headline(html: Column, url: Column | None = None, marker: str | None = None) -> Column:
    """Headline column; with ``marker`` the class rule applies to outlet A URLs."""
    return _headline_array(html, url, marker)[0]


def page_headlines(pages: DataFrame, marker: str | None = None, a: str = P.OUTLET_A,
                   b: str = P.OUTLET_B) -> DataFrame:
    """``(row_id, url, headline, source)``; null html -> null headline and source.

    The headline leaves a generator, so that filters on it stay above and the
    html is searched once per page, not once per mention of the headline."""
    html, url = F.col("html"), F.col("url")
    source = F.when(html.isNull(), F.lit(None).cast("string")).otherwise(
        F.when(F.coalesce(url.contains(marker or P.OUTLET_A_SITE), F.lit(False)), F.lit(a)).otherwise(F.lit(b)))
    return pages.select(
        F.col("page_id").alias("row_id"), url,
        F.explode_outer(_headline_array(html, url, marker)).alias("headline"),
        source.alias("source"))
