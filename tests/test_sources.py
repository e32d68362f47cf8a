from pyspark.sql import functions as F

from marquee.sources.feeds import feed_from_lines, feed_titles
from marquee.sources.pages import page_headline, page_headlines


def test_page_headline_rules(spark):
    pages = spark.createDataFrame([
        (1, "https://www.foxnews.com/a", '<h1 class="other">Nope</h1><h1 class="headline speakable">Fox &amp; <b>Co</b></h1>'),
        (2, "https://www.nbcnews.com/b", "<h1>Plain &quot;one&quot;</h1><h1>second</h1>"),
        (3, "https://www.foxnews.com/c", "<h1>no class here</h1>"),
        (4, "https://www.nbcnews.com/d", "<h1></h1>"),
        (5, "https://www.nbcnews.com/e", None),
    ], "page_id long, url string, html string")
    got = {r["row_id"]: (r["headline"], r["source"]) for r in page_headlines(pages, marker="foxnews.com").collect()}
    assert got[1] == ("Fox & Co", "FoxNews")
    assert got[2] == ('Plain "one"', "NBC")
    assert got[3] == (None, "FoxNews")        # outlet A needs the speakable class
    assert got[4] == ("", "NBC")              # present but empty
    assert got[5] == (None, None)             # failed fetch: no headline, no source
    odd = spark.createDataFrame([(1, "<H1 id='x'>It&#8217;s a &lt; b &#x1F600; &amp;#39; &#xD800; &#0; R&D<br></H1> <h1>no</h1>"),
                                 (2, "<h1>a < b</h1>"), (3, "<h1>open"), (4, "")], "row_id long, html string")
    heads = {r["row_id"]: r["h"] for r in odd.select("row_id", page_headline(F.col("html")).alias("h")).collect()}
    assert heads == {1: "It\u2019s a < b \U0001F600 &#39; \uFFFD \uFFFD R&D", 2: "a < b", 3: None, 4: None}
    any_h1 = pages.select(page_headline(F.col("html")).alias("h")).collect()
    assert any_h1[0]["h"] == "Nope"


def test_feed_titles(spark):
    df = spark.createDataFrame([(1, "First & best\n\n   \nSecond <one>", " - Fox News")],
                               "row_id long, text string, suffix string")
    feeds = df.select("row_id", feed_from_lines(F.col("text"), F.col("suffix")).alias("feed"))
    assert sorted(r["headline"] for r in feed_titles(feeds).collect()) == ["First & best", "Second <one>"]


def test_broken_feeds_give_their_whole_items(spark):
    feeds = spark.createDataFrame([
        (1, "<rss><channel><item><title>One &#8211; two &amp; three - Fox News</title></item><item><title>cut"),
        (2, "<rss><item><title><![CDATA[ A <b> & c ]]></title></item><item><link>x</link></item></rss>"),
        (3, "no feed & <at all"), (4, None)], "row_id long, feed string")
    got = sorted((r["row_id"], r["headline"]) for r in feed_titles(feeds).collect())
    assert got == [(1, "One \u2013 two & three"), (2, "A <b> & c")]
