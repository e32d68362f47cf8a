"""URL allow and block rules by a sort-merge range join, in DataFrame operations only.

The labels of a host are reversed and each is closed by a NUL, so the host
and all its subdomains are one interval of keys: from ``com\\0example\\0`` up
to, not including, ``com\\0example\\1``. Intervals of rule hosts are nested or
apart. Starts, ends and URLs are sorted by key and swept in one pass; the
sweep keeps the stack of open intervals, one slot per nesting depth (a rule
host of n labels has depth n): an event opens or closes its slot, a URL reads
the slots. The stack holds the rules of each open host; those whose path
starts the URL's path fit, the longest rule wins.

Sweeps run side by side: one for each pair of top-level label and salt (a
hash of the row), so a host or a top-level label with a third of all pages is
swept in ``SALTS`` parts; the events are repeated per salt, the pages never.

Defined cases: a null URL or one without ``://`` has empty host and path and
fits no rule; no rule gives a null rule and the verdict ``allow``; two rules
of one host and path count as ``block`` if either is; rules with a null or
empty host or a NUL in it are left out; an empty rule table allows all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm.common import P, SALTS, salt

#: The rules of the registered query (verdict, host, path).
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]
OTHERWISE = "allow"
_RULES = "array<struct<host:string,path:string,verdict:string>>"


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: behind the first ``://`` up to ``/``, ``?``, ``#`` or the end; path: then up to ``?``, ``#`` or the end."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(F.regexp_extract(rest, r"(?s)^[^?#]*", 0), F.lit(""))
    slash = F.locate("/", rest)
    host = F.when(slash > 0, F.substring(rest, F.lit(1), slash - 1)).otherwise(rest)
    path = F.when(slash > 0, F.substr(rest, slash)).otherwise(F.lit(""))
    return ascii_lower(host), path


def key_of(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "\0"), F.lit("\0"))


def judged(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
           otherwise: str = OTHERWISE, salts: int = SALTS) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page."""
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    urls = urls.withColumns({"key": key_of(F.col("host")), "top": F.element_at(F.split("host", r"\.", -1), -1),
                             "salt": salt(F.struct("page_id", "host", "path"), salts), "kind": F.lit(2)})
    by_host = (rules.where("host <> '' AND instr(host, char(0)) = 0")
               .groupBy(ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"))
               .agg(F.max("verdict").alias("verdict"))  # 'block' sorts behind 'allow'
               .groupBy("host").agg(F.collect_list(F.struct("host", "path", "verdict")).alias("rules")))
    by_host = by_host.withColumns({"key": key_of(F.col("host")), "depth": F.size(F.split("host", r"\.", -1))})
    deepest = by_host.agg(F.max("depth")).first()[0] or 0  # names have at most some hundred labels
    ends = by_host.select(F.concat(F.expr("substr(key, 1, length(key) - 1)"), F.lit("\1")).alias("key"), "host", "depth",
                          F.expr(f"cast(array() as {_RULES})").alias("rules"), F.lit(0).alias("kind"))
    events = by_host.select("key", "host", "depth", "rules", F.lit(1).alias("kind")).unionByName(ends)
    events = events.withColumns({"top": F.element_at(F.split("host", r"\.", -1), -1),
                                 "salt": F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))}).drop("host")
    all_ = urls.unionByName(events, allowMissingColumns=True)
    sweep = (Window.partitionBy("top", "salt").orderBy("key", "kind", F.col("depth").desc())
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    slots = {f"{P}slot{d}": F.last(F.when(F.col("depth") == d, F.col("rules")), ignorenulls=True).over(sweep)
             for d in range(1, deepest + 1)}
    swept = all_.select("*", *[c.alias(n) for n, c in slots.items()]).where("kind = 2")
    stack = reduce(lambda a, b: F.concat(a, b), [F.coalesce(F.col(n), F.expr(f"cast(array() as {_RULES})")) for n in slots],
                   F.expr(f"cast(array() as {_RULES})"))
    # the last test repeats what the interval says, byte by byte
    fits = F.filter(stack, lambda r: F.col("path").startswith(r["path"]) & (
        (F.col("host") == r["host"]) | F.col("host").endswith(F.concat(F.lit("."), r["host"]))))
    best = F.array_max(F.transform(fits, lambda r: F.struct(
        (F.length(r["host"]) + F.length(r["path"])).alias("n"), F.length(r["host"]).alias("h"),
        F.concat(r["host"], r["path"]).alias("rule"), r["verdict"].alias("verdict"))))
    return swept.withColumn("best", best).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"))


ORACLE_SQL = r"""
WITH rules(verdict, rh, rp) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest FROM pages),
u AS (SELECT page_id,
        translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path FROM r),
m AS (SELECT page_id, u.host, u.path, rh || rp AS rule, verdict, row_number() OVER (
        PARTITION BY page_id ORDER BY length(rh || rp) DESC NULLS LAST) AS k
      FROM u LEFT JOIN rules ON (u.host = rh OR ends_with(u.host, '.' || rh)) AND starts_with(u.path, rp))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1"""
