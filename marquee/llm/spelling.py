"""Spelling variant grouping with asymmetric q-chunks.

Words are counted over all documents; two words are near if one inserted,
deleted or replaced character turns one into the other. The near pairs are found
by a join: the shorter word of a pair (either one, if they are equally long)
gives its two halves as disjoint chunks, the longer one the grams that stand
where such a chunk can stand within a shift of one: at the same place if the edit is
behind the chunk, one further on if it is before it. One edit touches one
chunk at most, so every near pair shares (length, chunk, gram); a comparison of
the words verifies.

A frequent chunk brings many words together that are not near. Groups are counted
before they are joined; where a group would make more than ``PAIRS`` candidates
for each of its rows, both sides take the rest of the word (the part
that has the edit) as two chunks again, under the chunk they share.
This is the same step on a shorter word, so nothing is lost; it ends with groups
whose members differ in one place. No group is dropped, capped or collected.

A word's form is its near word with the largest count, if that is twice its own
at least; forms are followed to the last one by pointer doubling (counts double
at every step, so chains are short).

Defined cases: a null text has no words; a null id counts as empty text in the
damage key; repeated documents count each time; ties take the smaller word in
code-point order; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import P, materialised, ready, salted_lookup

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fewest characters and occurrences of a word.
CHARS, TIMES = 5, 3
#: One run in so many loses a character.
DAMAGE = 97
#: A group of chunks and grams is joined if it makes at most so many pairs for each of its rows.
PAIRS = 8


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, w): every run of letters of every whole text, A-Z lower-cased, with the id as text."""
    found = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(RUN), F.lit(0))
    words = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"), F.explode(found).alias("w"))
    return words.select("key", F.translate("w", UPPER, LOWER).alias("w"))


def damaged(words: DataFrame, mod: int = DAMAGE) -> DataFrame:
    """One run in ``mod`` (by the crc32 of ``id:run``) without one of its characters."""
    h = F.crc32(F.concat("key", F.lit(":"), F.col("w")).cast("binary"))
    gone = (F.col(f"{P}h") % F.length("w")).cast("int")
    cut = F.concat(F.expr(f"substring(w, 1, cast({P}h % length(w) as int))"), F.col("w").substr(gone + 2, F.length("w")))
    return words.withColumn(f"{P}h", h).select(F.when(F.col(f"{P}h") % mod == 0, cut).otherwise(F.col("w")).alias("w"))


def counted(words: DataFrame, chars: int = CHARS, times: int = TIMES) -> DataFrame:
    """(w, n) of the words that are long and frequent enough; short runs never leave their task."""
    return (words.where(F.length("w") >= chars).groupBy("w").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= times))


# --- the join ------------------------------------------------------------------------


def _halves(rows: DataFrame) -> DataFrame:
    """Each row under either chunk of the part that has the edit.

    ``l`` is the length of the shorter word; ``a`` characters before and ``b``
    behind the part are known to be equal on both sides, and depend on ``l`` and
    the chunks taken only, so both sides cut alike.
    """
    first = F.expr("(l - a - b + 1) div 2")
    # a part of one character against two: the character stays, before (1) or behind (3) the new one
    rows = rows.withColumn("half", F.explode(F.expr(
        "CASE l - a - b WHEN 0 THEN array(1) WHEN 1 THEN array(1, 3) ELSE array(1, 2) END")))
    last = F.expr("l - a - b")
    return rows.select(
        "w", "n", "l", "more", (F.col("a") + F.when(F.col("half") == 1, first).otherwise(0)).cast("int").alias("a"),
        (F.col("b") + F.when(F.col("half") == 2, last - first).when(F.col("half") == 3, last).otherwise(0)).cast("int").alias("b"))


def _keyed(rows: DataFrame) -> DataFrame:
    """With what both sides of a near pair have in common: lengths, places and the equal characters."""
    pre, post = F.expr("substring(w, 1, a)"), F.expr("CASE WHEN b = 0 THEN '' ELSE substring(w, length(w) - b + 1, b) END")
    # the digest keeps long words out of the key; words are compared afterwards
    return rows.withColumn("key", F.xxhash64("l", "more", "a", "b", pre, post))


def near(a: Column, b: Column) -> Column:
    """Exactly one inserted, deleted or replaced character."""
    return F.levenshtein(a, b, 1) == 1


def near_pairs(words: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """(a, na, b, nb) of all near words of (w, n), each pair once; ``b`` is longer or behind."""
    size = F.length("w")
    zero = F.lit(0)
    whole = words.select("w", "n", size.alias("l"), zero.alias("a"), zero.alias("b"))
    # chunks of the shorter word: once for partners as long, once for partners with one more
    chunks = whole.withColumn("more", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("side", F.lit(0))
    # grams of the longer word: as the partner of words as long, and of words with one less
    grams = whole.withColumn("more", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("l", F.col("l") - F.col("more")).withColumn("side", F.lit(1))
    out = None
    rows = chunks.unionByName(grams)
    while True:
        split = _halves(rows.where("side = 0")).withColumn("side", F.lit(0)).unionByName(_halves(rows.where("side = 1")).withColumn("side", F.lit(1)))
        keyed = materialised(_keyed(split.where("more = 1 OR l - a - b > 0")))
        groups = keyed.groupBy("key").agg(F.sum(1 - F.col("side")).alias("c"), F.sum("side").alias("g"), F.max(F.expr("l - a - b")).alias("open"),
                                          F.max("more").alias("m"))
        groups = groups.where("c > 0 AND g > 0 AND (m = 1 OR g > 1)")
        # a group whose members differ in one place only makes pairs that are near
        fine = (F.col("c") * F.col("g") <= pairs * (F.col("c") + F.col("g"))) | (F.col("open") <= 1 - F.col("m"))
        groups = materialised(groups.select("key", fine.alias("fine")))
        found = salted_lookup(keyed, groups, ["key"], "w")
        found = materialised(found)
        ready_ = found.where("fine").drop("fine")
        chunk = ready_.where("side = 0").select("key", "more", F.col("w").alias("a_"), F.col("n").alias("na"))
        gram = ready_.where("side = 1").select("key", "more", F.col("w").alias("b_"), F.col("n").alias("nb"))
        both = chunk.join(gram, ["key", "more"])
        one_way = F.when(F.col("more") == 0, (F.length("a_") == F.length("b_")) & (F.col("a_") < F.col("b_"))).otherwise(
            F.length("a_") + 1 == F.length("b_"))
        hits = materialised(both.where(one_way & near(F.col("a_"), F.col("b_")))
                            .select(F.col("a_").alias("a"), "na", F.col("b_").alias("b"), "nb").distinct())
        out = hits if out is None else out.unionByName(hits)
        rows = found.where("NOT fine").drop("fine", "key")
        if rows.isEmpty():
            return out.distinct()


# --- forms and roots ---------------------------------------------------------------------


def variants(words: DataFrame, times: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (w, n)."""
    words = materialised(words)
    pairs = near_pairs(words)
    both = pairs.select(F.col("a").alias("w"), F.col("b").alias("v"), F.col("nb").alias("nv")).unionByName(
        pairs.select(F.col("b").alias("w"), F.col("a").alias("v"), F.col("na").alias("nv")))
    best = both.groupBy("w").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("nv")).alias("k"), F.col("v").alias("v"))).alias("best"))
    rows = words.join(best, "w", "left")
    strong = -F.col("best.k") >= times * F.col("n")
    rows = materialised(rows.select(
        "w", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(strong, F.col("best.v")).alias("form"),
        F.when(strong, -F.col("best.k")).alias("form_n")))
    ends = _roots(rows.where("form is not null").select("w", F.col("form").alias("root")))
    rows = rows.join(ends.select("w", "root"), "w", "left")
    return rows.select(F.col("w").alias("word"), "form", F.coalesce("root", "w").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """Pointer doubling: (w, root) with every root replaced by its own root until none has one."""
    links = materialised(links)
    while True:
        up = links.select(F.col("w").alias("root"), F.col("root").alias("up"))
        step = salted_lookup(links, up, ["root"], "w").select("w", F.col("up").alias("root"))
        step = materialised(step)
        if step.isEmpty():
            return links
        links = materialised(links.join(step.select("w"), "w", "left_anti").unionByName(step))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract: damaged runs of whole documents, their words, forms and roots."""
    ready(docs.sparkSession)
    return variants(counted(damaged(runs(docs, id_col, text_col))))


ORACLE_SQL = r"""
WITH RECURSIVE
tab AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
        FROM range(256) g(i)),
run AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
said AS (SELECT doc_id, w, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) AS x FROM run GROUP BY ALL),
crc AS (SELECT w, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT)),
                                     lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM said, tab),
hurt AS (SELECT n, CASE WHEN h % 97 = 0 THEN left(w, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS w FROM crc),
word AS (SELECT w, sum(n)::BIGINT AS n FROM hurt WHERE length(w) >= 5 GROUP BY w HAVING sum(n) >= 3),
cut AS (SELECT w, n, i, left(w, i - 1) || substr(w, i + 1) AS d FROM (SELECT w, n, unnest(range(1, length(w) + 1))::INT AS i FROM word)),
pair AS (SELECT a.w AS a, a.n AS na, b.w AS b, b.n AS nb FROM cut a JOIN cut b ON a.d = b.d AND a.i = b.i AND a.w < b.w
         UNION SELECT a.w, a.n, b.w, b.n FROM word a JOIN cut b ON b.d = a.w),
both_ways AS (SELECT a AS w, b AS v, nb AS nv FROM pair UNION ALL SELECT b, a, na FROM pair),
best AS (SELECT w, count(*) AS n_near, min({'k': -nv, 'v': v}) AS best FROM both_ways GROUP BY w),
form AS (SELECT word.w, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.k >= 2 * n THEN best.v END AS form,
                CASE WHEN -best.k >= 2 * n THEN -best.k END AS form_n FROM word LEFT JOIN best USING (w)),
chain AS (SELECT w, w AS at FROM form UNION ALL SELECT c.w, f.form FROM chain c JOIN form f ON f.w = c.at WHERE f.form IS NOT NULL),
ends AS (SELECT c.w, c.at AS root FROM chain c JOIN form f ON f.w = c.at WHERE f.form IS NULL)
SELECT w AS word, form, root, n, n_near, form_n FROM form JOIN ends USING (w)"""
