"""Spelling variants against all pairs of words, the SQL, and groups that have to be cut again."""

import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from conftest_path import SMALL

from marquee.llm import spelling as S
from marquee.llm.catalog import ORACLE_SQL, QUERIES

COLS = ["word", "form", "root", "n", "n_near", "form_n"]


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(n):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        if vs:
            v = min(vs, key=lambda v: (-n[v], v))
            if n[v] >= 2 * n[w]:
                form[w] = v

    def root(w):
        return root(form[w]) if w in form else w
    return [(w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n]


def plain(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            n[w] += 1
    return variants({w: k for w, k in n.items() if len(w) >= 5 and k >= 3})


def key(rows):
    return sorted(map(repr, rows))


def frame(spark, words):
    return spark.createDataFrame(sorted(words.items()) or [], "w string, n long")


def test_random_words_and_chains(spark):
    rnd = random.Random(3)
    words = {}
    for _ in range(400):
        w = "".join(rnd.choice("abé") for _ in range(rnd.randrange(5, 9)))
        words[w] = rnd.randrange(3, 200)
    words |= {"x" * 5 + "y" * k + "z" * 40: 3 * 2 ** k for k in range(12)}  # a chain of forms, counts doubling
    words |= {"longword" * 2000: 3, "longword" * 2000 + "s": 9, "longword" * 1000 + "t" + "longword" * 1000: 5, "×" * 6: 4}
    got = [tuple(r[c] for c in COLS) for r in S.variants(frame(spark, words)).collect()]
    assert key(got) == key(variants(words))


@pytest.mark.parametrize("pairs", [1, 8, 10**9])
def test_hot_chunks_are_cut_again(spark, pairs):
    rnd = random.Random(5)
    words = {"commonprefix" + "".join(rnd.choice("abcdefgh") for _ in range(12)): 3 for _ in range(300)}
    words |= {w[:15] + "q" + w[15 + k % 2:]: 3 for k, w in enumerate(list(words)[:60])}
    words |= {"".join(rnd.choice("mn") for _ in range(6)) + "commonsuffix": 4 for _ in range(60)}
    words |= {"five" + c: 7 for c in "abcdefghij"} | {"five" + c + d: 7 for c in "abc" for d in "defg"}
    found = S.near_pairs(frame(spark, words), pairs).collect()
    got = sorted(tuple(sorted((r["a"], r["b"]))) for r in found)
    assert got == sorted((a, b) for a in words for b in words if a < b and one_edit(a, b))
    assert all(r["na"] == words[r["a"]] and r["nb"] == words[r["b"]] for r in found)


def odd_documents():
    return [(1, "Colour colour colour color Color COLOR colored"), (2, None), (3, ""), (None, "colours colours colours éclair Éclair éclairs"), (4, "a b c " * 50),
            (5, "colour " * 40), (6, "w" * 30_000 + " " + "w" * 30_000), (7, "w" * 30_000), (5, "colour " * 40), (8, "12345 ... ÷×÷×÷×÷ ×÷×÷×÷× naïve naïve naive"),
            (9, "naïve naive naive naïve"), *((k, f"sample{k % 7} samples sampled word́mark straße strasse") for k in range(20, 140))]


def test_odd_documents(spark):
    docs = odd_documents()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS w", "1 AS n", "2 AS key", "3 AS l", "'y' AS root")
    got = [tuple(r[c] for c in COLS) for r in S.spelling_variants(df).collect()]
    assert key(got) == key(plain(docs)) and len(got) > 8


@pytest.mark.parametrize("where", ["small", "odd", "empty"])
def test_matches_sql(spark, odd_dir, empty_dir, where):
    folder = {"odd": odd_dir, "small": SMALL, "empty": empty_dir}[where]
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{folder}/documents.parquet'")
    want = c.execute(ORACLE_SQL["op13_spelling_variants"]).fetchall()
    got = [tuple(r[c] for c in COLS) for r in QUERIES["op13_spelling_variants"](spark, folder).collect()]
    assert key(got) == key(want)
