"""Classifiers: held-out accuracy on the small tables, defined results on odd rows."""

import duckdb
import numpy as np
import pytest

from marquee.llm import language_id, quality, toxicity
from marquee.llm.catalog import QUERIES

SF01 = "/root/testdata/sf0.01"


def auc(s, y):
    s, y = np.array(s, float), np.array(y)
    a, b = s[y == 1], s[y == 0]
    return np.mean([(x > b).mean() + (x == b).mean() / 2 for x in a])


def test_quality_held_out(spark):
    got = {r["doc_id"]: r for r in QUERIES["op4_quality"](spark, SF01).collect()}
    rows = duckdb.sql(f"select doc_id, quality from '{SF01}/labels.parquet'").fetchall()
    held = [(got[i]["score"], q) for i, q in rows if got[i]["held_out"]]
    assert auc(*zip(*held)) > 0.95


def test_language_held_out(spark):
    got = {r["doc_id"]: r for r in QUERIES["op8_language_id"](spark, SF01).collect()}
    rows = duckdb.sql(f"select doc_id, lang from '{SF01}/documents.parquet' where lang is not null").fetchall()
    held = [got[i]["lang_pred"] == lang for i, lang in rows if got[i]["held_out"]]
    assert np.mean(held) > 0.95


def test_toxicity_held_out(spark):
    got = {r["doc_id"]: r for r in QUERIES["op6_toxicity"](spark, SF01).collect()}
    rows = duckdb.sql(f"select doc_id, toxic from '{SF01}/labels.parquet'").fetchall()
    held = [(got[i]["score"], q) for i, q in rows if got[i]["held_out"]]
    assert auc(*zip(*held)) > 0.8  # some 40 toxic rows to learn from


@pytest.mark.parametrize("name,mod,held", [("op4_quality", 3, 1), ("op6_toxicity", 4, 2), ("op8_language_id", 3, 1)])
def test_odd_and_empty(spark, odd_dir, empty_dir, name, mod, held):
    import zlib
    rows = QUERIES[name](spark, odd_dir).collect()
    ids = [r[0] for r in duckdb.sql(f"select doc_id from '{odd_dir}/documents.parquet'").fetchall()]
    assert sorted(map(str, ids)) == sorted(str(r["doc_id"]) for r in rows)
    for r in rows:
        assert 0 <= r["score"] <= 1
        assert r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % mod == held)
        if name == "op8_language_id":
            assert r["lang_pred"] in ("en", "de", "und")
            if r["doc_id"] in (100, 101, 102, 139):
                assert r["lang_pred"] == "und"
    assert QUERIES[name](spark, empty_dir).collect() == []


def test_filters_return_false_positives_only():
    """Every n-gram put in is found; the correction removes what filled slots add."""
    m = language_id.Model(["a", "b"], "a")
    for bit, words in ((1, ["hello", "world"]), (2, ["bonjour", "monde"])):
        for w in words:
            for g in language_id.grams(w):
                for s in language_id.slots(g):
                    m.table[s] |= bit
    j = language_id.Judge(m)
    assert j("hello world")[0] == "a" and j("Bonjour MONDE!")[0] == "b"
    assert j("12 ... 　") == ("und", 0.0) and j(None) == ("und", 0.0)
    assert j("zzzz") == ("a", 0.0)


def test_dual_coordinate_descent_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 5))
    y = np.where(x[:, 0] - 0.5 * x[:, 1] > 0.1, 1.0, -1.0)
    at = [np.arange(5)] * 200
    w, b = quality.dual_coordinate_descent(at, list(x), y, np.full(200, 10.0), 5, epochs=200)
    assert np.mean(np.sign(x @ w + b) == y) > 0.97


def test_windows_cover_long_words():
    assert b"".join(toxicity.in_order("x" * 100)) == b"x" * 100
    assert toxicity.windows(None) == set()


@pytest.mark.parametrize("size", [toxicity.TOXIC_BYTES, toxicity.ORDINARY_BYTES])
@pytest.mark.parametrize("start", ["", "abc"])
def test_whole_dictionary_is_searched(size, start):
    rng = np.random.default_rng(1)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    words = sorted({(start + "".join(rng.choice(letters, 8 - len(start)))).encode() for _ in range(size // 18)})
    kept = toxicity.Lengths(toxicity._packed(words, size), b"")
    length = lambda ws: np.mean([kept.cell(w) >> 4 & 255 for w in ws])
    first, middle, last = length(words[-300:]), length(words[len(words) // 2:][:300]), length(words[:300])
    unknown = length([w[:3] + w[:2:-1] for w in words[::20]])
    assert max(first, middle) < last + 1.5 < unknown


def _toxic_model(spark, toxic, plain):
    rows = [(i, t, int(i % 2 == 0)) for i, t in enumerate(x for p in zip(toxic, plain) for x in p)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    more = lambda t: {r["doc_id"]: r["score"] for r in toxicity.scored(spark.createDataFrame(t, "doc_id long, text string"), model).collect()}
    return model, more


def _sentences(n, seed):
    rng = np.random.default_rng(seed)
    return [" ".join(f"w{k}" for k in rng.integers(0, 200, 30)) for _ in range(n)]


def test_toxic_word_in_one_fixed_phrase(spark):
    """Documents are counted, not neighbours; copies of a text count once."""
    a, b = _sentences(300, 1), _sentences(300, 2)
    model, score = _toxic_model(spark, [t + " you utter zorgblat person now" for t in a], [t + " you utter kind person now" for t in b])
    assert b" zorgblat zorgblat " in model.toxic
    got = score([(1, b[0] + " zorgblat"), (2, b[0])])
    assert got[1] >= toxicity.THRESHOLD > got[2]
    model, _ = _toxic_model(spark, [a[0] + " zorgblat"] * 100 + [t + " mumfrip" for t in a[:100]], b[:200])
    assert b"zorgblat" not in model.toxic and b"mumfrip" in model.toxic


def test_toxic_phrase_of_ordinary_words(spark):
    a, b = _sentences(400, 3), _sentences(400, 4)
    model, score = _toxic_model(spark, [t + " w7 drop dead now w9" for t in a], [t + " drop w1 dead w2 now w3" for t in b])
    assert any(b"drop dead" in p for p in model.passages)
    got = score([(1, b[0] + " w3 drop dead w5"), (2, b[0] + " drop w3 dead w5")])
    assert got[1] >= toxicity.THRESHOLD > got[2]


def test_toxic_string_across_cuts(spark):
    """In text without spaces a toxic string counts wherever it stands."""
    rng = np.random.default_rng(5)
    line = lambda: "".join(chr(0x4E00 + k) for k in rng.integers(0, 300, 40))
    at = lambda t, k: t[:k] + "\u8822\u8823\u8824\u8825" + t[k:]
    model, score = _toxic_model(spark, [at(line(), int(rng.integers(1, 39))) for _ in range(400)], [line() for _ in range(400)])
    t = line()
    got = score([(k, at(t, k)) for k in range(1, 39)] + [(100, t)])
    assert all(got[k] >= toxicity.THRESHOLD > got[100] for k in range(1, 39))
    assert b"a" * 8 + b"bc" + b"d" * 8 in b" ".join(toxicity.windows("x" * 22 + "a" * 8 + "bc" + "d" * 8 + "y" * 24))


def test_long_tokens_are_read_to_the_end():
    """Text without white space: every character counts, the features before a difference stay the same."""
    f = quality.Features()
    a, b = "\u4e00\u4e01" * 60 + "\u5b57\u5178\u8a9e\u8a5e" + "\u3002", "\u4e00\u4e01" * 60 + "\u4eba\u540d\u6f22\u6587" + "\u3002"
    assert len(set(f(a)) - set(f(b))) >= 5 and len(set(f(a)) & set(f(b))) >= 2
    c = "\u8336\u9053" * 90 + "\u5b57\u5178\u8a9e\u8a5e"
    assert quality._hashed("c \u5b57\u5178\u8a9e\u8a5e") in set(f(a)) & set(f(c))
    assert quality.shape("x" * 300) != quality.shape("7" * 300) and quality.shape("(" * 150 + "ab" + "!" * 150) == "(((l0!!!"
    assert f("short words") == quality.Features()("short words")


def test_more_languages_than_bits(spark):
    names = [f"l{k:03d}" for k in range(130)]
    word = lambda k, j: "".join(chr(97 + (k * 7919 + j * 104729) // 26 ** i % 26) for i in range(5)) + chr(97 + k % 26) + chr(97 + k // 26)
    docs = spark.createDataFrame([(9 * k + c, " ".join(word(k, j) for j in range(8)), n) for k, n in enumerate(names) for c in range(9)],
                                 "doc_id long, text string, lang string")
    model = language_id.train(docs)
    assert model.languages == names and len(model.rates()) == 130
    got = language_id.predicted(docs, model).select("lang", "lang_pred").collect()
    assert [r for r in got if r["lang"] != r["lang_pred"]] == []


def test_cells_are_direct_compression(spark):
    """Scores against a plain loop: every window of every text compressed with both dictionaries."""
    a, b = _sentences(300, 5), _sentences(300, 6)
    model, score = _toxic_model(spark, [t + " zorgblat you drop dead now" for t in a], [t + " drop w1 dead you now" for t in b])
    lengths, passages = toxicity.Lengths(model.toxic, model.ordinary), set(model.passages)

    def length(w, words):
        import zstandard as zs
        d = zs.ZstdCompressionDict(toxicity.CARRIER + words, dict_type=zs.DICT_TYPE_RAWCONTENT)
        line = toxicity.CARRIER + b" " + w + b" " + w + b" "
        return len(zs.ZstdCompressor(dict_data=d, compression_params=toxicity._COMPRESS).compress(line))
    texts = [(1, a[7] + " zorgblat drop dead w3"), (2, b[3]), (3, "drop dead"), (4, ""), (5, None), (6, "zorgblatt w1 w2")]
    got = score(texts)
    for i, t in texts:
        ws = [w.encode() for w in (t or "").split()]
        wins = {b" ".join(ws[k:k + n]) for n in (1, 2, 3) for k in range(len(ws) - n + 1)}
        wins = {w for w in wins if w and (b" " not in w or w in passages)}
        cells = [w.count(b" ") << 24 | length(w, model.ordinary) << 14 | length(w, model.toxic) << 4 | min(len(w), 15) for w in wins]
        assert sorted(cells) == sorted(map(lengths.worked_out, wins))
        best = sorted((model.cells.get(c, 0.0) for c in cells), reverse=True)[:toxicity.TOP]
        raw = round(sum(best), 2) if wins else -10.0
        assert abs(got[i] - 1 / (1 + np.exp(-(raw - model.threshold + np.log(0.3 / 0.7))))) < 1e-9
    assert got[1] >= toxicity.THRESHOLD > got[2]


def test_passages_are_taken_in_blocks(spark, monkeypatch):
    """Small blocks find the passages that one block finds; what tasks remember does not decide."""
    a, b = _sentences(200, 8), _sentences(200, 9)
    rows = [(t + f" drop dead now p{k % 5} q{k % 5} w1", 1) for k, t in enumerate(a)] + [(t + " so it goes on w2 dead w3 drop now", 0) for t in b]
    made = spark.createDataFrame(rows, "text string, y int")
    want = toxicity._chosen_passages(made, frozenset(), 200, 200)
    assert b"drop dead" in want[0] and b"so it" in want[1] and not set(want[0]) & set(want[1])
    n = {w: sum(f" {w.decode()} " in f" {t} " for t in (r[0] for r in rows if r[1] == 0)) for w in want[1]}
    assert [n[w] for w in want[1]] == sorted(n.values(), reverse=True)
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    assert toxicity._chosen_passages(made, frozenset(), 200, 200)[0] == want[0]


def test_misra_gries_keeps_what_is_frequent():
    from collections import Counter
    counts = Counter({f"w{i}": 1 for i in range(500)}) + Counter({"often": 90, "more": 200})
    left = toxicity._trimmed(counts, 10)
    assert set(left) == {"often", "more"} and left["more"] == 199


def test_only_letters_tell_a_language(spark):
    """Every character with a letter's category is one, and no other: number signs alone are no language."""
    import unicodedata
    wrong = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000
             and bool(language_id._LETTERS.fullmatch(chr(c))) != unicodedata.category(chr(c)).startswith("L")]
    assert wrong == []
    docs = spark.createDataFrame([(i, t, "xx") for i, t in enumerate(["some words here"] * 20)], "doc_id long, text string, lang string")
    model = language_id.train(docs)
    odd = spark.createDataFrame([(1, "½ ²"), (2, "①"), (3, "Ⅷ"), (4, "12 _ !"), (5, "some words")], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.predicted(odd, model).collect()}
    assert got == {1: "und", 2: "und", 3: "und", 4: "und", 5: "xx"}


def test_the_set_of_number_signs_is_matched_only_where_one_stands(monkeypatch):
    """Words of letters, digits and other signs never meet the slow set; a word with a number sign gives what the set gives."""
    class Slow:
        met = []

        def findall(self, word):
            self.met.append(word)
            return slow.findall(word)
    slow = language_id._LETTERS
    monkeypatch.setattr(language_id, "_LETTERS", Slow())
    assert language_id.grams("don't") == [" don", "don ", " t "] and language_id.grams("жук9漢字_") == [" жук", "жук ", " 漢字 "]
    assert language_id.grams("12") == [] and Slow.met == []
    assert language_id.grams("ab½cd") == [" ab ", " cd "] and Slow.met == ["ab½cd"]
