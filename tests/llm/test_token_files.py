"""Directly addressable codes: random access, files, and datasets against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest_path import SMALL
from tokenizers import Tokenizer

from marquee.llm import token_files as T
from marquee.llm.catalog import QUERIES

WORDS = public_tokenizers.path("word_bpe_49k.json")


def spec(path=WORDS):
    with open(path, encoding="utf-8") as f:
        return f.read()


def reader(data, log=None):
    def read(at, n):
        if log is not None:
            log.append(n)
        return data[at:at + n]
    return T.Reader(read)


@pytest.mark.parametrize("top", [1, 2, 200, 49408, 2**31, 2**32])
def test_any_id_of_a_file(top):
    rnd = np.random.default_rng(top)
    ids = (rnd.random(5000) ** 6 * top).astype(np.uint32)
    data = T.encoded_file(ids, [None, 7], [0, 2000, 5000])
    dac = reader(data)
    assert dac.documents()[0] == [None, 7] and dac.documents()[1].tolist() == [0, 2000, 5000]
    assert np.array_equal(dac.ids(0, 5000), ids)
    for i in rnd.integers(0, 5000, 200):
        assert dac.id(int(i)) == ids[i]
    for _ in range(100):
        a, b = sorted(rnd.integers(0, 5001, 2).tolist())
        assert np.array_equal(dac.ids(a, b), ids[a:b])
    with pytest.raises(IndexError):
        dac.id(5000)


def test_no_ids_and_one_level():
    assert reader(T.encoded_file(np.zeros(0, np.uint32), [1, 2], [0, 0, 0])).ids(0, 0).tolist() == []
    data = T.encoded_file(np.zeros(9, np.uint32), [1], [0, 9])
    assert reader(data).ids(2, 9).tolist() == [0] * 7 and [x[0] for x in reader(data).levels] == [1]


def test_an_id_costs_a_few_bytes_wherever_it_is():
    ids = (np.random.default_rng(1).random(1_000_000) ** 4 * 49408).astype(np.uint32)
    data, log = T.encoded_file(ids, [1], [0, len(ids)]), []
    assert len(data) < 2.2 * len(ids)
    dac = reader(data, log)
    log.clear()
    assert dac.id(765_432) == ids[765_432]
    assert sum(log) < 4 * (T.STRIDE // 8 + 16)  # no block is decoded


def test_widths_are_the_cheapest():
    rnd = random.Random(2)
    for _ in range(20):
        ids = np.array([rnd.randrange(1 << rnd.randrange(1, 9)) for _ in range(60)], np.uint32)
        need = [max(1, int(i).bit_length()) for i in ids]

        def cost(cut):
            total, at = 0, 0
            for k, w in enumerate(cut):
                n = sum(b > at for b in need)
                total, at = total + n * (w + (k + 1 < len(cut)) * (1 + 64 / T.STRIDE)), at + w
            return total

        def cuts(top, parts):
            if parts == 1:
                yield (top,)
            for first in range(1, top):
                if parts > 1:
                    yield from ((first, *rest) for rest in cuts(top - first, parts - 1))
        top = max(need)
        assert cost(T.widths(ids)) == min(cost(c) for p in range(1, T.LEVELS + 1) for c in cuts(top, p))


def odd_texts():
    rnd = random.Random(8)
    chars = ("ab Zé́\n\t\x1c 　'.,!?0９½ǅİßſKÅ한국語العربية🙂﻿‍<|>ͅΣσς\x85 " + "'s don't we'LL ")
    texts = ["".join(rnd.choice(chars) for _ in range(rnd.randrange(60))) for _ in range(3000)]
    texts += ["<|endoftext|>", "a<|startoftext|>b <|endoftext|> c", "word" * 5000, "É É. É, É!? é́. ẹ́ Å x́", "ª º µ ÷ × ÿ Ÿ ß ẞ", " ", "\n", "",
              "naïve, STRASSE; Straße: über? Ça! Øre... Þorn ð.", "I'll you're 'tis rock'n'roll's", "́ ́a ́", "a b\x0bc\x0cd\re\x1ff"]
    return texts + [chr(c) + "x" + chr(c) + " " + chr(c) + "." for c in range(1, 0x3000, 7)]


def test_words_on_their_own_are_whole_texts():
    enc, lib = T.Encoder(spec()), Tokenizer.from_file(WORDS)
    assert enc.by_word
    for t in odd_texts() * 2:
        assert np.frombuffer(enc.text(t), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_other_tokenizers_take_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    enc, lib = T.Encoder(spec(path)), Tokenizer.from_file(path)
    assert not enc.by_word
    for t in odd_texts()[:300]:
        assert np.frombuffer(enc.text(t), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids


def plain(rows):
    lib, start, out = Tokenizer.from_file(WORDS), 0, []
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_dataset_of_many_files(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(odd_texts()[:400])] + [(None, "no id"), (401, None), (402, "far " * 20_000)]
    mixed = random.Random(1).sample(rows, len(rows))
    df = spark.createDataFrame(mixed, "doc_id long, text string").selectExpr("*", "1 AS start", "'x' AS ids")
    folder = T.write_tokens(df.repartition(5), WORDS, str(tmp_path / "set"), 2, file_ids=500)
    want = plain([rows[400], *rows[:400], *rows[401:]])
    got = T.read_tokens(spark, folder, ("doc_id", "start", "n_tokens", "ids_crc32")).orderBy("start").collect()
    assert [tuple(r) for r in got] == want
    assert spark.read.parquet(f"{folder}/index").count() > 8
    flat = [i for r in T.read_tokens(spark, folder).orderBy("start").collect() for i in r["ids"]]
    places = [0, 1, len(flat) // 2, len(flat) - 1]
    assert T.tokens_at(spark, folder, places) == [flat[p] for p in places]


@pytest.mark.parametrize("where", ["small", "odd", "empty"])
def test_query(spark, odd_dir, empty_dir, where):
    import pyarrow.parquet as pq
    folder = {"odd": odd_dir, "small": SMALL, "empty": empty_dir}[where]
    t = pq.read_table(f"{folder}/documents.parquet").select(["doc_id", "text"]).to_pylist()
    got = [tuple(r) for r in QUERIES["op11_token_files"](spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    ids = sorted((x[0] is not None, x[0] or 0) for x in got)
    assert ids == sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in t)
    # ties of one id: any order that is ascending; starts follow from it
    got.sort(key=lambda r: r[1])
    assert [g[0] or -1 for g in got] == sorted(g[0] or -1 for g in got)
    at = 0
    for _, start, n, _ in got:
        assert start == at
        at += n
    want = plain([(r["doc_id"], r["text"]) for r in t])
    assert sorted((repr(i), n, c) for i, _, n, c in got) == sorted((repr(i), n, c) for i, _, n, c in want)
    assert len(t) != len(set(r["doc_id"] for r in t)) or sorted(got, key=repr) == sorted(plain(sorted(((r["doc_id"], r["text"]) for r in t))), key=repr)
