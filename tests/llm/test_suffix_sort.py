"""The suffix sort against plain sorting, hash lies, and the way of hot anchors."""

import brute
import numpy as np
import pyarrow.parquet as pq

from marquee.llm import suffix_dedup as S


def test_orders_like_bytes():
    rng = np.random.default_rng(5)
    text = np.frombuffer(bytes(rng.choice(list(b"ab"), 3000)) + b"abc" * 400, np.uint8)
    s = S.Suffixes(text, 40)
    at = np.sort(rng.choice(len(text) - 40, 900, replace=False))
    seg = np.sort(rng.integers(0, 12, 900))
    order = s.sort(at, seg)
    key = [(seg[i], text[at[i]:at[i] + 40].tobytes(), i) for i in range(900)]
    assert [key[i][:2] for i in order] == sorted(k[:2] for k in key)
    words = [k[:2] for k in key]
    assert s.repeated(at, seg).tolist() == [words.count(w) > 1 for w in words]


def test_collisions_are_found(monkeypatch):
    text = np.frombuffer(b"x" * 50 + b"y" * 50 + b"x" * 50, np.uint8)
    s = S.Suffixes(text, 20)
    monkeypatch.setattr(s, "_same", lambda a, b, n: np.ones(len(a), bool))  # every hash lies
    at, seg = np.array([0, 55, 101, 60]), np.zeros(4, int)
    assert s.repeated(at, seg).tolist() == [True, True, True, True]
    at = np.array([0, 55])
    assert s.repeated(at, np.zeros(2, int)).tolist() == [False, False]


def test_long_texts_in_stretches():
    rng = np.random.default_rng(2)
    raw = bytes(rng.integers(97, 123, 5000, dtype=np.uint8))
    for h, first, n in [S._runs(np.frombuffer(raw, np.uint8))]:
        assert first[0] == 0 and n.sum() == len(raw) - S.LENGTH + 1
        grams = [S._mixed((p[S.GRAM:] - p[:-S.GRAM]) * S._INV[:len(p) - S.GRAM]) for p in [S._prefix(np.frombuffer(raw, np.uint8), S._POW)]][0]
        assert [grams[f + S._offset(raw[f:f + c + S.LENGTH - 1])] for f, c in zip(first, n)] == h.view(np.uint64).tolist()


def test_hot_anchors_and_short_stretches(spark, odd_dir, monkeypatch):
    from marquee.llm.catalog import QUERIES
    t = pq.read_table(f"{odd_dir}/documents.parquet", columns=["doc_id", "text"])
    docs = list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))
    monkeypatch.setattr(S, "BUCKET_RUNS", 1)      # every mixed anchor is hot
    monkeypatch.setattr(S, "BROADCAST_ROWS", 0)   # texts are shuffled
    got = [tuple(r) for r in QUERIES["op5_suffix_dedup"](spark, odd_dir).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute.op5(docs)))
