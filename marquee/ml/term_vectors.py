"""Term counts of token arrays as sparse vectors, for a given vocabulary.

The tokens come from native expressions; an Arrow function turns a batch of
token arrays into (row, term) counts with numpy: every distinct word of a stretch is looked up once,
pairs of words are matched by numbers, and n-grams outside the vocabulary are never made into strings
of a row. What a task holds is bounded by a stretch of tokens and a bounded memory of words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tokens that are counted at a time, and words whose n-grams a task remembers.
STRETCH, REMEMBERED = 100_000, 50_000


def char_grams(word: str, n_min: int, n_max: int) -> list[str]:
    """``char_wb`` n-grams of one lower-cased word, like ``text.char_wb_ngrams``."""
    p = f" {word} "
    return [p[i:i + n] for n in range(n_min, n_max + 1) if n == n_min or n <= len(p) for i in range(max(len(p) - n, 0) + 1)]


class _Chars:
    """Vocabulary entries of the character n-grams of words."""

    def __init__(self, terms: list[str], n_min: int, n_max: int):
        self.at, self.n_min, self.n_max = {t: i for i, t in enumerate(terms)}, n_min, n_max
        self.known: dict[str, np.ndarray] = {}

    def _of(self, word: str) -> np.ndarray:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = np.array([self.at[g] for g in char_grams(word, self.n_min, self.n_max) if g in self.at], np.int64)
            self.known[word] = found
        return found

    def hits(self, row: np.ndarray, code: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(row, term) of every occurrence of a term."""
        each = [self._of(w) for w in words]
        size = np.array([len(e) for e in each], np.int64)
        flat = np.concatenate(each) if each else np.zeros(0, np.int64)
        start, n = np.cumsum(size) - size, size[code]
        ends = np.cumsum(n)
        take = np.arange(ends[-1] if ends.size else 0) - np.repeat(ends - n, n) + np.repeat(start[code], n)
        return np.repeat(row, n), flat[take]


class _Words:
    """Vocabulary entries of words and word n-grams; words hold no space."""

    def __init__(self, terms: list[str], n_max: int):
        self.at = {t: i for i, t in enumerate(terms) if " " not in t}
        self.n_max, pairs = n_max, [(t.split(" "), i) for i, t in enumerate(terms) if t.count(" ") == 1]
        self.part = {w: i for i, w in enumerate(sorted({w for ws, _ in pairs for w in ws}))}
        key = np.array([self.part[a] * len(self.part) + self.part[b] for (a, b), _ in pairs], np.int64)
        order = np.argsort(key)
        self.key, self.pair = key[order], np.array([i for _, i in pairs], np.int64)[order]
        self.long = {t: i for i, t in enumerate(terms) if t.count(" ") > 1}

    def hits(self, row: np.ndarray, code: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        one = np.array([self.at.get(w, -1) for w in words], np.int64)[code]
        rows, terms = [row[one >= 0]], [one[one >= 0]]
        if self.n_max > 1 and self.key.size and row.size > 1:
            part = np.array([self.part.get(w, -1) for w in words], np.int64)[code]
            both = np.flatnonzero((row[1:] == row[:-1]) & (part[1:] >= 0) & (part[:-1] >= 0))
            key = part[both] * len(self.part) + part[both + 1]
            place = np.minimum(np.searchsorted(self.key, key), self.key.size - 1)
            hit = self.key[place] == key
            rows.append(row[both[hit]])
            terms.append(self.pair[place[hit]])
        for n in range(3, self.n_max + 1):
            if self.long:
                for i in np.flatnonzero(row[n - 1:] == row[:1 - n]):
                    t = self.long.get(" ".join(words[c] for c in code[i:i + n]))
                    if t is not None:
                        rows.append(row[i:i + 1])
                        terms.append(np.array([t], np.int64))
        return np.concatenate(rows), np.concatenate(terms)


def _vectors(tokens: pa.Array, lookup, size: int, sublinear: bool) -> pa.Array:
    lens = np.asarray(pc.fill_null(pc.list_value_length(tokens), 0), np.int64)
    flat = tokens.flatten().dictionary_encode()
    code, words = np.asarray(flat.indices, np.int64), flat.dictionary.to_pylist()
    ends = np.cumsum(lens)
    counts, index, value = [], [], []
    a = 0
    while a < lens.size:
        # whole rows of about STRETCH tokens, one row at least
        b = max(a + 1, int(np.searchsorted(ends, ends[a] - lens[a] + STRETCH, "right")))
        here = code[ends[a] - lens[a]:ends[b - 1]]
        used, place = np.unique(here, return_inverse=True)
        row, term = lookup.hits(np.repeat(np.arange(b - a), lens[a:b]), place, [words[c] for c in used])
        key, n = np.unique(row * size + term, return_counts=True)
        counts.append(np.bincount(key // size, minlength=b - a))
        index.append((key % size).astype(np.int32))
        value.append(1.0 + np.log(n) if sublinear else n.astype(np.float64))
        a = b
    offsets = np.concatenate([[0], *counts]).cumsum().astype(np.int32)
    index, value = np.concatenate([np.zeros(0, np.int32), *index]), np.concatenate([np.zeros(0), *value])
    n = lens.size
    return pa.StructArray.from_arrays(
        [pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, size, np.int32)), pa.ListArray.from_arrays(offsets, index),
         pa.ListArray.from_arrays(offsets, value)], names=["type", "size", "indices", "values"])


class TermCounts(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Token array -> sparse counts over ``vocabulary`` (1 + ln of them if ``sublinear``).

    ``nMin`` 0: words and word n-grams up to ``nMax``; else character n-grams inside the words."""
    vocabulary = Param(Params._dummy(), "vocabulary", "terms by place", TypeConverters.toListString)
    nMin = Param(Params._dummy(), "nMin", "smallest n of character n-grams, 0 for words", TypeConverters.toInt)
    nMax = Param(Params._dummy(), "nMax", "largest n", TypeConverters.toInt)
    sublinear = Param(Params._dummy(), "sublinear", "1 + ln(tf)", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, vocabulary=None, nMin=0, nMax=1, sublinear=False, inputCol=None, outputCol=None):
        super().__init__()
        self._setDefault(nMin=0, nMax=1, sublinear=False)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        terms, n_min, n_max = self.getOrDefault("vocabulary"), self.getOrDefault("nMin"), self.getOrDefault("nMax")
        sublinear, size, made = self.getOrDefault("sublinear"), len(terms), []

        def count(tokens: pa.Array) -> pa.Array:
            if not made:                                  # once in a task
                made.append(_Chars(terms, n_min, n_max) if n_min else _Words(terms, n_max))
            return _vectors(tokens, made[0], size, sublinear)
        return df.withColumn(self.getOutputCol(), F.arrow_udf(count, VectorUDT())(F.col(self.getInputCol())))
