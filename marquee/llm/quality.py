"""Quality classifier: naive Bayes support vectors.

Features are indicators of n-grams, hashed into ``SIZE`` slots: words, in words
over ``TOKEN_CHARS`` characters (text without white space) also the strings of
``PIECE`` characters from every character on, and runs of one to three token shapes (letter case, length class, marks around
the word, and whether the word repeats the one before), so that learned
habits carry over to unseen words.

1. Over all labelled rows outside the held-out part, Spark counts in how many
   documents of each class a feature occurs. The log-ratio of the smoothed,
   normalised counts scales the feature's indicator; rows are brought to
   length one.
2. A linear hinge-loss model is fitted to the scaled rows by dual coordinate
   descent, on a hash sample of about ``SAMPLE`` rows (all rows, if fewer).
   A fifth of the sample is kept out of the fit to turn margins into
   probabilities.

Only per-feature counts and the bounded sample leave the executors. Scoring
reads whole texts and needs no shuffle.

Defined cases: null and empty texts have only the feature of the empty text;
null labels are ignored, of several labels of one document the largest
counts; with one class only every score is that class.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from marquee.llm.common import ready
from marquee.llm.toxicity import labelled

SIZE = 1 << 18
#: Rows that the linear model is fitted to, at most (about: a hash decides).
SAMPLE = 12_000
COST, EPOCHS, SMOOTH = 1.0, 12, 1.0
#: Tokens up to ``TOKEN_CHARS`` characters are remembered per worker; a full memory is emptied, results do not depend on it.
MEMORY, TOKEN_CHARS = 400_000, 48
#: Characters of the strings that stand for the parts of a longer token.
PIECE = 4
_CORE = re.compile(r"^([^\w]*)(.*?)([^\w]*)$", re.S)


def _hashed(name: str) -> int:
    return xxhash.xxh64_intdigest(name.encode("utf-8", "surrogatepass"), 11) & (SIZE - 1)


def _parts(token: str) -> tuple[str, str, str]:
    """Marks before, word and marks behind it, as ``_CORE`` finds them."""
    i, j = 0, len(token)
    while i < j and not (token[i].isalnum() or token[i] == "_"):
        i += 1
    while j > i and not (token[j - 1].isalnum() or token[j - 1] == "_"):
        j -= 1
    return token[:i], token[i:j], token[j:]


def shape(token: str) -> str:
    """Case and length class of the word in a token, with the marks around it (at most three each)."""
    if len(token) > 200:  # the expression takes the square of the length
        before, core, behind = _parts(token)
    else:
        before, core, behind = _CORE.match(token).groups()
    if not core:
        return "m" + token[:4]
    kind = ("d" if core.isdigit() else "l" if core.islower() else "u" if core.isupper() and len(core) > 1
            else "t" if core[0].isupper() and (core[1:].islower() or not core[1:]) else "x")
    size = "0" if len(core) < 4 else "1" if len(core) < 9 else "2" if len(core) < 16 else "3" if len(token) <= 200 else "4"
    return f"{before[-3:]}{kind}{size}{behind[:3]}"


class Features:
    def __init__(self):
        self.tokens: dict[str, tuple[str, int]] = {}
        self.runs: dict[tuple, int] = {}
        self.pieces: set[int] = set()  # of the long tokens of one text

    def _token(self, t: str) -> tuple[str, int]:
        got = (shape(t), _hashed("w " + t.strip(".,;:!?\"'()[]{}*#%&$|").lower()))
        if len(t) > TOKEN_CHARS:
            low = t.lower()
            self.pieces.update([_hashed("c " + p) for p in {low[i:i + PIECE] for i in range(len(low) - PIECE + 1)}])
        else:
            if len(self.tokens) > MEMORY:
                self.tokens.clear()
            self.tokens[t] = got
        return got

    def _run(self, r: tuple) -> int:
        got = _hashed("s " + "\x1f".join(r))
        if len(self.runs) > MEMORY:
            self.runs.clear()
        self.runs[r] = got
        return got

    def __call__(self, text: str | None) -> list[int]:
        """Sorted slots of the distinct features of a whole text."""
        ts = (text or "").split()
        known, make = self.tokens, self._token
        both = [known[t] if t in known else make(t) for t in ts]
        out = {w for _, w in both} | self.pieces
        self.pieces.clear()
        kinds = [s if t != u else "=" for (s, _), t, u in zip(both, ts, ["", *ts])]
        runs = {(k,) for k in kinds} | set(zip(kinds, kinds[1:])) | set(zip(kinds, kinds[1:], kinds[2:])) | {("n", str(len(ts).bit_length()))}
        have, run = self.runs, self._run
        out.update([have[r] if r in have else run(r) for r in runs])
        return sorted(out)


@dataclass
class Model:
    ratio: np.ndarray = field(default_factory=lambda: np.zeros(SIZE, np.float32))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(SIZE, np.float32))
    bias: float = 0.0
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, slots: list[int]) -> float:
        at = np.array(slots, np.int64)
        r = self.ratio[at]
        size = math.sqrt(float(r @ r))
        return self.bias + (float(r @ self.weight[at]) / size if size else 0.0)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    f = Features()
    counts = np.zeros((2, SIZE), np.int64)
    for b in batches:
        for text, y in zip(b.column(0), b.column(1)):
            counts[1 if y.as_py() == 1 else 0, f(text.as_py())] += 1
    at = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[1, at]), pa.array(counts[0, at])], ["slot", "p", "q"])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    f = Features()
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [pa.array([f(t.as_py()) for t in b.column(0)], pa.list_(pa.int32())), b.column(1), b.column(2)], ["slots", "y", "crc"])


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: np.ndarray,
                            size: int, epochs: int = EPOCHS, seed: int = 0) -> tuple[np.ndarray, float]:
    """Hinge-loss linear model: each step solves one dual variable exactly within [0, cost]."""
    w, bias = np.zeros(size), 0.0
    alpha = np.zeros(len(rows))
    square = np.array([float(v @ v) + 1.0 for v in values])  # the bias is one more feature of value 1
    order, rng = np.arange(len(rows)), np.random.default_rng(seed)
    for _ in range(epochs):
        rng.shuffle(order)
        worst = 0.0
        for i in order:
            at, v = rows[i], values[i]
            g = y[i] * (float(w[at] @ v) + bias) - 1.0
            new = min(max(alpha[i] - g / square[i], 0.0), cost[i])
            step = new - alpha[i]
            if step:
                alpha[i] = new
                w[at] += step * y[i] * v
                bias += step * y[i]
                worst = max(worst, abs(step))
        if worst < 1e-4:
            break
    return w, bias


def _logistic(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability of class 1 by margin, a few Newton steps with a weak prior."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
        g = np.array([((p - y) * m).sum() + 0.01 * (a - 1), (p - y).sum() + 0.01 * b])
        s = p * (1 - p)
        h = np.array([[(s * m * m).sum() + 0.01, (s * m).sum()], [(s * m).sum(), s.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        a, b = a - float(np.clip(step[0], -2, 2)), b - float(np.clip(step[1], -2, 2))
        if np.abs(step).max() < 1e-6:
            break
    return max(a, 1e-3), b


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", mod: int = 3, held: int = 1,
          id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    ready(docs.sparkSession)
    rows = labelled(docs, labels, label, mod, held, id_col, text_col)
    sizes = {r[0]: r[1] for r in rows.groupBy("y").count().collect()}
    total = sum(sizes.values())
    if not sizes.get(0) or not sizes.get(1):
        return Model(offset=0.0 if not total else 20.0 if sizes.get(1) else -20.0)
    counts = rows.mapInArrow(_count, "slot int, p long, q long").groupBy("slot").agg(
        F.sum("p").alias("p"), F.sum("q").alias("q")).toPandas()  # a row per slot at most
    p, q = np.full(SIZE, SMOOTH), np.full(SIZE, SMOOTH)
    p[counts["slot"]] += counts["p"].to_numpy()
    q[counts["slot"]] += counts["q"].to_numpy()
    model = Model(ratio=(np.log(p / p.sum()) - np.log(q / q.sum())).astype(np.float32))
    model.ratio[(p + q) <= 2 * SMOOTH] = 0
    share = min(1.0, sample / total)
    part = rows.where(F.pmod(F.xxhash64("text", "crc"), F.lit(1_000_000)) < int(share * 1_000_000)).mapInArrow(
        _sampled, "slots array<int>, y int, crc long").collect()
    part.sort(key=lambda r: (r["crc"], r["slots"]))
    at = [np.array(r["slots"], np.int64) for r in part]
    values = [model.ratio[a].astype(np.float64) for a in at]
    values = [v / (np.linalg.norm(v) or 1.0) for v in values]
    y = np.array([1.0 if r["y"] == 1 else -1.0 for r in part])
    fit = np.array([k % 5 != 0 for k in range(len(part))])
    if len(set(y[fit])) < 2 or len(set(y[~fit])) < 2:
        fit[:] = True
    cost = np.where(y > 0, COST, COST * min(10.0, max(1.0, (y > 0).sum() / max(1, (y < 0).sum()))))
    chosen = np.flatnonzero(fit)
    model.weight, model.bias = dual_coordinate_descent(
        [at[i] for i in chosen], [values[i] for i in chosen], y[chosen], cost[chosen], SIZE)
    model.weight = model.weight.astype(np.float32)
    check = np.flatnonzero(~fit) if not fit.all() else chosen
    m = np.array([model.bias + float(model.weight[at[i]] @ values[i]) for i in check])
    model.slope, model.offset = _logistic(m, (y[check] > 0).astype(float))
    return model


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``: probability of label 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two vectors of SIZE
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, f = sent.value, Features()
        for b in batches:
            z = [m.slope * m.margin(f(t.as_py())) + m.offset for t in b.column(at)]
            s = 1 / (1 + np.exp(-np.clip(np.array(z, np.float64), -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], [*b.schema.names, "score"])
    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("score", DoubleType())]))
