"""Byte-level BPE encoding by per-prefix dynamic programming, and decoding.

For every prefix of a piece of text there is exactly one token that ends its
BPE encoding. Going left to right, an automaton over the vocabulary (all
tokens that are suffixes of the prefix, by failure links) offers candidates;
a candidate is the last token if it can stand directly after the last token
of the prefix it leaves. The table of last tokens is then followed backwards
and gives the ids that the merge rules would give, in time linear in the
piece, also for pieces of many megabytes.

Two tokens can stand side by side unless some merge across their boundary
would have come first. Along the boundary the left token shows its right
edge, the right token its left edge; each part of an edge exists from its own
merge until the merge that takes it up. If two parts exist together and their
merge comes before both are taken up (for equal ranks, the left one goes
first), the pair is impossible.

Texts are cut at added tokens first, then by the pattern of byte-level
vocabularies; each cut piece is encoded on its own. Merge files are read,
never trained; their path is a parameter.

Defined cases: null counts as empty; an empty text has no ids; lone bytes
that do not form UTF-8 decode to U+FFFD; other columns are passed on.
"""

from __future__ import annotations

import gc
import json
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from marquee.llm.common import Memory, P, kept_in_worker, ready

#: The pattern that byte-level vocabularies split text with (white space as in Unicode's property).
WHITE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + WHITE + r"\p{L}\p{N}]+"
           r"|[" + WHITE + r"]+(?![^" + WHITE + r"])|[" + WHITE + r"]+")
#: Words and pieces remembered per worker and generation.
MEMORY, PIECE_CHARS = 220_000, 48
#: Marks that are a piece of their own behind letters and before a space.
MARKS = frozenset(",.;:!?")
NEVER = 1 << 60


def byte_chars() -> dict[str, int]:
    """The printable character of each byte in vocabulary files: itself if visible, else the next free one from U+0100."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def load(path: str) -> dict:
    """Vocabulary, merges and added tokens of a tokenizer file, as plain data for a broadcast."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    to_byte = byte_chars()
    raw = {t: bytes(map(to_byte.__getitem__, t)) for t in spec["model"]["vocab"] if all(c in to_byte for c in t)}
    added = {a["content"]: a["id"] for a in spec["added_tokens"]}
    ids = {raw[t]: i for t, i in spec["model"]["vocab"].items() if t in raw and t not in added}
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    return {"ids": ids, "merges": [(raw[a], raw[b]) for a, b in merges if a in raw and b in raw], "added": added}


class Encoder:
    def __init__(self, model: dict, memory: int = MEMORY):
        ids: dict[bytes, int] = model["ids"]
        size = max([*ids.values(), *model["added"].values()], default=-1) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for t, i in ids.items():
            self.bytes_of[i] = t
        for t, i in model["added"].items():
            self.bytes_of[i] = t.encode("utf-8")
        merge: dict[int, dict[int, int]] = {}             # left -> right -> rank
        rank, parts = [0] * size, [None] * size
        for r, (a, b) in enumerate(model["merges"], 1):
            x, y, z = ids[a], ids[b], ids[a + b]
            merge.setdefault(x, {}).setdefault(y, r)
            if parts[z] is None:
                rank[z], parts[z] = r, (x, y)
        self.merge = merge
        self.right = [self._edge(i, rank, parts, 1) for i in range(size)]
        self.left = [self._edge(i, rank, parts, 0) for i in range(size)]
        self.open: list = [None] * size
        # a token counts if its own merge can happen: its halves stand side by side until then
        order = sorted(ids.values(), key=lambda i: rank[i])
        good = [False] * size
        for i in order:
            good[i] = parts[i] is None and len(self.bytes_of[i]) == 1 or parts[i] is not None and (
                good[parts[i][0]] and good[parts[i][1]] and self._fits(self._open(parts[i][0]), self.left[parts[i][1]], rank[i]))
        joined = {y for right in merge.values() for y in right}
        self.auto = ahocorasick.Automaton()
        for i in order:
            if good[i]:
                t = self.bytes_of[i]
                self.auto.add_word(t.decode("latin-1"), (i, len(t), [e for e in self.left[i] if e[0] in joined]))
        self.auto.make_automaton()
        self.split = regex.compile(PATTERN)
        self.added = regex.compile("|".join(regex.escape(t) for t in sorted(model["added"], key=len, reverse=True))) \
            if model["added"] else None
        self.added_ids = model["added"]
        self.words = Memory(memory)                       # after a space -> ids as int32 bytes
        self.starts = Memory(memory // 4)                 # the same at the start of a line
        self.pieces = Memory(memory)
        self.line = self._unit("\n")

    def _edge(self, i, rank, parts, side):
        """(part, rank of the merge that takes it up) along one edge of a token, outermost first."""
        out, until = [(i, NEVER)], rank[i]
        while parts[i] is not None:
            i = parts[i][side]
            out.append((i, until))
            until = rank[i]
        return out

    def _open(self, a: int) -> dict[int, int]:
        """What merges with the right edge of ``a`` in time: right part -> smallest rank."""
        out: dict[int, int] = {}
        for x, until in self.right[a]:
            for y, r in self.merge.get(x, {}).items():
                if r < until and r < out.get(y, NEVER):
                    out[y] = r
        self.open[a] = out
        return out

    @staticmethod
    def _fits(seen: dict[int, int], edge, limit: int = NEVER) -> bool:
        """No merge across the boundary comes before ``limit`` while both its parts exist."""
        for y, until in edge:
            r = seen.get(y)
            if r is not None and r <= until and r < limit:
                return False
        return True

    def piece(self, text: str) -> tuple[int, ...]:
        """Ids of one piece: last token of every prefix, then back-pointers."""
        b = text if text.isascii() else text.encode("utf-8", "surrogatepass").decode("latin-1")
        last, size = [-1] * (len(b) + 1), [0] * (len(b) + 1)
        opened = self.open
        for end, (tok, ln, edge) in self.auto.iter(b):
            end += 1
            if last[end] >= 0:
                continue
            if end > ln:                                  # else the token is the whole prefix
                before = last[end - ln]
                if before < 0:
                    continue
                seen = opened[before]
                if seen is None:
                    seen = self._open(before)
                for y, until in edge:                     # _fits, without a call
                    if y in seen and seen[y] <= until:
                        break
                else:
                    last[end], size[end] = tok, ln
            else:
                last[end], size[end] = tok, ln
        out, at = [], len(b)
        while at:
            if last[at] < 0:
                raise ValueError("the vocabulary has no encoding for these bytes")
            out.append(last[at])
            at -= size[at]
        out.reverse()
        return tuple(out)

    def _known_piece(self, p: str) -> tuple[int, ...]:
        ids = self.pieces.get(p)
        if ids is None:
            ids = self.piece(p)
            if len(p) <= PIECE_CHARS:
                self.pieces.put(p, ids)
        return ids

    def _unit(self, text: str) -> bytes:
        """Ids of a stretch that the pattern treats on its own."""
        body = text[1:] if text[:1] == " " else text
        if body.isalpha():                                # letters only: one piece
            return array("i", self._known_piece(text)).tobytes()
        if text[-1:] in MARKS and body[:-1].isalpha():
            return array("i", self._known_piece(text[:-1]) + self._known_piece(text[-1])).tobytes()
        out = array("i")
        for m in self.split.finditer(text):
            out.extend(self._known_piece(m[0]))
        return out.tobytes()

    def _word(self, w: str, out: list[bytes]) -> None:
        """``w`` after a space; a line break between visible characters is a piece of its own."""
        if "\n" in w:
            lines = w.split("\n")
            if all(x and not x[0].isspace() and not x[-1].isspace() for x in lines):
                out.append(self._remember(" " + lines[0]))
                for x in lines[1:]:
                    out.append(self.line)
                    out.append(self._remember(x))
                return
        out.append(self._remember(" " + w))

    def _remember(self, text: str) -> bytes:
        """Ids of a stretch; with a leading space they are found again by the word behind it."""
        memory, key = (self.words, text[1:]) if text[0] == " " else (self.starts, text)
        ids = memory.get(key)
        if ids is None:
            ids = self._unit(text)
            if len(key) <= PIECE_CHARS:
                memory.put(key, ids)
        return ids

    def _ordinary(self, text: str, out: list[bytes]) -> None:
        """Cut at single spaces: a piece never holds a space behind anything but white space.

        So a stretch from one space to the next is on its own if it ends in
        something visible; otherwise it is taken together with the next one.
        """
        words, known = text.split(" "), self.words.young.get
        wait = words[0] if words[0][-1:].isspace() or not words[0] else None
        if wait is None:
            out.append(self._unit(words[0]))
        for w in words[1:]:
            if wait is None:
                ids = known(w)
                if ids is not None:
                    out.append(ids)
                    continue
                if w and not w[-1].isspace():
                    self._word(w, out)
                    continue
                wait = ""
            wait += " " + w
            if w and not w[-1].isspace():
                out.append(self._unit(wait))
                wait = None
        if wait:
            out.append(self._unit(wait))

    def encode(self, text: str) -> np.ndarray:
        out: list[bytes] = []
        at = 0
        if self.added is not None:
            for m in self.added.finditer(text):
                self._ordinary(text[at:m.start()], out)
                out.append(np.array([self.added_ids[m[0]]], np.int32).tobytes())
                at = m.end()
        self._ordinary(text[at:] if at else text, out)
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


IDS, BACK = f"{P}ids", f"{P}decoded"
#: Rows of an output batch are closed at so many ids.
BATCH_IDS = 2_000_000


def _made(model: dict, memory: int = MEMORY) -> Encoder:
    encoder = Encoder(model, memory)
    gc.collect()
    gc.freeze()  # the tables stay as long as the worker: no need to look through them again
    return encoder


def _run(model, key: str, text_at: int, memory: int = MEMORY):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = kept_in_worker(("bpe", key, memory), lambda: _made(model.value, memory))
        for b in batches:
            lo, flat, back = 0, [], []

            def done(hi):
                ends = np.cumsum([0, *map(len, flat)])
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat)))
                part = b.slice(lo, hi - lo)
                return pa.RecordBatch.from_arrays([*part.columns, ids, pa.array(back, pa.string())],
                                                  [*b.schema.names, IDS, BACK])

            col, n = b.column(text_at), 0
            for r in range(b.num_rows):
                ids = enc.encode(col[r].as_py() or "")
                flat.append(ids)
                back.append(enc.decode(ids.tolist()))
                n += len(ids)
                if n >= BATCH_IDS:
                    yield done(r + 1)
                    lo, flat, back, n = r + 1, [], [], 0
            if lo < b.num_rows:
                yield done(b.num_rows)
    return run


def encoded(docs: DataFrame, path: str, text_col: str = "text", memory: int = MEMORY) -> DataFrame:
    """``docs`` with ``__q_ids`` (token ids) and ``__q_decoded`` (the text those ids decode to).

    ``memory`` bounds the words and pieces that a worker remembers; ids never depend on it."""
    spark = ready(docs.sparkSession)
    model = spark.sparkContext.broadcast(load(path))  # as large as the vocabulary file, whatever the documents
    schema = StructType([*docs.schema.fields, StructField(IDS, ArrayType(IntegerType())), StructField(BACK, StringType())])
    return docs.mapInArrow(_run(model, path, docs.columns.index(text_col), memory), schema)


def digests(rows: DataFrame) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 beside the columns of ``rows``."""
    return rows.withColumns({
        "n_tokens": F.size(IDS).cast("long"),
        "ids_sha256": F.sha2(F.array_join(F.col(IDS).cast("array<string>"), ",").cast("binary"), 256),
        "decoded_sha256": F.sha2(F.col(BACK).cast("binary"), 256)}).drop(IDS, BACK)
