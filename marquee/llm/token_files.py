"""Token ids in files of directly addressable codes.

An id is cut into chunks, lowest bits first. Level 0 of a file holds the first
chunk of every id, level 1 the second chunk of the ids that have one, and so on;
a bitmap beside each level says which of its entries go on, and a directory of
counts (one for every ``STRIDE`` bits) tells where they go on: the entry with the
k-th set bit continues at place k of the next level. Any id is read by
looking at one entry per level, and the ids ``i`` to ``j`` are one contiguous stretch
of every level, so no block is ever decoded. The widths of the levels are
chosen for each file by dynamic programming over the bit lengths of its ids.

File, all numbers little-endian:

    8 bytes   magic ``DACTOK01``
    u64       ids, u64 documents, u32 levels, u32 0
    per level u32 width, u32 0, u64 entries, u64 x 3 offsets of values, bitmap, directory
    documents i64 id and u8 known each, then u64 starts (documents + 1)

The last level needs no bitmap. A dataset is a folder of such files and the
table ``index`` (Parquet, written by Spark after them): file, part, seq, documents,
ids and ``start``, the number of ids in all files before. Documents are dealt to tasks
by ranges of their id; a task writes files of about ``FILE_IDS`` ids.
Names hold a fresh random part, and only files named in the index count, so a
task that runs twice, or dies half-way, leaves no trace in the dataset.

Ids are the tokenizers library's. If the tokenizer drops white space and treats
the words between on their own, words are encoded once and remembered, and their
pieces go straight to the library's model. Otherwise whole texts are encoded.

Files are written and read by ``pyarrow.fs`` (local and mounted folders, hdfs,
s3, gs), so ``spark.checkpoint.dir`` has to be a folder that it can reach.

Defined cases: a null text is empty and has the end id only; a null id comes
first; documents with one id are ordered by their text's hash; other columns
are ignored; an empty table gives a dataset without files.
"""

from __future__ import annotations

import gc
import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import P, kept_in_worker, partitions, ready
from marquee.session import scratch_path

MAGIC = b"DACTOK01"
HEAD, LEVEL = struct.Struct("<8sQQII"), struct.Struct("<IIQQQQ")
#: Bits of a bitmap counted by one entry of the directory.
STRIDE = 512
#: Levels and bits of an id, at most.
LEVELS, BITS = 3, 32
#: Ids of a file, about: a document is never split.
FILE_IDS = 1 << 21
#: Ids read at a time, about; a document is read whole.
STRETCH = 1 << 17
#: Values packed at a time; bounds the memory of packing.
CHUNK = 1 << 18
#: Words and pieces remembered per worker and generation; longer words are not.
MEMORY, WORD_CHARS = 300_000, 64
#: Characters of texts encoded together, about.
TOGETHER = 1 << 19


# --- directly addressable codes ------------------------------------------------------


def packed(values: np.ndarray, width: int) -> bytes:
    """``width`` bits of each value, lowest first."""
    out, kind = [], np.uint8 if width <= 8 else np.uint16 if width <= 16 else np.uint32
    for a in range(0, len(values), CHUNK):  # a multiple of 8 values: whole bytes
        v = values[a:a + CHUNK].astype(kind)
        bits = np.unpackbits(v.view(np.uint8).reshape(len(v), -1), axis=1, count=width, bitorder="little")
        out.append(np.packbits(bits.reshape(-1), bitorder="little").tobytes())
    return b"".join(out)


def unpacked(data: bytes, first_bit: int, n: int, width: int) -> np.ndarray:
    """``n`` values from bit ``first_bit`` of ``data`` on."""
    kind = np.uint8 if width <= 8 else np.uint16 if width <= 16 else np.uint32
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")[first_bit:first_bit + n * width]
    wide = np.zeros((n, 8 * kind().itemsize), np.uint8)
    wide[:, :width] = bits.reshape(n, width)
    return np.packbits(wide, bitorder="little").view(kind).astype(np.uint32)


def widths(ids: np.ndarray) -> list[int]:
    """Level widths of the smallest code for these ids, by dynamic programming."""
    top = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    longer = [int((ids >= 1 << k).sum()) if k else len(ids) for k in range(top + 1)]  # ids with more than k bits
    goes_on = 1 + 64 / STRIDE                             # a bit of the bitmap and its share of the directory
    # best[l][k]: fewest bits for the levels up to bit k, in l levels
    best = {(0, 0): (0, ())}
    for level in range(1, LEVELS + 1):
        for k in range(1, top + 1):
            found = [(best[level - 1, j][0] + longer[j] * (k - j + (goes_on if k < top else 0)), (*best[level - 1, j][1], k - j))
                     for j in range(k) if (level - 1, j) in best and (j or level == 1)]
            if found:
                best[level, k] = min(found)
    return list(min(best[level, top] for level in range(1, LEVELS + 1) if (level, top) in best)[1])


def encoded_file(ids: np.ndarray, doc_ids: list[int | None], starts: list[int]) -> bytes:
    """One file: ``starts`` holds the first id of each document and the end."""
    rest, levels, blobs = ids.astype(np.uint32), [], []
    cut = widths(ids)
    for k, w in enumerate(cut):
        n, more = len(rest), rest >> np.uint32(w) if w < BITS else np.zeros(len(rest), np.uint32)
        goes_on = more > 0
        parts = [packed(rest, w), b"", b""]
        if k + 1 < len(cut):
            parts[1] = np.packbits(goes_on, bitorder="little").tobytes()
            blocks = np.add.reduceat(goes_on, np.arange(0, n, STRIDE), dtype=np.int64) if n else np.zeros(0, np.int64)
            parts[2] = np.concatenate(([0], np.cumsum(blocks))).astype("<u8").tobytes()
            rest = more[goes_on]
        levels.append((w, n))
        blobs.append(parts)
    at = HEAD.size + LEVEL.size * len(cut)
    table, body = [], []
    known = bytes(d is not None for d in doc_ids)
    body.append(np.array([d or 0 for d in doc_ids], "<i8").tobytes() + known + np.array(starts, "<u8").tobytes())
    at += len(body[0])
    for (w, n), parts in zip(levels, blobs):
        places = []
        for blob in parts:
            places.append(at)
            body.append(blob)
            at += len(blob)
        table.append(LEVEL.pack(w, 0, n, *places))
    return HEAD.pack(MAGIC, len(ids), len(doc_ids), len(cut), 0) + b"".join(table) + b"".join(body)


class Reader:
    """Random access to a file through ``read(offset, size)``; nothing but what is asked for is read."""

    def __init__(self, read: Callable[[int, int], bytes]):
        self.read = read
        magic, self.n_ids, self.n_docs, n, _ = HEAD.unpack(read(0, HEAD.size))
        if magic != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        self.levels = [LEVEL.unpack(x) for x in np.frombuffer(read(HEAD.size, LEVEL.size * n), f"V{LEVEL.size}")]
        self.docs_at = HEAD.size + LEVEL.size * n

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """Ids of the documents, and where each starts (and the last ends)."""
        n = self.n_docs
        ids = np.frombuffer(self.read(self.docs_at, 8 * n), "<i8").tolist()
        known = self.read(self.docs_at + 8 * n, n)
        return [i if k else None for i, k in zip(ids, known)], np.frombuffer(self.read(self.docs_at + 9 * n, 8 * (n + 1)), "<u8")

    def _rank(self, level: int, i: int) -> int:
        """Set bits of the level's bitmap before entry ``i``."""
        _, _, _, _, bits, directory = self.levels[level]
        block = i // STRIDE
        count = int.from_bytes(self.read(directory + 8 * block, 8), "little")
        n = i - block * STRIDE
        if n:
            b = np.frombuffer(self.read(bits + block * STRIDE // 8, (n + 7) // 8), np.uint8)
            count += int(np.unpackbits(b, bitorder="little", count=n).sum())
        return count

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop``: one stretch of every level."""
        if not 0 <= start <= stop <= self.n_ids:
            raise IndexError("no such ids")
        out, places, shift = np.zeros(stop - start, np.uint32), None, 0
        for k, (w, _, _, values, bits, _) in enumerate(self.levels):
            n = stop - start
            if not n:
                break
            a = start * w // 8
            got = unpacked(self.read(values + a, (stop * w + 7) // 8 - a), start * w - 8 * a, n, w) << np.uint32(shift)
            if places is None:
                out |= got
            else:
                out[places] |= got
            if k + 1 == len(self.levels):
                break
            a = start // 8
            goes_on = np.unpackbits(np.frombuffer(self.read(bits + a, (stop + 7) // 8 - a), np.uint8), bitorder="little")[start - 8 * a:][:n]
            here = np.flatnonzero(goes_on)
            places = here if places is None else places[here]
            start = self._rank(k, start)
            stop, shift = start + len(here), shift + w
        return out

    def id(self, i: int) -> int:
        return int(self.ids(i, i + 1)[0])


# --- encoding ------------------------------------------------------------------------

#: The parts of a tokenizer file that make white space vanish and let words be taken one by one.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
#: The same split for lower-cased ASCII words without white space.
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_MARKS = frozenset(".,;:!?")


def _byte_chars() -> list[str]:
    """The visible character that stands for each byte in a byte-level vocabulary."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 256
    for b in range(256):
        if b in seen:
            out[b] = chr(b)
        else:
            out[b] = chr(extra)
            extra += 1
    return out


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers.

    New words are cut into pieces, and all new pieces of a batch go to the
    library's model in one call: the last id of every piece ends a word, so the
    ids of the batch fall apart again. Letters up to U+00FF stay one character
    under NFC and lower-casing; words with others go through the whole tokenizer.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit
        self.lib = Tokenizer.from_str(spec)
        self.lib.no_truncation()
        self.lib.no_padding()
        d = json.loads(spec)
        split = (d.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        end = d["model"].get("end_of_word_suffix")
        added = [a for a in d["added_tokens"] if a["normalized"] or a["lstrip"] or a["rstrip"] or a["single_word"] or " " in a["content"] or "\n" in a["content"]]
        self.by_word = bool(
            (d.get("normalizer") or {}).get("normalizers") == _NORMAL and len(split) == 2 and split[0].get("type") == "Split"
            and split[0]["pattern"] == {"Regex": _SPLIT} and split[0]["behavior"] == "Removed" and split[0]["invert"]
            and split[1] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False} and not added and end)
        if self.by_word:
            self.marks = [a["content"] for a in d["added_tokens"]]
            self.chars = dict(enumerate(_byte_chars()))
            self.model = Tokenizer(self.lib.model)
            self.model.pre_tokenizer = WhitespaceSplit()
            vocab = d["model"]["vocab"]
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for t, i in vocab.items() if t.endswith(end)]] = True
            self.young, self.old = {}, {}                 # words and pieces, in two generations
            gc.freeze()                                   # the tables hold no cycles

    @staticmethod
    def _bytes(ids) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, new: list[str]) -> None:
        """Encode words that neither generation knows; letters in lower case are a piece, and mostly a word."""
        young, get = self.young, self.old.get
        letters, marked, others, whole = [], [], [], []
        for w in new:
            if w.isalpha():
                (letters if w.islower() and (w.isascii() or max(w) <= "\u00ff") else whole).append(w)
                continue
            body = w[:-1]
            if w[-1] in _MARKS and body.isalpha() and body.islower() and (body.isascii() or max(body) <= "\u00ff"):
                marked.append(w)
            elif w.isascii() and not any(m in w for m in self.marks) and not any(c in w for c in "\t\r\x0b\x0c"):
                others.append((w, _ASCII.findall(w.lower())))
            else:
                whole.append(w)
        wanted = set(letters)
        for p in {w[:-1] for w in marked}.union(_MARKS, *(c for _, c in others)).difference(young):
            got = get(p)
            if got is None:
                wanted.add(p)
            else:
                young[p] = got
        fresh = list(wanted)
        for a in range(0, len(fresh), 8192):
            some = fresh[a:a + 8192]
            # a byte-level vocabulary spells other characters as bytes
            seen = " ".join([p if p.isalnum() and p.isascii() else p.encode().decode("latin-1").translate(self.chars) for p in some])
            ids = np.array(self.model.encode(seen, add_special_tokens=False).ids, "<u4")
            stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(stops) != len(some):
                raise ValueError("a piece does not end where its word ends")
            raw, at = ids.tobytes(), 0
            for p, stop in zip(some, stops):
                young[p] = raw[at:stop]
                at = stop
        for w in marked:
            young[w] = young[w[:-1]] + young[w[-1]]
        for w, c in others:
            young[w] = b"".join([young[p] for p in c])
        if whole:
            for w, e in zip(whole, self.lib.encode_batch(whole, add_special_tokens=False)):
                young[w] = self._bytes(e.ids)

    def _lower(self, text: str | None) -> str:
        """Latin-1 text without special tokens may be lower-cased as a whole; the library does the others word by word."""
        if not text:
            return ""
        if any(m in text for m in self.marks):
            return text
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return text
        return text.lower()

    def texts(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text."""
        if not self.by_word:
            return [self._bytes(e.ids) for e in self.lib.encode_batch([t or "" for t in texts], add_special_tokens=False)]
        # line feeds and spaces only: other white space stays inside a word and is the library's
        words = [self._lower(t).replace("\n", " ").split(" ") for t in texts]
        self.young[""] = b""
        unknown = []
        for w in set().union(*words).difference(self.young):
            got = self.old.get(w)
            if got is None:
                unknown.append(w)
            else:
                self.young[w] = got
        if unknown:
            self._learn(unknown)
        out = [b"".join(map(self.young.__getitem__, ws)) for ws in words]
        # long words are kept for this batch only, and a full generation makes room
        if max(map(len, unknown), default=0) > WORD_CHARS:
            self.young = {w: b for w, b in self.young.items() if len(w) <= WORD_CHARS}
        if len(self.young) > MEMORY:
            self.old, self.young = self.young, {}
        return out

    def text(self, text: str | None) -> bytes:
        return self.texts([text])[0]


# --- writing -------------------------------------------------------------------------

_INDEX = "file string, part int, seq int, n_docs long, n_ids long"


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Ids and texts of a bounded number of characters at a time (one text may be longer)."""
    docs, texts, size = [], [], 0
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1)):
            t = t.as_py()
            docs.append(i)
            texts.append(t)
            size += len(t or "")
            if size > TOGETHER:
                yield docs, texts
                docs, texts, size = [], [], 0
    if docs:
        yield docs, texts


def _write_task(folder: str, spec, end_id: int | None, file_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, own = TaskContext.get().partitionId(), uuid.uuid4().hex
        enc = kept_in_worker(("token files", spec.id), lambda: Encoder(spec.value))
        end = b"" if end_id is None else struct.pack("<I", end_id)
        store, path = _place(folder)
        done, held, docs, starts, n = [], [], [], [0], 0

        def write():
            name = f"{part:06d}-{len(done):04d}-{own}.dac"
            with store.open_output_stream(f"{path}/{name}") as f:
                f.write(encoded_file(np.frombuffer(b"".join(held), "<u4"), docs, starts))
            done.append((name, part, len(done), len(docs), n))
        gc.disable()                                      # words and ids hold no cycles: nothing to look for in the memories
        try:
            for doc_ids, texts in _together(batches):
                for i, ids in zip(doc_ids, enc.texts(texts)):
                    held += (ids, end)
                    docs.append(i)
                    n += (len(ids) + len(end)) // 4
                    starts.append(n)
                    if n >= file_ids:
                        write()
                        held, docs, starts, n = [], [], [0], 0
            if docs:
                write()
        finally:
            gc.enable()
        cols = list(zip(*done)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
                                         ["file", "part", "seq", "n_docs", "n_ids"])
    return run


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end_id: int | None = None, id_col: str = "doc_id",
                 text_col: str = "text", file_ids: int = FILE_IDS) -> str:
    """Encode ``docs`` in ascending order of their ids into ``folder``; the files and their index."""
    spark = ready(docs.sparkSession)
    store, path = _place(folder)
    store.create_dir(path, recursive=True)
    with open(tokenizer, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    key, tie, row = F.col("doc_id"), F.xxhash64("text"), F.col(f"{P}row")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # equal rows may be dealt to several tasks: their order makes no difference
    rows = rows.withColumn(f"{P}row", F.monotonically_increasing_id())
    order = [key.asc_nulls_first(), tie, row]
    rows = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).select("doc_id", "text")
    written = rows.mapInArrow(_write_task(folder, _Shared(spec), end_id, file_ids), _INDEX)
    written.write.parquet(f"{folder}/written")
    files = spark.read.parquet(f"{folder}/written")
    # ids before each task: one number per task, as many as the cluster has partitions
    sums = files.groupBy("part").agg(F.sum("n_ids")).collect()
    before, total = [], 0
    for part, n in sorted(map(tuple, sums)):
        before.append((part, total))
        total += n
    offsets = spark.createDataFrame(before, "part int, before long")
    from pyspark.sql import Window
    earlier = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    index = files.withColumn("earlier", F.coalesce(earlier, F.lit(0))).join(offsets, "part")
    index.select("file", "part", "seq", "n_docs", "n_ids", (F.col("before") + F.col("earlier")).alias("start")).write.parquet(f"{folder}/index")
    return folder


class _Shared:
    """A broadcast with a name that a worker can remember."""

    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, broadcast._jbroadcast.id()

    @property
    def value(self):
        return self.broadcast.value

    def __reduce__(self):
        return _unshared, (self.broadcast, self.id)


def _unshared(broadcast, name):
    out = _Shared.__new__(_Shared)
    out.broadcast, out.id = broadcast, name
    return out


# --- reading -------------------------------------------------------------------------


def _open(store: fs.FileSystem, path: str) -> Reader:
    f = store.open_input_file(path)
    return Reader(lambda at, n: f.read_at(n, at))


def _read_task(folder: str, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _place(folder)
        for b in batches:
            for r in b.to_pylist():
                with store.open_input_file(f"{path}/{r['file']}") as f:
                    whole = f.read()  # a file is bounded; its documents are read one by one
                dac = Reader(lambda at, n: whole[at:at + n])
                docs, starts = dac.documents()
                starts = starts.astype(np.int64)
                a = 0
                while a < len(docs):
                    # the documents of one stretch of ids, one document at least
                    b_ = max(a + 1, int(np.searchsorted(starts, starts[a] + STRETCH, "right")) - 1)
                    raw, lens = dac.ids(int(starts[a]), int(starts[b_])).astype("<u4").tobytes(), np.diff(starts[a:b_ + 1])
                    ends = (4 * (starts[a + 1:b_ + 1] - starts[a])).tolist()
                    parts = [raw[x:y] for x, y in zip([0, *ends], ends)]
                    cols = {"doc_id": pa.array(docs[a:b_], pa.int64()), "start": pa.array(starts[a:b_] + r["start"], pa.int64()),
                            "n_tokens": pa.array(lens, pa.int64())}
                    if "ids_crc32" in columns:
                        cols["ids_crc32"] = pa.array([zlib.crc32(x) for x in parts], pa.int64())
                    if "ids" in columns:
                        cols["ids"] = pa.array([np.frombuffer(x, "<u4").astype(np.int64).tolist() for x in parts], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_pydict({c: cols[c] for c in columns})
                    a = b_
    return run


_READ = {"doc_id": "long", "start": "long", "n_tokens": "long", "ids_crc32": "long", "ids": "array<long>"}


def read_tokens(spark: SparkSession, folder: str, columns: tuple[str, ...] = ("doc_id", "start", "n_tokens", "ids")) -> DataFrame:
    """Every document of a dataset, read back from its files."""
    index = spark.read.parquet(f"{folder}/index").select("file", "start")
    return index.repartition(partitions(spark), "file").mapInArrow(
        _read_task(folder, list(columns)), ", ".join(f"{c} {_READ[c]}" for c in columns))


def tokens_at(spark: SparkSession, folder: str, places: list[int]) -> list[int]:
    """The ids at these places of the whole dataset, by random access to their files; for a handful of places."""
    store, path = _place(folder)
    index = spark.read.parquet(f"{folder}/index")
    out = []
    for place in places:
        row = index.where((F.col("start") <= place) & (F.col("start") + F.col("n_ids") > place)).first()
        if row is None:
            raise IndexError(f"no id {place}")
        out.append(_open(store, f"{path}/{row['file']}").id(place - row["start"]))
    return out


def written_and_read(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """The contract: encoded, written in order of ids, read back; doc_id, start, n_tokens, ids_crc32."""
    spark = ready(docs.sparkSession)
    folder = write_tokens(docs, tokenizer, scratch_path(spark, "tokens"), end_id)
    return read_tokens(spark, folder, ("doc_id", "start", "n_tokens", "ids_crc32"))
