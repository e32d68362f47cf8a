"""Plain, slow restatements of the contracts, straight from their text."""

import hashlib
import re

import xxhash
from tokenizers import Tokenizer

import public_tokenizers


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def low(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


def op1(docs):
    fps = {}
    for k, (_, text) in enumerate(docs):
        ws = re.findall(r"[^\x20\x09-\x0D]+", low(text))
        sh = [" ".join(ws[i:i + 3]) for i in range(max(1, len(ws) - 2))] if ws else []
        hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        fps[k] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    distinct = sorted(set(fps.values()))
    parent = {f: f for f in distinct}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                parent[find(a)] = find(b)
    low_id = {}
    for k, (i, _) in enumerate(docs):
        r = find(fps[k])
        if i is not None:
            low_id[r] = min(low_id.get(r, i), i)
    return [(i, f"{fps[k]:016x}", low_id.get(find(fps[k]))) for k, (i, _) in enumerate(docs)]


def words3(s):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(s))


def op3(docs, items):
    wins = []
    for item, text in items:
        ws = words3(text)
        m = min(13, len(ws))
        wins += [(item, tuple(ws[i:i + m])) for i in range(len(ws) - m + 1)] if ws else []
    by_len = {}
    for item, w in wins:
        by_len.setdefault(len(w), {}).setdefault(w, set()).add(item)
    out = []
    for i, text in docs:
        ws = words3(text)
        hit, found = set(), set()
        for m, table in by_len.items():
            for k in range(len(ws) - m + 1):
                got = table.get(tuple(ws[k:k + m]))
                if got:
                    hit.update(range(k, k + m))
                    found |= got
        ids = sorted(str(x) for x in found if x is not None)
        out.append((i, len(ws), len(hit), len(ids), sha(",".join(ids)), len(hit) > 0 and 20 * len(hit) >= len(ws)))
    return out


def op5(docs, n=200):
    texts = [(t or "").encode() for _, t in docs]
    seen = {}
    for k, b in enumerate(texts):
        for p in range(len(b) - n + 1):
            seen.setdefault(b[p:p + n], []).append((k, p))
    gone = [bytearray(len(b)) for b in texts]
    for at in seen.values():
        if len(at) > 1:
            for k, p in at:
                gone[k][p:p + n] = b"\x01" * n
    out = []
    for (i, _), b, g in zip(docs, texts, gone):
        runs = len(re.findall(b"\x01+", bytes(g)))
        out.append((i, len(b), sum(g), runs, sha(bytes(c for c, x in zip(b, g) if not x))))
    return out


def op7(docs):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.no_truncation()
    t.no_padding()
    out = []
    for i, text in docs:
        ids = t.encode(text or "", add_special_tokens=False).ids
        out.append((i, len(ids), sha(",".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))))
    return out


def op9(docs):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in docs]
    groups = {}
    for k, n in enumerate(norm):
        groups.setdefault(n, []).append(k)
    out = []
    for k, n in enumerate(norm):
        g = groups[n]
        first = min(g, key=lambda j: (docs[j][0] is None, docs[j][0] or 0, j))
        out.append((docs[k][0], docs[first][0], len(g), k == first, sha(n)))
    return out
