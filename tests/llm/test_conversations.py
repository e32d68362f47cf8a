"""Conversation repair against plain dynamic programming, its SQL, and whole conversations cut into segments."""

import hashlib
import random
import zlib

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest_path import SMALL

from marquee.llm import conversations as C
from marquee.llm.catalog import ORACLE_SQL, QUERIES

COLS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SPACE = " \t\n\x0b\x0c\r"


def plain(rows):
    """Cheapest (cost, audit, lines) by state, whole audits kept, straight from the contract."""
    best = {"": (0, "", [])}  # role initials so far, as the last two matter: '', s, u, a

    def put(to, state, new):
        if state not in to or new < to[state]:
            to[state] = new

    def inserted(now):
        for _ in range(3):
            for st, (c, a, ls) in list(now.items()):
                put(now, *(("a", (c + 5, a + "I", ls + ["assistant:"])) if st == "u" else ("u", (c + 5, a + "I", ls + ["user:"]))))
        return now
    for role, text, fault in rows:
        new = {}
        for st, (c, a, ls) in inserted(dict(best)).items():
            put(new, st, (c + 2, a + "D", ls))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            for op, r, cost in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                if (r[:1], st) in (("s", ""), ("u", ""), ("u", "s"), ("u", "a"), ("a", "u")):
                    put(new, r[:1], (c + cost + more, a + op, ls + [f"{r}:{text}"]))
        best = new
    return min(v for k, v in inserted(dict(best)).items() if k in ("", "a"))


def expected(table):
    out, by = [], {}
    for conv, turn, role, text in table:
        rows = by.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if how == 1 else text.translate({ord(c): None for c in ".!?"}) if how == 2 else text
        rows += [(turn, "user" if how == 4 else role, text)] * (0 if how == 0 else 2 if how == 3 else 1)
    for conv, rows in by.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, judged, n = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in rows:
            bare = text.strip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            judged.append((role, text, fault))
            if fault:
                n[fault] += 1
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit, lines = plain(judged)
        out.append((conv, gaps, *n.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def odd_rows():
    rnd = random.Random(4)
    roles = ["system", "user", "assistant", "tool", "", None, "a", "s", "User"]
    texts = ["Yes.", "no", " \n", "", None, "Why?", "é　", "So! \r\n", "x" * 5000 + ".", "a:b", "\x85", "Yes. "]
    rows = [(c, t, rnd.choice(roles[:3] if c % 2 else roles), rnd.choice(texts) if c % 3 else f"Text {t} of {c}.")
            for c in range(60) for t in range(rnd.randrange(1, 9))]
    rows += [(100, None, "user", "Hm."), (100, None, "assistant", "Hm."), (100, 3, "user", "Hm."), (None, 1, "user", "Hi."), (None, None, None, None),
             (101, 5, "user", "Tie."), (101, 5, "assistant", "Tie."), (101, 5, "user", "Tie."), (101, 9, "user", "Tie."), (102, -4, "system", "Go.")]
    rows += [(200, t, rnd.choice(roles[:4]), rnd.choice(texts)) for t in range(300)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def key(rows):
    return sorted(map(repr, rows))


def test_audits_of_random_rows():
    rnd = random.Random(7)
    for _ in range(3000):
        rows = [(rnd.choice(["system", "user", "assistant", "x", ""]), f"t{i}", rnd.choice([0, 0, 0, 1, 2, 3])) for i in range(rnd.randrange(0, 14))]
        named = [(r, t, ("", "blank", "duplicate", "truncated")[f]) for r, t, f in rows]
        assert C.audit_of(rows) == plain(named)


def test_segments_meet_like_rows():
    rnd = random.Random(9)
    for _ in range(500):
        kinds = bytes(rnd.randrange(len(C._KINDS)) for _ in range(rnd.randrange(1, 30)))
        cuts = sorted({0, len(kinds), *(rnd.randrange(len(kinds)) for _ in range(4))})
        parts = [kinds[a:b] for a, b in zip(cuts, cuts[1:])]
        states = C.crossings([C.matrix([C._KINDS[k] for k in p]) for p in parts], 0, C.FINISH)
        audit, cost, p = "", 0, 0
        for part, q in zip(parts, states):
            c, edits = C.solve(part, p, q)
            audit, cost, p = audit + "".join(edits), cost + c, q
        whole = C.solve(kinds)
        assert (cost + C.FINISH[p], audit + "I" * (C.FINISH[p] // C.INSERT)) == (whole[0], "".join(whole[1]))


@pytest.mark.parametrize("rows_of_a_segment", [4096, 7])
def test_odd_rows(spark, monkeypatch, rows_of_a_segment):
    table = odd_rows()
    # a small value cuts the long conversations into many segments
    monkeypatch.setattr(C, "_pack", C.packer(rows_of_a_segment))
    clash = frame(spark, table).selectExpr("*", "1 AS n", "'x' AS d", "2 AS copy", "3 AS fault", "4 AS part")
    got = C.repaired_damage(clash)
    assert key(tuple(r[c] for c in COLS) for r in got.collect()) == key(expected(table))


def test_empty(spark):
    assert C.repaired_damage(frame(spark, [])).collect() == []


def test_many_copies_of_one_row(spark):
    table = [(1, t % 3, "user", "Again.") for t in range(9000)] + [(1, 5, "assistant", "Well.")]
    got = [tuple(r[c] for c in COLS) for r in C.repaired_damage(frame(spark, table)).collect()]
    assert got == expected(table)


def test_repaired_rows(spark):
    table = odd_rows()
    got = C.repaired_rows(C.damaged(frame(spark, table))).orderBy("conv_id", "part", "seq", "k").collect()
    text = {}
    for r in got:
        text.setdefault(r["conv_id"], []).append(r["lines"])
    for x in expected(table):
        assert hashlib.sha256("\n".join(text.get(x[0], [])).encode()).hexdigest() == x[-1]


@pytest.mark.parametrize("odd", [False, True])
def test_matches_sql(spark, tmp_path, odd):
    folder = SMALL
    if odd:
        folder = str(tmp_path)
        rows = [r for r in odd_rows() if r[0] != 200]
        pq.write_table(pa.table({n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate(
            [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])}), f"{folder}/conversations.parquet")
    c = duckdb.connect()
    c.execute(f"create view conversations as select * from '{folder}/conversations.parquet'")
    want = c.execute(ORACLE_SQL["op12_conversation_repair"]).fetchall()
    got = [tuple(r[c] for c in COLS) for r in QUERIES["op12_conversation_repair"](spark, folder).collect()]
    assert key(got) == key(want)
