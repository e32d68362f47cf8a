"""Conversation structure repair by divide and conquer over a four-state automaton.

Role initials of a sound conversation are ``(s?(ua)+)?``. The automaton has four
states: nothing yet, after ``s``, after ``u``, after ``a``; the first and the
last accept. A row is kept (K), given the role user or assistant (R, 1) or
deleted (D, 2; the only choice for blank rows and duplicates), and rows without
text may be inserted before it (I, 5 each); a truncated row that stays costs 5.
The cheapest edits win, of equally cheap ones the ASCII-least audit.

The method (Hirschberg): a forward vector gives the cost of reaching each state
after the first half of the rows, a backward vector the cost of finishing from
it; the cheapest state where they meet is the crossing, and both halves are
solved on their own. The forward vector carries, beside each cost, the rank of
the least audit that reaches the state: audits of two states differ before
either ends (each ends in the edit of its last row), so the rank alone decides
between equally cheap crossings, for the halves and for the whole. No table of
costs over all rows is kept.

Spread over a cluster, no conversation has to fit into a task: rows are ordered
by (conversation, turn) with a range shuffle and packed into segments of at most
``ROWS`` rows and ``CHARS`` characters. A conversation of one segment is solved where it lies. Of a
longer one each segment gives its 4 x 4 matrix of costs and audit ranks, the same
divide and conquer over matrices finds the states between segments, every segment
is then solved between its two states in its own task, and the repaired rows come
back in pieces. Rows that equal each other (conversation, turn, role, text) are
counted before the shuffle, so a repeated row is no hot key.

Defined cases: a null role or text counts as one space; a null turn sorts first
and is one space in the damage key; rows of one turn are ordered by role, then by the
text's digest; a null conversation id is a conversation of its own;
other columns are ignored; an empty table gives no rows; a conversation without
rows has zeros, an empty audit and the hash of the empty string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import P, materialised, partitions, ready

#: Rows and characters of a segment, at most (one row may be longer).
ROWS, CHARS = 4096, 4_000_000
#: Characters of a piece of repaired text, about.
PIECE = 1 << 20
BLANKS = r"\x20\x09-\x0D"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
STATES, ACCEPT = 4, (0, 3)
#: What the state after a row with this initial is, from the states that allow it.
_AFTER = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: Inserted rows from one state to another; longer runs only come back to a state.
_INSERTS = [{0: 0, 2: 1, 3: 2}, {1: 0, 2: 1, 3: 2}, {2: 0, 3: 1}, {3: 0, 2: 1}]
_ROLE = {2: "user", 3: "assistant"}
INF = 1 << 60
#: Faults of a row.
SOUND, BLANK, DUPLICATE, CUT = 0, 1, 2, 3


def _row_step(initial: str, fault: int) -> list[list[tuple[int, str] | None]]:
    """Cheapest (cost, least audit) from each state before a row to each state after it."""
    step: list[list] = [[None] * STATES for _ in range(STATES)]

    def offer(p, q, cost, audit):
        if step[p][q] is None or (cost, audit) < step[p][q]:
            step[p][q] = (cost, audit)
    for p in range(STATES):
        for m, k in _INSERTS[p].items():
            before, paid = "I" * k, INSERT * k
            offer(p, m, paid + DELETE, before + "D")
            if fault in (BLANK, DUPLICATE):
                continue
            extra = TRUNCATED if fault == CUT else 0
            q = _AFTER.get(initial, {}).get(m)
            if q is not None:
                offer(p, q, paid + extra, before + "K")
            for role in "ua":
                q = _AFTER[role].get(m)
                if q is not None:
                    offer(p, q, paid + extra + REROLE, before + "R")
    return step


#: Kinds of rows: 0 to delete, then role initial x truncated.
_INITIALS = ("s", "u", "a", "")
_KINDS = [_row_step("", BLANK)] + [_row_step(i, f) for i in _INITIALS for f in (SOUND, CUT)]


def kind(role: str, fault: int) -> int:
    if fault in (BLANK, DUPLICATE):
        return 0
    i = role[:1] if role[:1] in ("s", "u", "a") else ""
    return 1 + 2 * _INITIALS.index(i) + (fault == CUT)


def _ranked(best: list) -> list:
    """(cost, key) by state -> (cost, rank of the key)."""
    order = {k: r for r, k in enumerate(sorted(x[1] for x in best if x is not None))}
    return [None if x is None else (x[0], order[x[1]]) for x in best]


def _forward(steps, start: list) -> list:
    """(cost, audit rank) of every state after ``steps``, from such a vector before them."""
    now = start
    for step in steps:
        best: list = [None] * STATES
        for p in range(STATES):
            if now[p] is None:
                continue
            c, r = now[p]
            for q in range(STATES):
                x = step[p][q]
                if x is not None:
                    new = (c + x[0], (r, x[1]))
                    if best[q] is None or new < best[q]:
                        best[q] = new
        now = _ranked(best)
    return now


def _backward(steps, end: list[int]) -> list[int]:
    """Cost of finishing from every state before ``steps``."""
    for step in reversed(steps):
        end = [min((x[0] + end[q] for q, x in enumerate(row) if x is not None), default=INF) for row in step]
    return end


def at(state: int) -> list:
    return [(0, 0) if s == state else None for s in range(STATES)]


def to(state: int) -> list[int]:
    return [0 if s == state else INF for s in range(STATES)]


#: Cost of ending after the last row in each state, with the rows inserted for it.
FINISH = [0, 2 * INSERT, INSERT, 0]


def crossings(steps: list, start: int, end: list[int]) -> list[int]:
    """States after each of ``steps``: cheapest, of these the ASCII-least audit."""
    out = [start] * len(steps)
    todo = [(0, len(steps), start, end)]
    while todo:
        lo, hi, s, e = todo.pop()
        if lo == hi:
            continue
        mid = (lo + hi + 1) // 2
        fore = _forward(steps[lo:mid], at(s))
        back = _backward(steps[mid:hi], e)
        out[mid - 1] = cross = min((f[0] + b, f[1], q) for q, (f, b) in enumerate(zip(fore, back)) if f is not None)[2]
        if mid - lo > 1:
            todo.append((lo, mid - 1, s, _backward(steps[mid - 1:mid], to(cross))))
        todo.append((mid, hi, cross, e))
    return out


def matrix(steps: list) -> list[list]:
    """(cost, audit rank) from each state before ``steps`` to each state after them."""
    return [_forward(steps, at(p)) for p in range(STATES)]


def solve(kinds: bytes, start: int = 0, end: int | None = None) -> tuple[int, list[str]]:
    """Cost and edits by row; without ``end`` the last entry holds the rows inserted at the end."""
    steps = [_KINDS[k] for k in kinds]
    states = crossings(steps, start, FINISH if end is None else to(end))
    cost, edits, p = 0, [], start
    for step, q in zip(steps, states):
        c, audit = step[p][q]
        cost, p = cost + c, q
        edits.append(audit)
    if end is None:
        cost += FINISH[p]
        edits.append("I" * (FINISH[p] // INSERT))
    return cost, edits


def _repaired(edits: list[str], roles: list[str], texts: list[str], start: int) -> list[str]:
    """The repaired rows as ``role:text``."""
    out, p = [], start
    for k, audit in enumerate(edits):
        for e in audit:
            if e == "D":
                continue
            if e == "K":
                out.append(f"{roles[k]}:{texts[k]}")
                p = _AFTER[roles[k][:1]][p]
            else:
                p = 3 if p == 2 else 2
                out.append(f"{_ROLE[p]}:{texts[k] if e == 'R' else ''}")
    return out


def audit_of(rows: list[tuple[str, str, int]]) -> tuple[int, str, list[str]]:
    """Cost, audit and repaired rows of one whole conversation of (role, text, fault) rows."""
    cost, edits = solve(bytes(kind(r, f) for r, _, f in rows))
    return cost, "".join(edits), _repaired(edits, [r for r, _, _ in rows], [t for _, t, _ in rows], 0)


# --- damage and faults ---------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the contract's damage; a null counts as one space."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                     F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    how = F.crc32(named.cast("binary")) % 20
    out = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.when(how == 4, "user").otherwise(role).alias("role"),
        F.when(how == 1, "").when(how == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"), how.alias(f"{P}how"))
    out = out.where(F.col(f"{P}how") != 0)
    return out.withColumn(f"{P}n", F.when(F.col(f"{P}how") == 3, 2).otherwise(1)).drop(f"{P}how")


def _fault(first: Column) -> Column:
    last = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    blank = ~F.col("text").rlike(f"[^{BLANKS}]")
    return (F.when(blank, BLANK).when(~first, DUPLICATE).when(~last.isin(".", "!", "?"), CUT).otherwise(SOUND)).cast("int")


def _judged(rows: DataFrame) -> DataFrame:
    """Every row with its fault; copies in one turn are counted first and dealt out again without their text."""
    digest = F.sha2("text", 256)
    once = materialised(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum(f"{P}n").cast("long").alias("n"))
                        .withColumn("d", digest))
    # role and text in more than one turn: only the first turn's row is no duplicate
    # (turn + 1 as two columns: a null turn is before all others)
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    again = (once.groupBy("conv_id", "role", "d").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("k"))
             .where("k > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("d").alias("e"), "first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("d") == F.col("e"))
    once = once.join(again, same, "left")
    earliest = F.col("first").isNull() | F.col("turn").eqNullSafe(F.col("first.turn"))
    rows = once.withColumn("fault", _fault(earliest)).drop("c", "r", "e", "first")
    # copies are dealt out in two steps, so that no array holds more than ROWS of them
    rows = rows.withColumn("block", F.explode(F.expr(f"sequence(0L, (n - 1) div {ROWS})")))
    rows = rows.withColumn("copy", F.explode(F.expr(f"sequence(block * {ROWS} + 1, least(n, block * {ROWS} + {ROWS}))")))
    copied = F.col("copy") > 1
    return rows.select(
        "conv_id", "turn", "role", "d", "copy", F.when(~copied, F.col("text")).otherwise("").alias("text"),
        F.when(copied & (F.col("fault") != BLANK), DUPLICATE).otherwise(F.col("fault")).alias("fault"))


# --- segments ------------------------------------------------------------------------

_SEGMENT = ("conv_id long, part int, seq int, turns array<long>, kinds binary, roles array<string>, texts array<string>, "
            "blank long, duplicate long, truncated long")


_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
          "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(n, _TYPES[t]) for n, t in (c.split() for c in schema.split(","))])


def packer(most: int = ROWS, chars_of: int = CHARS):
    """Sorted rows -> segments of at most so many rows; one segment is open at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        schema, part = _arrow(_SEGMENT), TaskContext.get().partitionId()
        conv, seq, rows, chars, full, held = None, 0, [], 0, [], 0

        def segment():
            faults = [r[3] for r in rows]
            return (conv, part, seq, [r[0] for r in rows], bytes(kind(r[1], r[3]) for r in rows), [r[1] for r in rows],
                    [r[2] if r[3] in (SOUND, CUT) else "" for r in rows], *(faults.count(f) for f in (BLANK, DUPLICATE, CUT)))

        def batch():
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in full], schema)
        for b in batches:
            for c, turn, role, text, fault in zip(*(b.column(k).to_pylist() for k in range(5))):
                if rows and (c != conv or len(rows) >= most or chars + len(text) > chars_of):
                    full.append(segment())
                    seq, rows, held, chars = seq + 1, [], held + chars, 0
                    if len(full) >= 512 or held > chars_of:
                        yield batch()
                        full, held = [], 0
                conv = c
                rows.append((turn, role, text, fault))
                chars += len(text)
        if rows:
            full.append(segment())
        if full:
            yield batch()
    return run


_pack = packer()


def segments(rows: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text, fault, copy) in order, packed; written once to the shared folder."""
    keys = ["conv_id", "turn", "role", "d", "copy"]
    spark = ready(rows.sparkSession)
    dealt = materialised(rows).repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys)
    return materialised(dealt.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text", "fault")
                        .mapInArrow(_pack, _SEGMENT))


def _facts(turns: list, roles: list[str]) -> dict:
    """What a stretch of a conversation tells about gaps and order; ``n_turns`` counts the last turn once."""
    known = [t for t in turns if t is not None]
    said = [r[:1] for r in roles]
    return {"illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(said, said[1:])),
            "low": known[0] if known else None, "high": known[-1] if known else None,
            "n_turns": sum(a != b for a, b in zip(known, known[1:])) + bool(known), "initial": said[0], "final": said[-1]}


_RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations of one segment: solved where they lie."""
    schema = _arrow(_RESULT)
    for b in batches:
        out = []
        for s in b.to_pylist():
            f = _facts(s["turns"], s["roles"])
            cost, edits = solve(s["kinds"])
            text = "\n".join(_repaired(edits, s["roles"], s["texts"], 0))
            out.append({"conv_id": s["conv_id"], "gaps": _gaps(f["low"], f["high"], f["n_turns"]),
                        "blank": s["blank"], "duplicate": s["duplicate"], "truncated": s["truncated"], "illegal": f["illegal"],
                        "cost": cost, "audit": "".join(edits), "repaired_sha256": hashlib.sha256(text.encode()).hexdigest()})
        yield pa.RecordBatch.from_pylist(out, schema)


def _gaps(low, high, n_turns: int) -> int:
    return 0 if low is None else high - low + 1 - n_turns


_SUMMARY = ("conv_id long, part int, seq int, blank long, duplicate long, truncated long, illegal long, low long, high long, "
            "n_turns long, initial string, final string, costs array<long>, ranks array<int>")


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of longer conversations: matrix of costs and audit ranks, and facts."""
    schema = _arrow(_SUMMARY)
    for b in batches:
        out = []
        for s in b.to_pylist():
            cells = [x for row in matrix([_KINDS[k] for k in s["kinds"]]) for x in row]
            out.append({**{k: s[k] for k in ("conv_id", "part", "seq", "blank", "duplicate", "truncated")}, **_facts(s["turns"], s["roles"]),
                        "costs": [None if x is None else x[0] for x in cells], "ranks": [None if x is None else x[1] for x in cells]})
        yield pa.RecordBatch.from_pylist(out, schema)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(is the first of its conversation, row) of a table sorted by conversation."""
    last: tuple = ()
    for b in batches:
        for r in b.to_pylist():
            yield (r["conv_id"],) != last, r
            last = (r["conv_id"],)


_PLACED = ("conv_id long, part int, seq int, start int, stop int, last boolean, gaps long, blank long, duplicate long, truncated long, "
           "illegal long, cost long")


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """States between the segments of a conversation, by the divide and conquer over their matrices."""
    schema = _arrow(_PLACED)

    def placed(group):
        steps = [[[None if g["costs"][4 * p + q] is None else (g["costs"][4 * p + q], g["ranks"][4 * p + q]) for q in range(STATES)]
                  for p in range(STATES)] for g in group]
        states = crossings(steps, 0, FINISH)
        cost = sum(step[p][q][0] for step, p, q in zip(steps, [0, *states], states)) + FINISH[states[-1]]
        seen = [(g["low"], g["high"]) for g in group if g["low"] is not None]
        n_turns = sum(g["n_turns"] for g in group) - sum(a[1] == b[0] for a, b in zip(seen, seen[1:]))
        illegal = sum(g["illegal"] for g in group) + sum(a["final"] + b["initial"] not in ("su", "ua", "au") for a, b in zip(group, group[1:]))
        facts = {"gaps": _gaps(seen[0][0] if seen else None, seen[-1][1] if seen else None, n_turns), "illegal": illegal, "cost": cost,
                 **{k: sum(g[k] for g in group) for k in ("blank", "duplicate", "truncated")}}
        rows = [{"conv_id": g["conv_id"], "part": g["part"], "seq": g["seq"], "start": p, "stop": q, "last": g is group[-1], **facts}
                for g, p, q in zip(group, [0, *states], states)]
        return pa.RecordBatch.from_pylist(rows, schema)
    group: list = []
    for new, r in _stretches(batches):
        if new and group:
            yield placed(group)
            group = []
        group.append(r)
    if group:
        yield placed(group)


_PIECE = _PLACED.replace("start int, stop int, last boolean", "k int, audit string, piece string")


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments with both states -> audit and repaired text, in pieces."""
    schema = _arrow(_PIECE)
    for b in batches:
        for s in b.to_pylist():
            _, edits = solve(s["kinds"], s["start"], s["stop"])
            if s["last"]:
                edits.append("I" * (FINISH[s["stop"]] // INSERT))
            lines, audit = _repaired(edits, s["roles"], s["texts"], s["start"]), "".join(edits)
            cut, size = [[]], 0
            for x in lines:
                if size > PIECE:
                    cut, size = [*cut, []], 0
                cut[-1].append(x)
                size += len(x)
            base = {n: s.get(n) for n in schema.names}
            yield pa.RecordBatch.from_pylist(
                [{**base, "k": k, "audit": "" if k else audit, "piece": "\n".join(c) if c else None} for k, c in enumerate(cut)], schema)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order -> one row per conversation; the repaired text streams through its hash."""
    schema = _arrow(_RESULT)
    row, sha, audit, any_ = None, None, [], False

    def done():
        return pa.RecordBatch.from_pylist([{**{n: row.get(n) for n in schema.names}, "audit": "".join(audit),
                                            "repaired_sha256": sha.hexdigest()}], schema)
    for new, r in _stretches(batches):
        if new:
            if row is not None:
                yield done()
            row, sha, audit, any_ = r, hashlib.sha256(), [], False
        audit.append(r["audit"])
        if r["piece"] is not None:
            if any_:
                sha.update(b"\n")
            sha.update(r["piece"].encode())
            any_ = True
    if row is not None:
        yield done()


def _pieces(segs: DataFrame) -> DataFrame:
    """Audit and repaired text of conversations of several segments, in pieces."""
    n = partitions(segs.sparkSession)
    met = (segs.mapInArrow(_summarise, _SUMMARY).repartition(n, "conv_id").sortWithinPartitions("conv_id", "part", "seq")
           .mapInArrow(_meet, _PLACED))
    met = met.withColumnsRenamed({c: f"{P}{c}" for c in ("conv_id", "part", "seq")})
    own = segs.select("conv_id", "part", "seq", "kinds", "roles", "texts")
    here = (F.col("conv_id").eqNullSafe(F.col(f"{P}conv_id")) & (F.col("part") == F.col(f"{P}part")) & (F.col("seq") == F.col(f"{P}seq")))
    return own.join(met, here).drop(f"{P}conv_id", f"{P}part", f"{P}seq").mapInArrow(_rebuilt, _PIECE)


def repaired(rows: DataFrame) -> DataFrame:
    """One row per conversation that ``rows`` (conv_id, turn, role, text, n copies) holds: counts, cost, audit, hash."""
    segs = segments(_judged(rows))
    n = partitions(segs.sparkSession)
    many = materialised(segs.groupBy("conv_id").count().where("count > 1").select(F.col("conv_id").alias(f"{P}c")))
    same = F.col("conv_id").eqNullSafe(F.col(f"{P}c"))
    short = segs.join(many, same, "left_anti").mapInArrow(_whole, _RESULT)
    if many.isEmpty():
        return short
    pieces = _pieces(materialised(segs.join(many, same, "left_semi")))
    long = (pieces.repartition(n, "conv_id").sortWithinPartitions("conv_id", "part", "seq", "k").mapInArrow(_joined, _RESULT))
    return short.unionByName(long)


def repaired_rows(rows: DataFrame) -> DataFrame:
    """The repaired conversations themselves: conv_id, part, seq, k (in this order) and ``role:text`` lines of every piece."""
    segs = segments(_judged(rows))
    met = _pieces(segs)
    return met.where("piece is not null").select("conv_id", "part", "seq", "k", F.col("piece").alias("lines"))


def repaired_damage(conversations: DataFrame) -> DataFrame:
    """The contract: damage, judge, repair; every conversation of the table has a row."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    found = repaired(damaged(rows))
    every = rows.select(F.col("conv_id").alias(f"{P}c")).distinct()
    out = every.join(found, F.col("conv_id").eqNullSafe(F.col(f"{P}c")), "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col(f"{P}c").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


# --- the same in SQL, row by row with whole audits ------------------------------------

ORACLE_SQL = r"""
WITH RECURSIVE
tab AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
        FROM range(256) g(i)),
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '') AS key FROM conversations),
crc AS (SELECT conv_id, turn, role, text,
               xor(list_reduce(list_prepend(4294967295, list_transform(key, lambda x: unicode(x)::BIGINT)),
                               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS how FROM named, tab),
hurt AS (SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
                CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                unnest(range(CASE how WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM crc),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS k,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
                   trim(text, E' \t\n\x0b\x0c\r') AS bare FROM hurt),
judged AS (SELECT *, CASE WHEN bare = '' THEN 1 WHEN seen > 1 THEN 2 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
                  left(role, 1) || lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS pair FROM ordered),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
                 count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
                 count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
ins(p, m, audit, lines) AS (VALUES (0, 0, '', []), (0, 2, 'I', ['user:']), (0, 3, 'II', ['user:', 'assistant:']), (1, 1, '', []), (1, 2, 'I', ['user:']),
    (1, 3, 'II', ['user:', 'assistant:']), (2, 2, '', []), (2, 3, 'I', ['assistant:']), (3, 3, '', []), (3, 2, 'I', ['user:'])),
after(m, initial, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
edits AS (SELECT j.conv_id, j.k, i.p, e.q, i.lines || e.lines AS lines, i.audit || e.op AS audit, 5 * length(i.audit) + e.cost AS cost
          FROM judged j, ins i, LATERAL (
              SELECT i.m AS q, 'D' AS op, 2 AS cost, []::VARCHAR[] AS lines
              UNION ALL SELECT a.q, 'K', CASE WHEN j.fault = 3 THEN 5 ELSE 0 END, [j.role || ':' || j.text]
                        FROM after a WHERE j.fault IN (0, 3) AND a.m = i.m AND a.initial = left(j.role, 1)
              UNION ALL SELECT a.q, 'R', CASE WHEN j.fault = 3 THEN 6 ELSE 1 END, [CASE a.q WHEN 2 THEN 'user:' ELSE 'assistant:' END || j.text]
                        FROM after a WHERE j.fault IN (0, 3) AND a.m = i.m AND a.initial IN ('u', 'a')) e),
path AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS k, 0 AS q, {'cost': 0, 'audit': '', 'lines': []::VARCHAR[]} AS best FROM judged
    UNION ALL
    SELECT p.conv_id, p.k + 1, e.q, min({'cost': (p.best.cost + e.cost)::INTEGER, 'audit': p.best.audit || e.audit, 'lines': p.best.lines || e.lines})
    FROM path p JOIN edits e ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND e.k = p.k + 1 AND e.p = p.q GROUP BY p.conv_id, p.k, e.q),
ends AS (SELECT p.conv_id, min({'cost': p.best.cost + 5 * length(i.audit), 'audit': p.best.audit || i.audit, 'lines': p.best.lines || i.lines}) AS best
         FROM path p JOIN (SELECT conv_id, max(k) AS k FROM judged GROUP BY conv_id) n ON n.conv_id IS NOT DISTINCT FROM p.conv_id AND n.k = p.k
         JOIN ins i ON i.p = p.q AND i.m IN (0, 3) GROUP BY p.conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit,
       sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM a.conv_id"""
