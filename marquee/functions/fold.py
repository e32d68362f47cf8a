"""ASCII folding equal to ``NFKD`` followed by dropping non-ASCII.

Spark has no NFKD. Folding is per code point (decomposition never moves an
ASCII character, and reordering only permutes combining marks, which are
dropped), so it is a character table derived once from ``unicodedata``:

* a code point whose folded form is one ASCII character -> ``translate``
  (a hash lookup, codegen'd);
* a code point that folds to several characters (``½`` -> ``1/2``) -> a
  map lookup, evaluated only for rows that contain one;
* everything else outside ASCII -> deleted by a regex;
* rows without any non-ASCII character skip all of it.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

_NON_ASCII = r"[^\x{00}-\x{7f}]"
_ASCII_RUN = r"[\x{00}-\x{7f}]+"


@functools.lru_cache(maxsize=1)
def fold_tables() -> tuple[str, str, dict[str, str]]:
    """(single-char sources, their ASCII targets, multi-char expansions)."""
    src, dst, multi = [], [], {}
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        folded = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii")
        if not folded:
            continue
        if len(folded) == 1:
            src.append(ch)
            dst.append(folded)
        else:
            multi[ch] = folded
    return "".join(src), "".join(dst), multi


def _class_of(chars) -> str:
    """Character class of sorted characters, neighbours joined to ranges."""
    runs: list[list[int]] = []
    for cp in map(ord, chars):
        if runs and cp == runs[-1][1] + 1:
            runs[-1][1] = cp
        else:
            runs.append([cp, cp])
    return "[" + "".join(f"\\x{{{a:x}}}" + (f"-\\x{{{b:x}}}" if b > a else "") for a, b in runs) + "]"


@functools.lru_cache(maxsize=1)
def multi_class() -> str:
    return _class_of(sorted(fold_tables()[2]))


def ascii_fold(c: Column) -> Column:
    src, dst, multi = fold_tables()
    mapping = F.create_map(*[F.lit(x) for kv in sorted(multi.items()) for x in kv])
    # the class is long: it is tried on the few characters outside ASCII only
    expanded = F.when(
        F.regexp_replace(c, _ASCII_RUN, "").rlike(multi_class()),
        F.array_join(
            F.transform(F.regexp_extract_all(c, F.lit("(?s)."), 0),
                        lambda ch: F.coalesce(F.try_element_at(mapping, ch), ch)),
            ""),
    ).otherwise(c)
    folded = F.regexp_replace(F.translate(expanded, src, dst), _NON_ASCII, "")
    # ASCII-only text (the common case) is returned as is without table lookups
    return F.when(c.rlike(_NON_ASCII), folded).otherwise(c)


def python_fold(s: str) -> str:
    """Plain-Python statement of the same rule (used by tests)."""
    return unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode("ascii")
