"""Licence scans by known phrases, in DataFrame operations only.

Every character but ASCII letters, digits and everything beyond ASCII counts
as space, so line ends of wrapped text and marks of comments join what they
cut. A sentence ends at ``.``, ``!`` or ``?`` before white space and at a line
without letters or digits. The phrases of known licences (grants, parts of
the standard headers, SPDX lines) are looked up anywhere in a sentence, upper
and lower case alike, the longest of those that start at a word; a phrase may
go on behind a sentence's end where its licence does ("v. 2.0"). The
identifiers of a document, in text order, are then matched against the
licence rules from the first to the last: a rule is a sequence of identifiers
that must occur next to each other; a match uses its identifiers up, so a
later, more general rule cannot claim them again.

Phrases and rules are bounded parameters, part of the plan; the work is row
by row inside one stage, without shuffle, so one source or group of copies
with a third of all rows is spread as the files are. Whole texts are read.

``oracle_sql`` is the older scan with the phrases of the test tables only
(``SENTENCES``, ``RULES``), whole sentences, cut at each line end: on texts
that hold no others both give the same rows, elsewhere it finds less.

Defined cases: null and empty texts have no phrases and no licence; repeated
phrases count each time; licences that are not in the table give nothing;
"or any later version" counts as the version named; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import P

#: Fixed values of the SQL: normalised sentences (regular expressions over the whole sentence) and their identifiers.
SENTENCES = [
    ("MITgrant", r"released under the mit license"),
    ("MITgrant", r"licensed under the mit license"),
    ("MITperm", r"permission is hereby granted free of charge to any person obtaining a copy.*"),
    ("MITnotice", r"the above copyright notice and this permission notice shall be included in all copies.*"),
    ("ASIS", r"the software is provided as is without warranty of any kind.*"),
    ("Apache2grant", r"licensed under the apache license version 2 0"),
    ("Apache2may", r"you may not use this file except in compliance with the license"),
    ("Apache2copy", r"you may obtain a copy of the license at.*"),
    ("GPL3grant", r"this (work|program|file|software) is licensed under the gnu general public license version 3"),
    ("GPL2grant", r"this (work|program|file|software) is licensed under the gnu general public license version 2"),
    ("GPLfree", r"this program is free software you can redistribute it and or modify it.*"),
    ("CCBYNC4", r"licensed under cc by nc 4 0"),
    ("CCBYSA4", r"licensed under cc by sa 4 0"),
    ("CCBY4", r"licensed under cc by 4 0"),
    ("BSDredist", r"redistribution and use in source and binary forms with or without modification are permitted.*"),
    ("AllRights", r"all rights reserved"),
]
#: Fixed values of the SQL: licence rules in order of use: identifiers next to each other, name of the licence.
RULES = [
    (("MITperm", "MITnotice", "ASIS"), "MIT"),
    (("Apache2grant", "Apache2may", "Apache2copy"), "Apache-2.0"),
    (("GPLfree", "GPL3grant"), "GPL-3.0"),
    (("MITgrant",), "MIT"),
    (("MITperm",), "MIT"),
    (("Apache2grant",), "Apache-2.0"),
    (("GPL3grant",), "GPL-3.0"),
    (("GPL2grant",), "GPL-2.0"),
    (("CCBYNC4",), "CC-BY-NC-4.0"),
    (("CCBYSA4",), "CC-BY-SA-4.0"),
    (("CCBY4",), "CC-BY-4.0"),
    (("BSDredist",), "BSD"),
    (("GPLfree",), "GPL"),
    (("AllRights",), "proprietary"),
]
#: The end of a sentence in normalised text; allowed inside a phrase where it is written as ``%``.
END = "\x01"
_GRANT = r"(?:released|licensed|distributed|available|provided|published|redistributed) under (?:the )?(?:(?:terms(?: and conditions)?|conditions) of (?:the )?)?"
_V = r"(?:version |v(?:er)?%? ?)?"


def _gnu(kind: str, short: str, version: str) -> str:
    """A GNU licence by name and version."""
    return rf"(?:(?:the )?gnu {kind}general public license (?:{short} )?{_V}|(?:gnu )?{short} ?{_V}){version}(?! \d)"


def _free(kind: str, version: str) -> str:
    """The header of a GNU licence by version."""
    name, by = f"gnu {kind}general public license", "as published by the free software foundation"
    return (r"this (?:program|library|file|software|work|package|code) is free software you can redistribute it and or modify it under the terms of "
            rf"(?:{_V}{version} of the {name}|the {name} {_V}{version} {by}|the {name} {by} (?:either )?{_V}{version}(?! \d))")


#: Phrases (regular expressions over normalised words) and their identifiers; the first that fits counts.
PHRASES = [
    ("MITgrant", _GRANT + r"(?:mit(?: x11| expat)?|x11|expat) license"),
    ("MITperm", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("MITnotice", r"the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies"),
    ("ASIS", r"the software is provided as is without warranty of any kind"),
    ("Apache2grant", _GRANT + rf"apache(?: software)?(?: license)?(?: {_V})? ?2(?: 0)?(?: license)?(?! \d)"),
    ("Apache2may", r"you may not use this file except in compliance with the license"),
    ("Apache2copy", r"you may obtain a copy of the license at"),
    ("AGPL3grant", _GRANT + _gnu("affero ", "agpl", "3(?: 0)?")),
    ("LGPL21grant", _GRANT + _gnu("lesser ", "lgpl", "2 1")),
    ("LGPL3grant", _GRANT + _gnu("lesser ", "lgpl", "3(?: 0)?")),
    ("GPL3grant", _GRANT + _gnu("", "gpl", "3(?: 0)?")),
    ("GPL2grant", _GRANT + _gnu("", "gpl", "2(?: 0)?")),
    ("AGPL3free", _free("affero ", "3")),
    ("LGPL21free", _free("lesser ", "2 1")),
    ("LGPL3free", _free("lesser ", "3")),
    ("GPL3free", _free("", "3")),
    ("GPL2free", _free("", "2")),
    ("GPLfree", r"this (?:program|file|software|work|package|code) is free software you can redistribute it and or modify it(?! under the terms of the gnu (?:lesser|library|affero))"),
    ("LGPLfree", r"this (?:program|library|file|software|work|package|code) is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library)"),
    ("MPL2free", r"subject to the terms of the mozilla public license (?:version |v%? ?)2 0"),
    ("MPL2grant", _GRANT + rf"(?:mozilla public license {_V}|mpl ?{_V})2(?: 0)?"),
    ("ISCgrant", _GRANT + r"isc license"),
    ("ISCperm", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that"),
    ("CCBYNCSA4", _GRANT + r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike) 4 0"),
    ("CCBYNCND4", _GRANT + r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s) 4 0"),
    ("CCBYNC4", _GRANT + r"(?:a )?(?:cc by nc|creative commons attribution non ?commercial) 4 0"),
    ("CCBYSA4", _GRANT + r"(?:a )?(?:cc by sa|creative commons attribution share ?alike) 4 0"),
    ("CCBYND4", _GRANT + r"(?:a )?(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s) 4 0"),
    ("CCBY4", _GRANT + r"(?:a )?(?:cc by|creative commons attribution) 4 0"),
    ("CC0", _GRANT + r"(?:cc0|creative commons zero)(?: 1 0)?"),
    ("Unlicense", r"this is free and unencumbered software released into the public domain"),
    ("BSDgrant", _GRANT + r"(?:(?:2|3|4|two|three|four|new|modified|simplified|revised)(?: clause)? )?bsd(?: [234] clause)?(?: style)? license"),
    ("BSDredist", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("AllRights", r"all rights reserved"),
]
#: Normalised SPDX identifiers ('-only', '-or-later' and '+' left out) and names of licences; by 'or' and 'and' several in a line.
SPDX = {
    "mit": "MIT", "apache 2 0": "Apache-2.0", "gpl 2 0": "GPL-2.0", "gpl 3 0": "GPL-3.0", "lgpl 2 1": "LGPL-2.1", "lgpl 3 0": "LGPL-3.0",
    "agpl 3 0": "AGPL-3.0", "mpl 2 0": "MPL-2.0", "isc": "ISC", "bsd 2 clause": "BSD", "bsd 3 clause": "BSD", "0bsd": "0BSD", "unlicense": "Unlicense",
    "cc0 1 0": "CC0-1.0", "cc by 4 0": "CC-BY-4.0", "cc by sa 4 0": "CC-BY-SA-4.0", "cc by nc 4 0": "CC-BY-NC-4.0", "cc by nd 4 0": "CC-BY-ND-4.0",
    "cc by nc sa 4 0": "CC-BY-NC-SA-4.0", "cc by nc nd 4 0": "CC-BY-NC-ND-4.0", "bsl 1 0": "BSL-1.0", "zlib": "Zlib", "epl 2 0": "EPL-2.0"}
#: Licence rules over the identifiers of ``PHRASES``, in order of use.
LICENCES = [
    (("MITperm", "MITnotice", "ASIS"), "MIT"),
    (("Apache2grant", "Apache2may", "Apache2copy"), "Apache-2.0"),
    (("GPLfree", "GPL3grant"), "GPL-3.0"),
    (("GPLfree", "GPL2grant"), "GPL-2.0"),
    (("AllRights", "BSDredist"), "BSD"),
    *(((ident,), name) for ident, name in (
        ("MITgrant", "MIT"), ("MITperm", "MIT"), ("Apache2grant", "Apache-2.0"), ("AGPL3grant", "AGPL-3.0"), ("AGPL3free", "AGPL-3.0"),
        ("LGPL21grant", "LGPL-2.1"), ("LGPL21free", "LGPL-2.1"), ("LGPL3grant", "LGPL-3.0"), ("LGPL3free", "LGPL-3.0"), ("LGPLfree", "LGPL"),
        ("GPL3grant", "GPL-3.0"), ("GPL3free", "GPL-3.0"), ("GPL2grant", "GPL-2.0"), ("GPL2free", "GPL-2.0"), ("MPL2free", "MPL-2.0"),
        ("MPL2grant", "MPL-2.0"), ("ISCgrant", "ISC"), ("ISCperm", "ISC"), ("CCBYNCSA4", "CC-BY-NC-SA-4.0"), ("CCBYNCND4", "CC-BY-NC-ND-4.0"),
        ("CCBYNC4", "CC-BY-NC-4.0"), ("CCBYSA4", "CC-BY-SA-4.0"), ("CCBYND4", "CC-BY-ND-4.0"), ("CCBY4", "CC-BY-4.0"), ("CC0", "CC0-1.0"),
        ("Unlicense", "Unlicense"), ("BSDgrant", "BSD"), ("BSDredist", "BSD"), ("GPLfree", "GPL"))),
    *(((f"SPDX:{name}",), name) for name in dict.fromkeys(SPDX.values())),
    (("AllRights",), "proprietary"),
]
_IDS, FOUND = f"{P}ids", f"{P}licences"
_LINE = "spdx license identifier "
_EDGE = f"[^ {END}]"


def _spdx() -> str:
    one = rf"(?:{'|'.join(sorted(SPDX, key=len, reverse=True))})(?: only| or later)?(?: with [a-z0-9 ]+? exception(?: \d \d)?)?"
    return rf"{_LINE}{one}(?: (?:or|and) {one})*"


def _known(phrase: Column, table) -> Column:
    """Identifiers of a phrase found: one, or as many as its SPDX line names."""
    one = F.lit("")
    for ident, rx in reversed(table):
        one = F.when(phrase.rlike(f"^(?:{rx.replace('%', END)})$"), F.lit(ident)).otherwise(one)
    names = F.create_map(*[F.lit(x) for key, name in SPDX.items() for x in (key, f"SPDX:{name}")])
    listed = F.split(F.regexp_replace(phrase, f"^{_LINE}", ""), " (?:or(?! later)|and) ")
    listed = F.transform(listed, lambda x: names[F.regexp_replace(x, "(?: only| or later)?(?: with .*)?$", "")])
    return F.when(phrase.startswith(_LINE), listed).otherwise(F.array(one))


def sentence_ids(text: Column, table=PHRASES) -> Column:
    """Identifiers of the known phrases of a text, in order."""
    word = r"A-Za-z0-9\x{80}-\x{10FFFF}"
    ended = F.regexp_replace(F.coalesce(text, F.lit("")), rf"""[.!?](?=["')\]]*\s)|\n[^{word}]*\n""", END)
    plain = F.regexp_replace(ended, f"[^{word}{END}]+", " ")
    any_of = "|".join([*(rx.replace("%", END) for _, rx in table), _spdx()])
    found = F.regexp_extract_all(plain, F.lit(f"(?i)(?<!{_EDGE})(?:{any_of})(?!{_EDGE})"), F.lit(0))
    lower = "abcdefghijklmnopqrstuvwxyz"
    return F.flatten(F.transform(found, lambda x: _known(F.translate(x, lower.upper(), lower), table)))


def scan(docs: DataFrame, text_col: str = "text", table=PHRASES, rules=LICENCES) -> DataFrame:
    """``docs`` with ``__q_ids`` (identifier sequence) and ``__q_licences`` (licences found, sorted, distinct)."""
    out = docs.withColumn(_IDS, sentence_ids(F.col(text_col), table))
    line = F.concat(F.lit(" "), F.array_join(_IDS, "  "), F.lit(" "))
    # a rule that matches uses its identifiers up: they are blanked before the next rule looks
    state = F.struct(line.alias("line"), F.expr("cast(array() as array<string>)").alias("found"))
    table_of_rules = F.array(*[F.struct(F.lit(f" {'  '.join(seq)} ").alias("want"), F.lit(name).alias("name")) for seq, name in rules])
    state = F.aggregate(table_of_rules, state, lambda s, r: F.struct(
        F.replace(s["line"], r["want"], F.lit(" - ")).alias("line"),
        F.when(F.contains(s["line"], r["want"]), F.array_union(s["found"], F.array(r["name"]))).otherwise(s["found"]).alias("found")))
    return out.withColumn(FOUND, F.array_sort(state["found"]))


def oracle_sql(table=SENTENCES, rules=RULES) -> str:
    """The older scan of the test tables' phrases as DuckDB SQL over ``documents``; equal on texts without others."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    known = " ".join(f"WHEN regexp_full_match(s, {q(rx)}) THEN {q(ident)}" for ident, rx in table)
    sql = (
        "WITH p AS (SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '([.!?;:])[ \\t\\r]', '\\1' || chr(10), 'g'), chr(10)) AS ps "
        "FROM documents), n AS (SELECT doc_id, list_transform(ps, lambda s: trim(regexp_replace(translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
        "'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9\\x{80}-\\x{10FFFF}]+', ' ', 'g'))) AS ns FROM p), "
        f"i AS (SELECT doc_id, list_filter(list_transform(ns, lambda s: CASE {known} ELSE '' END), lambda s: s <> '') AS ids FROM n), "
        "r0 AS (SELECT doc_id, ids, ' ' || coalesce(array_to_string(ids, '  '), '') || ' ' AS line, CAST([] AS VARCHAR[]) AS found FROM i)")
    for k, (seq, name) in enumerate(rules, 1):
        want = q(f" {'  '.join(seq)} ")
        sql += (f", r{k} AS (SELECT doc_id, ids, replace(line, {want}, ' - ') AS line, "
                f"CASE WHEN contains(line, {want}) THEN list_append(found, {q(name)}) ELSE found END AS found FROM r{k - 1})")
    return sql + (" SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences, coalesce(array_to_string(ids, ' '), '') AS sentence_ids, "
                  "CAST(len(list_distinct(found)) AS BIGINT) AS n_licences, "
                  f"coalesce(array_to_string(list_sort(list_distinct(found)), ','), '') AS licences FROM r{len(rules)}")
