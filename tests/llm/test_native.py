"""URL rules and licence scans against their SQL and plain Python."""

import duckdb
import pytest
from conftest_path import SMALL

from marquee.llm import licenses, url_filters
from marquee.llm.catalog import ORACLE_SQL, QUERIES


def oracle(folder, name):
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        c.sql(f"create view {t} as select * from '{folder}/{t}.parquet'")
    rel = c.sql(ORACLE_SQL[name])
    return rel.columns, rel.fetchall()


@pytest.mark.parametrize("where", ["odd", "small", "empty"])
@pytest.mark.parametrize("name", ["op2_url_filters", "op10_license_scan"])
def test_matches_sql(spark, odd_dir, empty_dir, where, name):
    folder = {"odd": odd_dir, "small": SMALL, "empty": empty_dir}[where]
    cols, expected = oracle(folder, name)
    got = [tuple(r[c] for c in cols) for r in QUERIES[name](spark, folder).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def plain(url, rules):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        rest = rest[:min([i for i in (rest.find("?"), rest.find("#")) if i >= 0], default=len(rest))]
        host, path = (rest[:rest.find("/")], rest[rest.find("/"):]) if "/" in rest else (rest, "")
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_nested_rules(spark):
    rules = [("allow", "com", "/"), ("block", "a.com", "/"), ("allow", "b.a.com", "/x/"), ("block", "b.a.com", "/x/y/"), ("block", "c.b.a.com", ""),
             ("allow", "d.com", "/"), ("block", "co", "/"), ("block", "uk", "/"), ("allow", "co.uk", "/"), ("block", "aa.com", "/p")]
    urls = [f"http://{h}{p}" for h in ("com", "a.com", "z.a.com", "b.a.com", "c.b.a.com", "q.c.b.a.com", "d.com", "ab.com", "aa.com", "a.co", "x.co.uk", "uk", "a", "")
            for p in ("", "/", "/x/", "/x/y/z", "/p?x", "/pq#/")] + [None, "a.com/x"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in
           url_filters.judged(pages, url_filters.rules_table(spark, rules), salts=3).collect()}
    assert got == {i: plain(u, rules) for i, u in enumerate(urls)}
    assert len(rules) > 0 and url_filters.judged(pages, url_filters.rules_table(spark, []) if False else spark.createDataFrame(
        [], "verdict string, host string, path string")).where("verdict <> 'allow'").count() == 0


def test_rules_use_identifiers_up(spark):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this.\n"
           "The above copyright notice and this permission notice shall be included in all copies.\n"
           "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS.")
    texts = [mit, "Some words. Released under the MIT License.\nAll rights reserved.", None, "", "licensed under the mit licence", mit + "\n" + mit]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: (r[licenses._IDS], r[licenses.FOUND]) for r in licenses.scan(df).collect()}
    assert got[0] == (["MITperm", "MITnotice", "ASIS"], ["MIT"])
    assert got[1] == (["MITgrant", "AllRights"], ["MIT", "proprietary"])
    assert got[2] == got[3] == got[4] == ([], [])
    assert got[5][1] == ["MIT"] and len(got[5][0]) == 6


GPL = ("    This program is free software: you can redistribute it and/or modify\n    it under the terms of the GNU General Public License as published by\n"
       "    the Free Software Foundation, either version 3 of the License, or\n    (at your option) any later version.\n\n"
       "    This program is distributed in the hope that it will be useful,\n    but WITHOUT ANY WARRANTY; without even the implied warranty of\n"
       "    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\n    GNU General Public License for more details.\n")
LGPL = ("/* This library is free software; you can redistribute it and/or\n * modify it under the terms of the GNU Lesser General Public\n"
        " * License as published by the Free Software Foundation; either\n * version 2.1 of the License, or (at your option) any later version.\n */")
HEADERS = [
    ("# Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in compliance with the License.\n"
     "# You may obtain a copy of the License at\n#\n#     http://www.apache.org/licenses/LICENSE-2.0\n#\n"
     "# Unless required by applicable law or agreed to in writing, software\n# distributed under the License is distributed on an \"AS IS\" BASIS,\n",
     ["Apache-2.0"]),
    (GPL, ["GPL-3.0"]),
    (GPL.replace("software: you", "software; you").replace(", either version 3", "; either version 2"), ["GPL-2.0"]),
    (GPL.replace("General Public", "Affero General Public"), ["AGPL-3.0"]),
    (LGPL, ["LGPL-2.1"]),
    (LGPL.replace("2.1", "3"), ["LGPL-3.0"]),
    ("// This program is free software; you can redistribute it and/or modify it\n// under the terms of the GNU General Public License version 2 as\n"
     "// published by the Free Software Foundation.\n", ["GPL-2.0"]),
    ("Copyright (c) 2020, A. Person\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without\n"
     "modification, are permitted provided that the following conditions are met:\n", ["BSD"]),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\n"
     "in the Software without restriction, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\n"
     "copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED.\n", ["MIT"]),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\n"
     "file, You can obtain one at https://mozilla.org/MPL/2.0/.", ["MPL-2.0"]),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\n"
     "copyright notice and this permission notice appear in all copies.\n", ["ISC"]),
    ("This is free and unencumbered software released into the public domain.", ["Unlicense"]),
    ("## License\n\nThis project is licensed under the MIT License - see the LICENSE file.", ["MIT"]),
    ("It is distributed under the terms of the GNU GPL v3.", ["GPL-3.0"]),
    ("Text available under the Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0"]),
    ("// SPDX-License-Identifier: (MIT OR Apache-2.0)\nint x;", ["Apache-2.0", "MIT"]),
    ("/* SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0 */", ["GPL-2.0"]),
    ("# SPDX-License-Identifier: BSD-3-Clause\n", ["BSD"]), ("-- SPDX-License-Identifier: ISC", ["ISC"]),
    ("# SPDX-License-Identifier: MPL-2.0\n", ["MPL-2.0"]), ("# SPDX-License-Identifier: LGPL-3.0-only", ["LGPL-3.0"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]),
    ("It was released under the.\n\nMIT License is a name.", []), ("Unlicensed under the MIT licenses", []), ("licensed under the Apache License, Version 2.5", []),
]


def test_verbatim_headers(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(HEADERS)], "doc_id long, text string")
    got = {r["doc_id"]: r[licenses.FOUND] for r in licenses.scan(df).collect()}
    assert {i: got[i] for i in got} == {i: want for i, (_, want) in enumerate(HEADERS)}
