"""The scan against a computation in plain Python."""

import math
import re
from collections import Counter

import pytest
from velomart.llm import licenses as L

IDF, UNKNOWN = L._idf()


def vector(text):
    return {t: (1 + math.log(k)) * IDF.get(t, UNKNOWN) for t, k in Counter(re.findall(L.TERM, text.lower())).items()}


def cosine(a, b):
    dot = sum(w * b.get(t, 0) for t, w in a.items())
    return dot / math.sqrt(sum(w * w for w in a.values()) * sum(w * w for w in b.values())) if dot else 0.0


def own(path, text):
    named = bool(path and re.search(L.LICENSE_FILE, path.rpartition("/")[2]))
    if not text or not re.search(L.TRIGGER, text):
        return named, None
    units = [u for u in re.split(L.SENTENCE_END, text) if re.search(L.TRIGGER, u)] + ([text] if named else [])
    found = [(round(cosine(vector(u), vector(t)), 9), -i, licence) for u in units for i, (licence, t) in enumerate(L.TEMPLATES)]
    best = max(found, default=None)
    return named, best if best and best[0] >= L.THRESHOLD else None


def brute(files):
    found = [own(p, t) for p, t in files]
    holders = {}
    for (path, _), (named, best) in zip(files, found, strict=True):
        if named and best and path is not None:
            holders.setdefault(path.rpartition("/")[0], []).append(best)
    out = []
    for (path, _), (named, best) in zip(files, found, strict=True):
        if best:
            out.append((path, best[2], pytest.approx(best[0]), "file" if named else "header", None))
            continue
        at, row = path.rpartition("/")[0] if path is not None else None, (path, None, None, None, None)
        while at is not None:
            if at in holders:
                row = (path, " AND ".join(sorted({b[2] for b in holders[at]})), pytest.approx(max(b[0] for b in holders[at])), "inherited", at)
                break
            at = at.rpartition("/")[0] if at else None
        out.append(row)
    return out


FILES = [
    ("LICENSE", "Licensed under the Apache License, Version 2.0."),
    ("main.c", "no header here"),
    ("lib/LICENSE.txt", "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("lib/COPYING", "This work is licensed under the GNU General Public License, version 3."),
    ("lib/a/b/c.py", "# Released under the MIT License.\ncode"),
    ("lib/a/b/d.py", "code"),
    ("lib/a/LICENSE", "an unrelated text about a licence of poets and their birds in the sky"),
    ("lib/a/e.py", None),
    ("other/x.py", ""),
    ("other/licenses.py", "license = None"),
    (None, "Licensed under CC BY 4.0."),
    (None, "nothing"),
    ("other/x.py", ""),
    ("z", "All rights reserved. Licensed under CC BY-NC 4.0! copyright " + "word " * 3000),
]


def test_headers_files_and_inheritance(spark):
    files = spark.createDataFrame([(p, t, "q", 1.0) for p, t in FILES], "path string, text string, dir string, score double")
    got = [tuple(r) for r in L.scan(files).collect()]
    order = lambda r: tuple((x is not None, str(x) if i != 2 else "") for i, x in enumerate(r))
    want = brute(FILES)
    assert sorted(got, key=order) == sorted(want, key=order)
    assert {r[3] for r in got} == {"file", "header", "inherited", None}
    assert L.scan(files.limit(0)).count() == 0


def test_documents(spark, odd_docs):
    files = odd_docs.select("doc_id", L.document_path().alias("path"), "text")
    got = L.scan(files, extra={"doc_id": files.doc_id}).collect()
    assert len(got) == odd_docs.count()
    assert {r.license for r in got if r.doc_id == 13} == {"MIT"}


GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at"""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are
met:

1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer."""
BSD3 = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
HEADERS = [
    *((f"SPDX-License-Identifier: {tag}", name) for name, tag in L.SPDX),
    ("GNU GENERAL PUBLIC LICENSE", "GPL"),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007", "GPL-3.0"),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991", "GPL-2.0"),
    ("Mozilla Public License Version 2.0", "MPL-2.0"),
    ("Apache License\nVersion 2.0, January 2004", "Apache-2.0"),
    ("MIT License", "MIT"),
    (GPL, "GPL-3.0"),
    (GPL.replace("software:", "software;").replace("version 3", "version 2"), "GPL-2.0"),
    (GPL.replace("GNU General", "GNU Affero General"), "AGPL-3.0"),
    (GPL.replace("GNU General", "GNU Lesser General").replace("program", "library"), "LGPL-3.0"),
    (MIT, "MIT"),
    (APACHE, "Apache-2.0"),
    (BSD2, "BSD-2-Clause"),
    (BSD2 + "\n\n" + BSD3, "BSD-3-Clause"),
]


def test_usual_headers(spark):
    """Alone and as comments, with code behind them at once."""
    rows, want = [], {}
    for i, (text, name) in enumerate(HEADERS):
        for form, mark in (("text", ""), ("hash", "# "), ("star", " * "), ("crlf", "// ")):
            marked = "\n".join((mark + line).rstrip() for line in text.split("\n")) + ("\nimport os\nx = 1\n" if mark else "")
            rows.append((f"{form}/{i}.c", marked.replace("\n", "\r\n") if form == "crlf" else marked))
            want[rows[-1][0]] = name
    got = {r.path: r.license for r in L.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert {p: (got[p], n) for p, n in want.items() if got[p] != n} == {}
