"""License scan: TF-IDF cosine to templates, then inheritance along directories.

A file's own licence comes from its headers: lines and sentences that speak of a licence,
each a sparse TF-IDF vector that is compared with the templates' vectors by a join on
terms.  A sentence may run over several lines, up to its end or a blank line (comment
marks alone are blank), and a line is also taken with the next.  A licence file (by its name) is also compared as a whole.  A file without a licence of its
own inherits from the nearest directory above it that holds a licence file.

Sentences repeat, so each distinct one is scored once; inheritance is found once per
directory, by a join of its ancestors with the directories of licence files, so neither a
frequent sentence nor a directory with a third of all files makes a large group.

Inverse document frequencies are those of the templates; a term that no template has
weighs most.  All of it is DataFrame operations; the only broadcast table is the
templates' (a literal).

Defined cases: a null or empty text has no licence of its own; a null path has no
directory and inherits nothing; among equal scores the template listed first wins; a
directory whose licence files differ passes on all their licences, sorted and joined by
`` AND ``; equal rows get equal results; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, row_key
from .sharding import _table

THRESHOLD = 0.6

#: SPDX identifiers, which are one term each, and the names used here.
SPDX = [
    *((name, name + end) for name in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for end in ("", "-only", "-or-later")),
    *((name, name) for name in ("MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "ISC", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0")),
    ("Apache-2.0 OR MIT", "Apache-2.0 OR MIT"),
]
#: Identifiers of licences and the sentences by which they are known.
TEMPLATES = [
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT license"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, either version 3 of the License, or any later version"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License, either version 2 of the License"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    # Before the sentence that both BSD texts have, so that it wins a tie with it.
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights; CC0 1.0 Universal public domain dedication"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("Proprietary", "Copyright. All rights reserved"),
    # Titles.
    ("MIT", "The MIT License (MIT)"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("GPL", "GNU General Public License"),  # names no version
    ("LGPL", "GNU Lesser General Public License"),
    ("AGPL", "GNU Affero General Public License"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("ISC", "ISC License"),
    # Whole sentences of headers.
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    *((name, f"{work} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by the Free Software Foundation, {terms}")
      for name, work, kind, version in (("GPL-3.0", "This program", "", "3"), ("GPL-2.0", "This program", "", "2"), ("LGPL-3.0", "This library", "Lesser ", "3"), ("LGPL-2.1", "This library", "Lesser ", "2.1"), ("AGPL-3.0", "This program", "Affero ", "3"))
      for terms in (f"either version {version} of the License, or (at your option) any later version", f"version {version} of the License")),
    *((name, f"SPDX-License-Identifier: {tag}") for name, tag in SPDX),
]
#: What a sentence about a licence holds, and names of licence files.
TRIGGER = r"(?i)licen[cs]|copyright|spdx-|public domain|rights reserved|hereby granted|redistribution and use"
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|notice|unlicense)([._-].*)?$"
SENTENCE_END = r"[.!?;:]*[\n\r]+|[.!?]+[ \t]+"
#: Ends of sentences that run over lines: a full stop before space, or a line without letters and digits.
WRAPPED_END = r"[.!?]+\s+|(?:\r\n?+|\n)[^a-zA-Z0-9\x80-\x{10FFFF}\n\r]*(?:\r\n?+|\n)\s*"
LINE_END = r"\r\n?+|\n"
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"


def _idf() -> tuple[dict[str, float], float]:
    found = Counter(t for _, text in TEMPLATES for t in set(re.findall(TERM, text.lower())))
    n = len(TEMPLATES)
    return {t: math.log((1 + n) / (1 + k)) + 1 for t, k in found.items()}, math.log(1 + n) + 1


def template_vectors() -> list[tuple[str, int, str, float, float]]:
    """(term, template, licence, weight in the unit vector, idf); the product of the
    number of templates and their terms bounds it."""
    idf, _ = _idf()
    out = []
    for i, (licence, text) in enumerate(TEMPLATES):
        weights = {t: (1 + math.log(k)) * idf[t] for t, k in Counter(re.findall(TERM, text.lower())).items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        out += [(t, i, licence, w / norm, idf[t]) for t, w in sorted(weights.items())]
    return out


def score_units(units: DataFrame) -> DataFrame:
    """Of distinct (uid, unit): uid, score, licence, template of the best template that
    reaches the threshold."""
    spark = units.sparkSession
    vectors = template_vectors()
    _, unknown = _idf()
    weights = F.broadcast(_table(spark, vectors, "term string, template int, licence string, weight double, idf double"))
    idf = F.broadcast(_table(spark, sorted({(v[0], v[4]) for v in vectors}), "term string, idf double"))
    terms = units.select("uid", F.explode(F.regexp_extract_all(F.lower("unit"), F.lit(TERM), F.lit(0))).alias("term")).groupBy("uid", "term").agg(F.count("*").alias("k"))
    weighed = terms.join(idf, "term", "left").select("uid", "term", ((1 + F.log(F.col("k").cast("double"))) * F.coalesce("idf", F.lit(unknown))).alias("w"))
    norms = weighed.groupBy("uid").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighed.join(weights.drop("idf"), "term").groupBy("uid", "template", "licence").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    scored = dots.join(norms, "uid").select("uid", "template", "licence", F.round(F.col("dot") / F.col("norm"), 9).alias("score")).where(F.col("score") >= THRESHOLD)
    best = scored.groupBy("uid").agg(F.max(F.struct("score", (-F.col("template")).alias("before"), "licence")).alias("b"))
    return best.select("uid", "b.score", "b.licence", (-F.col("b.before")).alias("template"))


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", extra: dict[str, Column] | None = None) -> DataFrame:
    """The extra columns, path, license, score, origin (file, header, inherited) and
    inherited_from of each row."""
    extra = extra or {}
    # The key of a row is made before the names of its columns are given up.
    rows = files.select(F.col(path_col).cast("string").alias("path"), row_key(path_col, text_col).alias("rid"), F.col(text_col).cast("string").alias("text"), *(c.alias(n) for n, c in extra.items()))
    base = rows.drop("text").withColumn("licence_file", F.coalesce(F.substring_index("path", "/", -1).rlike(LICENSE_FILE), F.lit(False)))
    base = base.withColumn("dir", F.when(F.col("path").isNotNull(), F.expr("left(path, greatest(0, length(path) - length(substring_index(path, '/', -1)) - 1))")))
    base = materialize(base, "files")

    speaking = rows.where(F.col("text").rlike(TRIGGER))
    lines = F.filter(F.split("text", SENTENCE_END), lambda s: s.rlike(TRIGGER))
    wrapped = F.filter(F.split("text", WRAPPED_END), lambda s: s.rlike(r"[\n\r]") & s.rlike(TRIGGER))
    # A title and the line below it, which often names the version.
    each = F.split("text", LINE_END)
    pairs = F.filter(F.zip_with(each, F.slice(each, F.lit(2), F.size(each)), lambda a, b: F.when(a.rlike(TRIGGER), F.concat(a, F.lit("\n"), b))), lambda s: s.isNotNull())
    sentences = F.concat(lines, wrapped, pairs)
    named = F.substring_index("path", "/", -1).rlike(LICENSE_FILE)
    whole = F.when(named, F.array("text")).otherwise(F.array().cast("array<string>"))
    units = speaking.select("rid", F.explode(F.concat(sentences, whole)).alias("unit")).withColumn("uid", F.md5(F.col("unit").cast("binary")))
    units = materialize(units, "units")
    scored = score_units(units.select("uid", "unit").groupBy("uid").agg(F.first("unit").alias("unit")))
    own = units.select("rid", "uid").distinct().join(scored, "uid").groupBy("rid").agg(F.max(F.struct("score", (-F.col("template")).alias("before"), "licence")).alias("b")).select("rid", "b.score", "b.licence")
    known = materialize(base.join(own, "rid", "left"), "known")

    holders = (
        known.where("licence_file and licence is not null and dir is not null")
        .groupBy("dir")
        .agg(F.array_join(F.sort_array(F.collect_set("licence")), " AND ").alias("passed"), F.max("score").alias("passed_score"))
    )
    # Every directory of a file, with itself and the directories above it.
    wanting = known.where("licence is null and dir is not null").select("dir").distinct()
    parts = F.split("dir", "/")
    above = wanting.select(F.col("dir").alias("d"), F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("dir")))).alias("a")).select("d", "a.*").distinct()
    nearest = above.join(holders, "dir").groupBy("d").agg(F.max(F.struct("depth", "dir", "passed", "passed_score")).alias("n")).select("d", F.col("n.dir").alias("inherited_from"), "n.passed", "n.passed_score")
    found = known.join(nearest, (F.col("dir") == F.col("d")) & F.col("licence").isNull(), "left")
    origin = F.when(F.col("licence").isNotNull(), F.when(F.col("licence_file"), F.lit("file")).otherwise(F.lit("header"))).when(F.col("passed").isNotNull(), F.lit("inherited"))
    return found.select(
        *extra, "path", F.coalesce("licence", "passed").alias("license"), F.coalesce("score", "passed_score").alias("score"), origin.alias("origin"), "inherited_from"
    )


def document_path(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A path for a document: source/lang/hundred/name, where a document whose first or last
    line speaks of a licence is a licence file of its directory."""
    ends = F.concat_ws(" ", F.substring_index(text_col, "\n", 1), F.substring_index(F.rtrim(text_col), "\n", -1))
    name = F.concat(F.when(F.coalesce(ends.rlike(TRIGGER), F.lit(False)), F.lit("LICENSE.")).otherwise(F.lit("text.")), F.col(id_col).cast("string"))
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))
    return F.concat_ws("/", part("source"), part("lang"), F.concat(F.lit("d"), F.expr(f"{id_col} div 100").cast("string")), name)
