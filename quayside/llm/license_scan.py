"""Licence recognition by sentences and rules, with DataFrame functions only.

A text is cut into sentences, which are normalised (lower case, letters and digits with
single spaces), so marks of comments go. A known licence sentence may be wrapped over lines
and may start or end at any line. Known sentences have identifiers; the identifiers of a
text, in order, are matched against rules. A rule is a run of identifiers; rules are tried in the
order listed, longest texts first, and what one has matched is no longer open to others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import texts_of

#: Normalised sentences of public licences and notices.
SENTENCES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MITgrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITnotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MITwarranty",
    "released under the mit license": "MITref",
    "licensed under the mit license": "MITref",
    "this project is licensed under the mit license": "MITref",
    "spdx license identifier mit": "MITref",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSDgrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSDsource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSDbinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDendorse",
    "spdx license identifier bsd 3 clause": "BSD3ref",
    "spdx license identifier bsd 2 clause": "BSD2ref",
    "licensed under the apache license version 2 0": "Apache2ref",
    "licensed under the apache license version 2 0 the license": "Apache2ref",
    "you may not use this file except in compliance with the license": "ApacheUse",
    "you may obtain a copy of the license at": "ApacheCopy",
    "spdx license identifier apache 2 0": "Apache2ref",
    "this work is licensed under the gnu general public license version 3": "GPL3ref",
    "licensed under the gnu general public license version 3": "GPL3ref",
    "spdx license identifier gpl 3 0 only": "GPL3ref",
    "spdx license identifier gpl 3 0 or later": "GPL3plusref",
    "this program is free software": "GPLfree",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3plusGrant",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPL2plusGrant",
    "you should have received a copy of the gnu general public license along with this program": "GPLreceived",
    "licensed under cc by nc 4 0": "CCBYNC4ref",
    "this work is licensed under cc by nc 4 0": "CCBYNC4ref",
    "licensed under cc by 4 0": "CCBY4ref",
    "licensed under cc by sa 4 0": "CCBYSA4ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "CCBY4ref",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCgrant",
    "all rights reserved": "AllRights",
}
#: Licences and the runs of identifiers that state them, in the order tried.
RULES = (
    ("MIT", ("MITgrant", "MITnotice", "MITwarranty")),
    ("BSD-3-Clause", ("BSDgrant", "BSDsource", "BSDbinary", "BSDendorse")),
    ("BSD-2-Clause", ("BSDgrant", "BSDsource", "BSDbinary")),
    ("Apache-2.0", ("Apache2ref", "ApacheUse", "ApacheCopy")),
    ("GPL-3.0-or-later", ("GPLfree", "GPL3plusGrant")),
    ("GPL-2.0-or-later", ("GPLfree", "GPL2plusGrant")),
    ("MIT", ("MITgrant",)),
    ("MIT", ("MITref",)),
    ("BSD-3-Clause", ("BSD3ref",)),
    ("BSD-2-Clause", ("BSD2ref",)),
    ("Apache-2.0", ("Apache2ref",)),
    ("GPL-3.0", ("GPL3ref",)),
    ("GPL-3.0-or-later", ("GPL3plusref",)),
    ("CC-BY-NC-4.0", ("CCBYNC4ref",)),
    ("CC-BY-SA-4.0", ("CCBYSA4ref",)),
    ("CC-BY-4.0", ("CCBY4ref",)),
    ("ISC", ("ISCgrant",)),
)
#: Every known sentence holds one of these, so other texts are not cut at all.
HINT = "licen|software|redistribut|copyright|rights[^a-z0-9]+reserved"
#: Sentences end at these marks before white space or the end, and at blank lines or lines of marks alone.
STOP, BLANK = r"[.!?;:]+([ \t\r\n]|\z)", r"\n[^\p{L}\p{N}\n]*(?=\n)"
#: This colon ends no sentence: the identifier follows it.
TAG = "spdx-license-identifier:"
#: Ends of sentences and lines, in texts of lower case.
END, LINE = "S", "L"
#: A known sentence over one or more lines, from and to an end; the longest one first.
KNOWN = "(?<=[SL])(?:" + "|".join(s.replace(" ", "[ L]") for s in sorted(SENTENCES, key=len, reverse=True)) + ")(?=[SL])"


def license_scan(docs: DataFrame) -> DataFrame:
    """``doc_id, sentence_ids, licenses``: arrays, empty where nothing is known.

    A licence is listed once, in the order of the rules. Null and empty texts have none;
    rows without doc_id are left out, and rows that repeat a doc_id each give a row.
    No shuffle: each row is settled where it is read.
    """
    known = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    # a mark keeps the line end after it, which may start a blank line
    ends = F.regexp_replace(F.replace("lower", F.lit(TAG), F.lit(TAG[:-1] + " ")), STOP, END + "$1")
    ends = F.concat(F.lit(END), F.translate(F.regexp_replace(ends, BLANK, END), "\n", LINE), F.lit(END))
    plain = F.regexp_replace(F.regexp_replace(ends, "[^a-z0-9SL]+", " "), " ?([SL]) ?", "$1")
    sentences = F.regexp_extract_all(plain, F.lit(KNOWN), F.lit(0))
    ids = F.transform(sentences, lambda s: F.element_at(known, F.translate(s, LINE, " ")))
    nothing = F.array().cast("array<string>")
    found = F.when(F.col("lower").rlike(HINT), ids).otherwise(nothing)
    rows = texts_of(docs).select("doc_id", F.lower("text").alias("lower")).select("doc_id", found.alias("sentence_ids"))
    run = F.concat(F.lit("<"), F.array_join("sentence_ids", "><"), F.lit(">"))
    matched = []
    for name, rule in RULES:
        stated = F.lit("<" + "><".join(rule) + ">")
        matched.append(F.when(F.contains(run, stated), F.lit(name)))
        run = F.replace(run, stated, F.lit("<>"))
    # most rows have no identifier, and are not matched at all
    licenses = F.when(F.size("sentence_ids") > 0, F.array_distinct(F.array_compact(F.array(*matched)))).otherwise(nothing)
    return rows.select("doc_id", "sentence_ids", licenses.alias("licenses"))
