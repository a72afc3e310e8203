"""Decontamination, licence scan and top-k search."""

import random
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import decontaminate, license_scan, topk
from quayside.llm.queries import op5_decontaminate, table

DOCS = "doc_id long, text string"


def words(n, seed):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefghij", k=draw.randint(3, 7))) for _ in range(n))


def scores_by_hand(index, terms):
    total = {}
    for t in terms:
        for item, weight in zip(*index.lists[t][:2], strict=True):
            total[item] = total.get(item, 0.0) + weight
    return {i: s for i, s in total.items() if s >= decontaminate.SHARE - 1e-9}


def test_wand_finds_all_above_the_threshold():
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(1, 14)))) for i in range(400)]
    index = decontaminate.ItemIndex(items)
    found = 0
    for _ in range(200):
        terms = set(draw.sample(range(len(index.lists)), draw.randint(1, 40)))
        got = dict(index.retrieve(terms))
        want = scores_by_hand(index, terms)
        assert set(got) == set(want) and all(np.isclose(got[i], want[i]) for i in got)
        found += len(want)
    assert found > 1000


def leaks_by_hand(docs, items):
    """Pairs where an item's words, case and punctuation aside, stand in a text as they are."""
    out = set()
    for doc_id, text in docs:
        run = f" {' '.join(decontaminate.words_of(text))} "
        out |= {(doc_id, i) for i, t in items if decontaminate.words_of(t) and f" {' '.join(decontaminate.words_of(t))} " in run}
    return out


def test_leaks_of_the_tables(spark, sf_dir):
    docs = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    got = {(r.doc_id, r.item_id) for r in op5_decontaminate(spark, sf_dir).collect()}
    assert got >= leaks_by_hand(docs, items) and len(got) >= 3
    assert len(got) <= 1.2 * len(leaks_by_hand(docs, items))


@pytest.mark.parametrize("chars", [2_000_000, 300])
def test_leaks_of_odd_rows(spark, chars, monkeypatch):
    monkeypatch.setattr(decontaminate.item_indexes, "__defaults__", (chars,))
    item = words(30, 1) + ". " + words(8, 2) + "."
    one = words(20, 3)
    items = spark.createDataFrame([(1, item, 0), (2, one, 0), (2, one, 0), (3, None, 0), (4, "", 0), (5, "?!", 0), (None, one, 0), (6, words(25, 9), 0)], "item_id long, text string, score int")
    changed = item.split()
    changed[3] = "other"
    texts = [
        None, "", words(300, 4), words(200, 5) + " " + item + " " + words(150, 6), item.upper(), one,
        " ".join(changed), item.rsplit(". ", 1)[0], words(20_000, 7) + " " + one, one[: len(one) // 2],
    ]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(None, item, 0), (5, one, 0)], DOCS + ", item_id int")
    got = sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect())
    assert got == [(3, 1), (4, 1), (5, 2), (5, 2), (6, 1), (8, 2)]
    kept = decontaminate.keep_clean(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 7, 9]


def test_leaks_do_not_depend_on_the_size_of_an_index(spark, monkeypatch):
    """A short item beside one of 200 words, and a text that holds question and answer 150 words apart."""
    question, answer = words(12, 1), words(7, 2)
    items = spark.createDataFrame([(1, f"{question}. {answer}."), (2, words(200, 3)), (3, words(15, 4))], "item_id long, text string")
    far = f"{words(100, 5)} {question} {words(150, 6)} {answer} {words(100, 7)}"
    docs = spark.createDataFrame([(1, far), (2, words(300, 8)), (3, f"{words(400, 9)} {words(15, 4)}")], DOCS)
    found = {}
    for chars in (2_000_000, 300, 30):
        monkeypatch.setattr(decontaminate.item_indexes, "__defaults__", (chars,))
        rows = decontaminate.contaminated(docs, items).collect()
        found[chars] = sorted((r.doc_id, r.item_id, round(r.score, 9), r.question_overlap, r.answer_overlap) for r in rows)
    assert found[2_000_000] == found[300] == found[30] and (3, 3) in [r[:2] for r in found[30]]
    assert (1, 1) in [r[:2] for r in found[30]]


def test_no_items_or_no_documents(spark):
    docs, items = spark.createDataFrame([(1, "a b")], DOCS), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.contaminated(docs, items.limit(0)).collect() == []
    assert decontaminate.contaminated(docs.limit(0), items).collect() == []
    assert decontaminate.keep_clean(docs, items.limit(0)).count() == 1


def test_licences(spark):
    mit = (
        "Copyright (c) 2020 Somebody\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions:\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES "
        "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    )
    texts = [
        None, "", "nothing here", "a license is mentioned", "word.\nReleased under the MIT License.\nmore", mit,
        "This work is licensed under the GNU General Public License, version 3.\nLicensed under CC BY-NC 4.0.",
        "Licensed under CC BY-NC 4.0.\nThis work is licensed under the GNU General Public License, version 3.\nLicensed under CC BY-NC 4.0.",
        "All rights reserved.", "x " * 300_000 + "\nLicensed under the Apache License, Version 2.0.",
    ]
    docs = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)] + [(None, mit, "n"), (4, None, "n")], DOCS + ", lower string")
    rows = license_scan.license_scan(docs).collect()
    got = {(r.doc_id, tuple(r.licenses)) for r in rows}
    assert len(rows) == len(texts) + 1
    assert got == {
        *((i, ()) for i in (0, 1, 2, 3, 4, 8)), (4, ("MIT",)), (5, ("MIT",)), (6, ("GPL-3.0", "CC-BY-NC-4.0")),
        (7, ("GPL-3.0", "CC-BY-NC-4.0")), (9, ("Apache-2.0",)),
    }
    ids = {r.doc_id: r.sentence_ids for r in rows if r.doc_id in (5, 8)}
    assert ids == {5: ["MITgrant", "MITnotice", "MITwarranty"], 8: ["AllRights"]}
    assert license_scan.license_scan(docs.limit(0)).collect() == []


def test_spdx_lines(spark):
    tags = {
        "SPDX-License-Identifier: MIT": "MIT", "# SPDX-License-Identifier: Apache-2.0\nimport os": "Apache-2.0",
        "// SPDX-License-Identifier: BSD-3-Clause\r\n": "BSD-3-Clause", "/* SPDX-License-Identifier: BSD-2-Clause */\nint x;": "BSD-2-Clause",
        "<!-- SPDX-License-Identifier:  GPL-3.0-only -->": "GPL-3.0", "x\n * SPDX-License-Identifier:\tGPL-3.0-or-later\n */": "GPL-3.0-or-later",
        "SPDX-License-Identifier:MIT": "MIT",
    }
    docs = spark.createDataFrame(list(enumerate(tags)), DOCS)
    assert {r.doc_id: r.licenses for r in license_scan.license_scan(docs).collect()} == {i: [x] for i, x in enumerate(tags.values())}


WRAPPED = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM.",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
        "the documentation and/or other materials provided with the distribution.",
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
        "this software without specific prior written permission.",
    ),
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies.",
    ),
}
IDS = {
    "MIT": ["MITgrant", "MITnotice", "MITwarranty"], "BSD-3-Clause": ["BSDgrant", "BSDsource", "BSDbinary", "BSDendorse"],
    "GPL-3.0-or-later": ["GPLfree", "GPL3plusGrant"], "ISC": ["ISCgrant"],
}


@pytest.mark.parametrize("width", [40, 72])
@pytest.mark.parametrize("mark", ["", "# ", "// ", " * ", "## "])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_wrapped_licences(spark, width, mark, end):
    """Paragraphs apart or not, below a heading with no mark at its end."""
    texts, want = [], []
    for name, parts in WRAPPED.items():
        for gap in ([""], []):
            lines = ["Copyright (c) 2020 Somebody", *gap]
            for part in parts:
                lines += [*textwrap.wrap(part, width), *gap]
            texts.append(end.join((mark + x).rstrip() for x in lines))
            want.append(([name], IDS[name]))
    rows = license_scan.license_scan(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()
    got = {r.doc_id: (r.licenses, r.sentence_ids) for r in rows}
    assert [got[i] for i in range(len(texts))] == want


def test_sentences_end_at_blank_lines(spark):
    texts = [
        "Released under\n\nthe MIT License", "Released under\n# \n# the MIT License", "Released. Under\nthe MIT License.", "All rights\n// reserved",
        "one\nReleased under the MIT License\ntwo", "xReleased under the MIT License", "Released under the MIT Licenses", "a:\n\nReleased under the\nMIT License",
        "Released under the MIT License\nAll rights reserved\nall rights reserved", "\n" * 200_000 + "All rights reserved" + " " * 200_000 + "\n" + "*" * 200_000,
    ]
    rows = license_scan.license_scan(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()
    assert {r.doc_id: r.sentence_ids for r in rows} == {
        **{i: [] for i in range(len(texts))}, 3: ["AllRights"], 4: ["MITref"], 7: ["MITref"], 8: ["MITref", "AllRights", "AllRights"], 9: ["AllRights"],
    }


def test_licence_plan_is_native(spark):
    docs = spark.createDataFrame([(1, "x")], DOCS)
    plan = license_scan.license_scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange"))


def top_by_hand(vectors, is_query, k):
    out = set()
    for q, v in vectors:
        if is_query(q):
            scored = sorted((-int(sum(a * b for a, b in zip(v, w, strict=False))), c) for c, w in vectors if c != q)
            out |= {(q, i + 1, c, -s) for i, (s, c) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize(("rows", "dims", "spread"), [(900, 64, 1.0), (300, 5, 0.004), (60, 40, 1e4), (20, 3, 1e9)])
def test_top_k_as_by_hand(spark, monkeypatch, rows, dims, spread):
    """Ordinary vectors, many ties, and products beyond exact doubles, over several blocks."""
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", 128)
    monkeypatch.setattr(topk, "QUERY_ROWS", 8)
    draw = np.random.default_rng(rows)
    vectors = [(i, (draw.normal(size=dims) * spread).astype(np.float32).tolist()) for i in range(rows)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    whole = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in vectors]
    got = {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0).collect()}
    if spread == 1e9:  # sums beyond 64 bits are given as the nearest number
        assert len(got) == 10 and all(abs(r[3]) < 1 << 63 or r[3] == -(1 << 63) for r in got)
        return
    assert got == top_by_hand(whole, lambda i: i % 20 == 0, 10)


def test_top_k_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (1, None, 1), (2, [nan, 1.0], 1), (3, [inf, 1.0], 1), (4, [None, 1.0], 1), (5, [1.0], 1), (6, [], 1), (7, [1.0, 2.0], 1), (7, [1.0, 2.0], 1), (None, [1.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 100 == 0).collect())
    n = 1024 * 1024
    assert got == [(0, 1, 7, 5 * n), (0, 2, 7, 5 * n), (0, 3, 5, n), (0, 4, 6, 0)]
    assert topk.top_k(df.limit(0), F.col("vec_id") % 100 == 0).collect() == []
