"""The pipeline's stages next to plain Python over the same rows, and odd tables."""

import zlib
from collections import Counter

import numpy as np
from test_dedup import kept_by_hand
from test_search import leaks_by_hand
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from quayside.llm import mixing
from quayside.llm.queries import table, tokenizer_path
from quayside.session import stage


def test_pipeline_as_by_hand(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    kept = stage(corpus_pipeline.identify_language(spark, docs, sf_dir), "test")
    assert kept.columns == docs.columns and kept.count() >= 0.98 * docs.count()
    rows = {r.doc_id: r for r in kept.collect()}
    rows = {d: rows[d] for d in sorted(kept_by_hand({d: r.text for d, r in rows.items()}))}
    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    leaks = {d for d, _ in leaks_by_hand([(d, r.text) for d, r in rows.items()], items)}
    rows = [r for d, r in rows.items() if d not in leaks]
    mixed = mixing.mix(spark.createDataFrame(rows, docs.schema))
    library = Tokenizer.from_file(tokenizer_path())
    want, start = [], 0
    for doc_id, text in sorted((r.doc_id, r.text) for r in mixed.collect()):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, got.collect())) == want


def test_stages_of_odd_tables(spark, sf_dir):
    """Nulls, repeated rows, clashing columns and an empty table go through every stage."""
    odd = table(spark, sf_dir, "documents").limit(40).selectExpr("*", "1 AS fp", "'k' AS key", "2 AS copy")
    extra = [(None, "x y", "en", "s", 1, 1, "k", 2), (-1, None, None, None, None, 1, "k", 2), (-2, "", "en", None, 1, 1, "k", 2)]
    odd = odd.union(odd.limit(3)).union(spark.createDataFrame(extra, odd.schema))
    for docs in (odd, odd.limit(0)):
        n = docs.count()
        for name, function in corpus_pipeline.STAGES:
            columns, docs = docs.columns, stage(function(spark, docs, sf_dir), name)
            if name != "tokens":
                assert docs.columns == columns
        assert docs.count() <= 20 * n and (n == 0) == (docs.count() == 0)


def test_all_are_registered():
    numbers = Counter(k.split("_")[0] for k in contract.queries())
    assert all(numbers[f"op{n}"] == 1 for n in range(1, 14)) and numbers["pipeline"] == 1
    assert corpus_pipeline.ORACLE_SQL is None
