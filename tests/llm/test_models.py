"""Quality classifier and language identification: held-out accuracy and odd rows."""

import math
import zlib

import numpy as np

from quayside.llm import language, quality
from quayside.llm.queries import op4_quality, op10_language, table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BIG = "/root/testdata/sf0.01"


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_quality_of_held_out_documents(spark):
    labels = {r.doc_id: r.quality for r in table(spark, BIG, "labels").collect()}
    rows = op4_quality(spark, BIG).collect()
    assert len(rows) == table(spark, BIG, "documents").count()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    tested = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == q for p, q in tested]) > 0.93
    assert np.mean([p for p, q in tested if q == 1]) > 0.95


def test_pairs_in_linear_time_are_all_pairs():
    draw = np.random.default_rng(2)
    n = quality.WORDS + quality.STATISTICS
    machine = quality.Machine(0.3, draw.normal(size=n), draw.normal(size=(n, quality.FACTORS)))
    numbers, values = draw.choice(n, 9, replace=False), draw.normal(size=9)
    pairs = sum(
        machine.factors[numbers[i]] @ machine.factors[numbers[j]] * values[i] * values[j] for i in range(9) for j in range(i + 1, 9)
    )
    raw = machine.raw(numbers, values, np.array([0, 9]))[0][0]
    assert np.isclose(raw, 0.3 + machine.linear[numbers] @ values + pairs)


def test_quality_never_sees_labels_lang_source_or_id(spark):
    docs, labels = table(spark, BIG, "documents").limit(300).cache(), table(spark, BIG, "labels")
    machine = quality.train(docs, labels)
    before = {r.doc_id: r.score for r in quality.score(docs, machine).collect()}
    other = docs.selectExpr("doc_id + 7000 AS doc_id", "text", "'zz' AS lang", "'zz' AS source", "n_chars")
    assert {r.doc_id - 7000: r.score for r in quality.score(other, machine).collect()} == before


def test_quality_of_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", -4), (3, "x" * 200_000, "en", "s", 1), (3, "dup", "en", "s", 1), (None, "x", "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, None), (None, 1), (9, 1)], "doc_id long, quality int")
    got = quality.score(docs.selectExpr("*", "1 AS score", "'x' AS numbers"), quality.train(docs, labels)).collect()
    assert sorted(r.doc_id for r in got) == [1, 2, 3, 3] and all(0 <= r.score <= 1 for r in got)
    none = quality.train(docs, labels.limit(0))
    assert {r.predicted for r in quality.score(docs, none).collect()} <= {0, 1}
    assert quality.score(docs.limit(0), none).collect() == []
    assert quality.score(docs.drop("n_chars"), none).count() == 4


def test_language_of_held_out_documents(spark):
    langs = {r.doc_id: r.lang for r in table(spark, BIG, "documents").collect()}
    rows = op10_language(spark, BIG).collect()
    assert len(rows) == len(langs) and all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]) > 0.97
    assert np.mean([r.ambiguous for r in rows]) < 0.02


def test_codewords_are_apart():
    for n in (2, 3, 4, 7, 12, 40):
        code = language.code_matrix(n).astype(int)
        assert len(code) == n and set(np.unique(code)) == {-1, 1}
        assert (np.abs(code.sum(axis=0)) < n).all()
        apart = (code.shape[1] - code @ code.T) // 2 + np.eye(n, dtype=int) * 999
        assert apart.min() >= (1 if n < 4 else 4 if n < 8 else 5)


def test_many_languages_are_told_apart(spark):
    """Twelve languages use the random code; each has its own alphabet of syllables."""
    draw = np.random.default_rng(8)
    alphabets = [["".join(draw.choice(list("abcdefghijklmnop"), 3)) for _ in range(8)] for _ in range(12)]
    rows = [(i, " ".join(draw.choice(alphabets[i % 12], 60)), f"l{i % 12}", None, None) for i in range(600)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r.lang_pred for r in language.identify(docs, language.train(docs)).collect()}
    assert np.mean([got[i] == f"l{i % 12}" for i in range(600)]) > 0.95


def test_language_of_odd_rows(spark, sf_dir):
    known = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    rows = [(-1, None, "en", None, 1), (-2, "", "en", None, 1), (-3, "12 ## 3 !", "en", None, 1), (-4, "a", None, None, 1), (-5, "漢字かな", "en", None, 1)]
    rows += [(None, "the of", "en", None, 1), (-6, "the of and " * 50_000, None, None, 1)]
    docs = known.union(spark.createDataFrame(rows, DOCS)).selectExpr("*", "1 AS lang_pred", "2 AS numbers")
    got = {r.doc_id: r for r in language.identify(docs, language.train(known)).collect()}
    assert None not in got and len(got) == known.count() + 6
    assert all(got[i].lang_pred == "und" and got[i].score == 0 and got[i].ambiguous for i in (-1, -2, -3))
    assert got[-6].lang_pred == "en" and got[-4].lang_pred != "und" and got[-5].lang_pred != "und"
    nothing = language.train(known.limit(0))
    assert nothing is None and {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}
    assert language.identify(known.limit(0), None).collect() == []
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns and not {-1, -2, -3} & {r.doc_id for r in kept.collect()}
    assert language.keep_identified(known.limit(0)).collect() == []


def test_languages_share_the_bound_of_the_sample(spark, monkeypatch):
    rows = [(i, f"word {'abcd'[i % 4] * 5}", "abcd"[i % 4], None, None) for i in range(200)]
    read = []

    def fit(langs, numbers, counts):
        read.extend(langs)
        return fitted(langs, numbers, counts)

    fitted = language.fit
    monkeypatch.setattr(language, "fit", fit)
    monkeypatch.setattr(language, "TOTAL", 12)
    decoder = language.train(spark.createDataFrame(rows, DOCS))
    assert decoder.languages == list("abcd")
    assert all(0 < read.count(x) <= 3 for x in "abcd")


def grams_by_hand(text):
    """Gram numbers of one text, a byte at a time, in whole numbers of 32 bits."""
    kept = "".join(c if ord(c) >= 128 or c.isalpha() else " " for c in (text or "").lower())
    data = b" " + b" ".join(kept.encode().split()) + b"  "
    found, mask, shift = [], (1 << 32) - 1, 32 - 14
    for a, b, c in zip(data, data[1:], data[2:], strict=False):
        two = (a * 0x9E3779B1 + b * 0x85EBCA77) & mask
        three = (two * 0xC2B2AE3D + c * 0x27D4EB2F + 1) & mask
        found += [two >> shift, three >> shift]
    return found


def test_languages_as_decoded_by_hand(spark, sf_dir):
    """Outputs of the bits, losses against each codeword, and the nearest one, for every row of the query."""
    docs = table(spark, sf_dir, "documents")
    decoder = language.train(docs)
    weights = decoder.weights.astype(float)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = op10_language(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        numbers = grams_by_hand(texts[r.doc_id])
        outputs = [sum(weights[n, bit] for n in numbers) / len(numbers) for bit in range(weights.shape[1])]
        losses = []
        for code, trust in zip(decoder.code.tolist(), decoder.trust.tolist(), strict=True):
            margins = [min(max(x * s, -4.0), 4.0) * c for x, s, c in zip(outputs, decoder.scales.tolist(), code, strict=True)]
            losses.append(sum(t * math.exp(-m) for t, m in zip(trust, margins, strict=True)))
        likeness = [math.exp(-(x - min(losses)) * len(losses)) for x in losses]
        lettered = any(c.isalpha() for c in texts[r.doc_id] or "")
        assert r.lang_pred == (decoder.languages[losses.index(min(losses))] if lettered else "und")
        assert math.isclose(r.score, 1 / sum(likeness) if lettered else 0.0, rel_tol=1e-6, abs_tol=1e-9)
        assert r.ambiguous == (r.score < language.CERTAIN) and r.held_out == held(r.doc_id)
