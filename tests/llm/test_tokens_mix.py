"""Token files and mixing."""

import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from quayside.llm import common, mixing, token_files
from quayside.llm.queries import op3_token_files, op6_mix, table, tokenizer_path
from quayside.session import workspace

DOCS = "doc_id long, text string, source string"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return t


def by_hand(library, texts):
    """texts: (doc_id, text) in order."""
    out, start = [], 0
    for doc_id, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


ODD = [
    "", " ", "  a  b", "a b", "a  b c", "don't stop 'll x's", "one\n two \n three\t four", "é ü 漢 字 漢字 😀 a", "a b  c  d",
    "<|endoftext|> a <|endoftext|>", "x" * 5000, "12 345 .. ,, !!! a1 b2", "\x1c a \x1d\x85 b", "tail ", " head", "a\r\n b", "!", "! ! !", "\x00 \x00\x00",
]


def test_pieces_give_the_texts_ids(library, spark, sf_dir):
    texts = ODD + [r.text for r in table(spark, sf_dir, "documents").collect()]
    found = token_files.Encoder(tokenizer_path(), 2).encode(texts)
    for text, ids in zip(texts, found, strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_round_trip_of_the_tables(spark, sf_dir, library):
    texts = sorted((r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect())
    assert sorted(map(tuple, op3_token_files(spark, sf_dir).collect())) == by_hand(library, texts)


def test_files_of_odd_rows(spark, library):
    rows = [(-5, None, None), (2**40, "big id", "s"), *[(i, t, "s") for i, t in enumerate(ODD)], (7, "twice", "s"), (None, "x", "s")]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    path = workspace(spark, "token-test")
    token_files.write_token_files(docs, path, tokenizer_path())
    got = sorted(map(tuple, token_files.read_token_files(spark, path, tokenizer_path()).collect()))
    assert [r[0] for r in got] == sorted(r[0] for r in rows if r[0] is not None)
    assert got[0] == (-5, 0, 1, zlib.crc32(bytes(4)))
    for (_, start, n, _), after in zip(got, got[1:], strict=False):
        assert after[1] == start + n
    sums = Counter(r[3] for r in got)
    assert sums == Counter(r[3] for r in by_hand(library, [r[:2] for r in rows if r[0] is not None]))
    files = token_files.TokenFiles(path, 2)
    assert len(files) == len(got)
    assert [zlib.crc32(files[i].astype("<u4").tobytes()) for i in range(len(files))] == [r[3] for r in got]


def test_recurring_words_stay_in_memory(library, monkeypatch):
    monkeypatch.setattr(token_files, "MEMORY", 60)
    encoder, seen = token_files.Encoder(tokenizer_path(), 2), []
    encoder.direct = False
    ids = encoder.ids
    encoder.ids = lambda texts: seen.extend(texts) or ids(texts)
    for i in range(20):
        texts = ["x common, words! here  odd", *(f"a rare{i}-{j}" for j in range(30)), " ".join(f"w{i}q{j}" for j in range(100))]
        for text, found in zip(texts, encoder.encode(texts), strict=True):
            assert np.frombuffer(found, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, text
        assert len(encoder.words) <= 60 + 140
    assert seen.count(" common") == 1 and seen.count(" words") == 1


def test_known_words_over_a_line_end_are_not_encoded_again(library):
    encoder, seen = token_files.Encoder(tokenizer_path(), 2), []
    ids = encoder.ids
    encoder.ids = lambda texts: seen.extend(texts) or ids(texts)
    texts = ["one word.\nAnother, word\nand one.", "an other word.\nAnother\n\nline é!\nÉcole", "a  b word.\nAnother 1.\n2 x's\ny"]
    for text, found in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(found, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert " word.\nAnother" not in seen and " word\nand" not in seen and seen.count("Another") == 1
    encoder.forget()
    assert encoder.encode(texts) == [np.array(library.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]


def test_words_over_several_lines_or_before_marks_are_cut(library):
    encoder, seen = token_files.Encoder(tokenizer_path(), 2), []
    ids = encoder.ids
    encoder.ids = lambda texts: seen.extend(texts) or ids(texts)
    texts = [f"some word{a}.\nLine, of this,\nother!\nÉtéé## it.\nLine!" for a in ("a", "b", "c")]
    texts += ["a list\nof\nwords.\n\nFar\n", "x <|endoftext|>\nnext, y", "it's\nit's\nl'a b", "end.\nÀ.. 1,\n2, z"]
    for text, found in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(found, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert not [x for x in seen if "word" in x and "Line" in x or "other" in x and "Été" in x]
    assert seen.count("Line") == seen.count("\n") == 1


def test_new_words_of_many_texts_are_asked_for_at_once(library):
    """And a line's end is no part of the word before it, so that word is known at any place."""
    encoder, calls = token_files.Encoder(tokenizer_path(), 2), []
    ids = encoder.ids
    encoder.ids = lambda texts: calls.append(texts) or ids(texts)
    texts = [f"no {i}x{i} and i't{i},\nline{i % 7}.\n\nend  of it{i}\r\n \t" if i % 3 == 0 else f"a {i}y it.\nline, {i}'s\nit" for i in range(300)]
    texts += ["", "\n", "\nb c", "b\n", "b \nc", "b\n c", "a\nb\nc\n\nd\n\n\ne f", "x\u3000\ny z\n\xa0a b", "a\x1c\nb\n\x85c d", " \n a\nb"]
    texts += ["<|endoftext|>\n<|endoftext|> a\n<|endoftext|>", "*** ---\n--- ' '' a*** ***a\n***b"]
    found = encoder.encode(texts[1:300:3])
    assert len(calls) <= 10 and not [w for w in encoder.words if "\n" in w[1:]]
    for some in (texts, texts[::-1]):
        found = encoder.encode(some)
        for text, got in zip(some, found, strict=True):
            assert np.frombuffer(got, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert encoder.encode([]) == []


def test_files_of_one_hot_id(spark, library, monkeypatch):
    """Rows of one doc_id spread over several files, in one order in ids and index."""
    monkeypatch.setattr(token_files, "FILE_BYTES", 200)
    rows = [(5, f"text {i % 40} of id five", "s") for i in range(200)] + [(i, f"text of {i}", "s") for i in range(10)]
    docs, path = spark.createDataFrame(rows, DOCS).repartition(4), workspace(spark, "token-hot")
    token_files.write_token_files(docs, path, tokenizer_path())
    files = token_files.TokenFiles(path, 2)
    assert sum(len(x) > 0 and bool((x[:, 0] == 5).any()) for x in files.index) > 3
    ids = [int(x) for part in files.index for x in part[:, 0]]
    assert ids == sorted(r[0] for r in rows)
    crc = lambda x: zlib.crc32(x.astype("<u4").tobytes())
    got = Counter((doc, crc(files[i])) for i, doc in enumerate(ids))
    assert got == Counter((r[0], by_hand(library, [r[:2]])[0][3]) for r in rows)
    table = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.read_token_files(spark, path, tokenizer_path()).collect())
    assert [(r[1], r[3]) for r in table] == [(doc, crc(files[i])) for i, doc in enumerate(ids)]
    assert all(a[0] + a[2] == b[0] for a, b in zip(table, table[1:], strict=False))


def test_table_has_the_plain_calls_ids(spark):
    """Named special tokens too, with a tokenizer as it comes from its file."""
    plain = Tokenizer.from_file(tokenizer_path())
    marked = ["a <|endoftext|> b", "x<|endoftext|>y  <|endoftext|>.", "\n<|endoftext|>\n <|endoftext|><|endoftext|> end"]
    texts = list(enumerate(ODD + marked))
    got = token_files.token_table(spark.createDataFrame([(i, t, "s") for i, t in texts], DOCS), tokenizer_path())
    assert sorted(map(tuple, got.collect())) == by_hand(plain, texts)


def test_empty_table_has_no_tokens(spark):
    empty = token_files.token_table(spark.createDataFrame([], DOCS), tokenizer_path())
    assert empty.collect() == [] and empty.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_poisson_means(spark):
    rows = [(i, "x" * 9, "big") for i in range(4000)] + [(i, "x" * 9, "small") for i in range(4000, 4200)]
    mixed = mixing.mix(spark.createDataFrame(rows, DOCS), {"big": 1.0, "small": 1.0})
    counts = Counter(r.source for r in mixed.collect())
    assert abs(counts["big"] - 2100) < 4 * 2100**0.5 and abs(counts["small"] - 2100) < 4 * 2100**0.5
    per = Counter(r.doc_id for r in mixed.filter("source = 'small'").collect())
    spread = np.array([per[i] for i in range(4000, 4200)])
    assert 6 < spread.var() < 17  # a Poisson distribution of mean 10.5, drawn in two parts


def test_distribution_is_poisson(spark):
    rates = spark.createDataFrame([("a", 1, 3.0), ("b", 1, 0.0)], "source string, size long, rate double")
    found = {r.source: r for r in mixing.distributions(rates).collect()}
    p, c, want = np.exp(-3.0), np.exp(-3.0), []
    for k in range(1, mixing.COUNTS + 1):
        want.append(c)
        p *= 3.0 / k
        c += p
    assert np.allclose(found["a"].cdf, want) and found["a"].parts == 1
    assert found["b"].cdf == [1.0] * mixing.COUNTS


def test_mix_of_odd_tables(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).collect() == []
    rows = [(1, None, None), (1, None, None), (None, "", "s"), (3, "abc", "t")]
    mixed = mixing.mix(spark.createDataFrame([(*r, 5) for r in rows], DOCS + ", copy int"))
    assert mixed.columns == ["doc_id", "text", "source", "copy", "shuffle_key"]
    ones = [r.copy for r in mixed.collect() if r.doc_id == 1]
    assert len(ones) % 2 == 0  # equal rows are drawn alike
    assert mixing.mix(spark.createDataFrame(rows, DOCS), {"other": 1.0}).count() == 0
    null_only = mixing.source_rates(spark.createDataFrame(rows, DOCS), {None: 1.0}).collect()
    assert {r.source: r.rate > 0 for r in null_only} == {None: True, "s": False, "t": False}


def test_mix_keeps_columns_of_any_name(spark):
    rows = [(i, "x" * (i % 50), "ab"[i % 2]) for i in range(40)] + [(100, "long " * 50_000, "a")]
    plain = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    names = ["_n", "_dealt", "Copy", "n", "dealt", "key", "of", "in_0", "a.b", "size", "rate", "SHUFFLE_KEY", "parts"]
    docs = spark.createDataFrame([(*r, *([r[0]] * len(names))) for r in rows], [*DOCS.replace(" long", "").replace(" string", "").split(", "), *names])
    mixed = mixing.mix(docs)
    own = [c for c in names if c not in ("Copy", "SHUFFLE_KEY")]
    assert mixed.columns == ["doc_id", "text", "source", *own, "copy", "shuffle_key"]
    got = mixed.collect()
    assert [(r.doc_id, r.text, r.source, r.copy, r.shuffle_key) for r in got] == [tuple(r) for r in plain]
    assert all(r[c] == r.doc_id for r in got for c in own)


def test_mix_is_shuffled_and_repeatable(spark, sf_dir):
    rows = op6_mix(spark, sf_dir).collect()
    keys = [r.shuffle_key for r in rows]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)
    ids = [r.doc_id for r in rows]
    assert ids != sorted(ids) and rows == op6_mix(spark, sf_dir).collect()


def test_many_sources_are_joined_by_a_shuffle(spark, monkeypatch):
    rows = [(i, "x" * (i % 7), ("a", "b", None)[i % 3]) for i in range(60)]
    docs = spark.createDataFrame(rows, DOCS)
    few = mixing.mix(docs).collect()
    monkeypatch.setattr(common, "SENT_ROWS", 0)
    assert mixing.mix(docs).collect() == few
