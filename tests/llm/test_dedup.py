"""Line, byte-string and near-duplicate removal, next to brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from quayside.llm import line_dedup, simhash, suffix_dedup
from quayside.llm.common import components
from quayside.llm.queries import op1_line_dedup, op2_suffix_dedup, op9_simhash, table

DOCS = "doc_id long, text string"


def words(n, seed):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefghij", k=draw.randint(2, 7))) for _ in range(n))


def frame(spark, texts, schema=DOCS):
    return spark.createDataFrame(list(enumerate(texts)), schema)


def spans_by_hand(texts, length=100):
    """Maximal removed runs per document, by a table of all strings."""
    first, out = {}, {}
    for doc_id, text in sorted(texts.items()):
        data = (text or "").encode()
        covered = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - length + 1):
            if first.setdefault(data[i : i + length], (doc_id, i)) != (doc_id, i):
                covered[i : i + length] = True
        edges = np.flatnonzero(np.diff(covered.astype(int), prepend=0)).tolist()
        out[doc_id] = list(zip(edges[::2], edges[1::2], strict=True))
    return out


def digest_by_hand(texts, spans):
    out = {}
    for doc_id, text in texts.items():
        data = (text or "").encode()
        kept = bytearray(data)
        for a, b in reversed(spans[doc_id]):
            del kept[a:b]
        out[doc_id] = (len(data), len(data) - len(kept), len(spans[doc_id]), hashlib.sha256(kept).hexdigest())
    return out


def suffix_cases():
    passage, line = words(40, 1), "this line stands in very many texts, always the same"
    long = f"{line} - {line[::-1]}"
    return [
        None,
        "",
        "short",
        words(60, 2),
        words(30, 3) + passage + words(30, 4),
        passage,
        words(5, 5) + passage + words(9, 6) + passage,
        "a" * 1000,
        "é" * 300 + words(20, 7),
        "xy" * 400,
        words(60, 2),
        words(60, 2).replace("a", "q", 1),
        *(words(12, 100 + i) + "\n" + line + "\n" + words(12, 200 + i) for i in range(30)),
        *(words(12, 300 + i) + "\n" + long + "\n" + words(12, 400 + i) for i in range(30)),
        "\n".join([line] * 40),
        words(3000, 8) + passage[:150] + "é" + passage[150:],
        "ü" * 300,
    ]


@pytest.mark.parametrize("hot", [1000, 3])
def test_repeats_as_by_hand(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", hot)
    texts = dict(enumerate(suffix_cases()))
    rows = suffix_dedup.suffix_dedup(frame(spark, suffix_cases())).collect()
    want = spans_by_hand(texts)
    assert {r.doc_id: [tuple(s) for s in r.spans] for r in rows} == want
    assert sum(map(len, want.values())) > 20


def test_repeats_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "STRIDE", 97)
    data = np.frombuffer((words(400, 1) * 2).encode(), np.uint8)
    bounds = np.array([0, 700, 900, len(data)])
    at, keys = suffix_dedup.anchors(data, bounds)
    monkeypatch.setattr(suffix_dedup, "STRIDE", 1 << 20)
    whole, whole_keys = suffix_dedup.anchors(data, bounds)
    assert at.tolist() == whole.tolist() and keys.tolist() == whole_keys.tolist()


def test_class_bounds_are_common_prefixes():
    draw = random.Random(4)
    pieces = ["".join(draw.choices("ab", k=draw.randint(1, 400))).encode() for _ in range(8)]
    pieces += [b"a" * 300, pieces[0], pieces[1][20:]]
    data = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8) + np.uint8(1)
    order = suffix_dedup.sorted_suffixes(data)
    for length in (1, 3, 17, 100):
        found = suffix_dedup.class_bounds(data[order - 1], length)
        text = data.tobytes()
        left = [text.index(0, i) - i for i in order.tolist()]  # symbols before the end mark
        for i in range(1, len(order)):
            a, b = int(order[i - 1]), int(order[i])
            if min(left[i - 1], left[i]) >= length:
                assert found[i] == (text[a : a + length] != text[b : b + length])


def test_symbols_of_wide_intervals_are_looked_up_together(monkeypatch):
    draw, calls, look = random.Random(5), [], np.searchsorted
    data = np.array([draw.randint(1, 200) for _ in range(4000)] * 2 + [255], np.uint8)
    order = suffix_dedup.sorted_suffixes(data)
    monkeypatch.setattr(np, "searchsorted", lambda *a, **b: calls.append(1) or look(*a, **b))
    suffix_dedup.class_bounds(data[order - 1], suffix_dedup.LENGTH)
    assert len(calls) <= 3 * suffix_dedup.LENGTH


def test_repeats_of_the_tables(spark, sf_dir):
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    rows = op2_suffix_dedup(spark, sf_dir).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}
    assert got == digest_by_hand(texts, spans_by_hand(texts))


def test_repeats_of_odd_tables(spark):
    empty = suffix_dedup.suffix_dedup(spark.createDataFrame([], DOCS))
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_bytes", "spans", "kept"]
    text = words(50, 9)
    rows = [(1, text, "x", 1), (1, text, "x", 1), (2, text, None, None), (None, text, "x", 1)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, key string, spans int")
    got = sorted((r.doc_id, [tuple(s) for s in r.spans]) for r in suffix_dedup.suffix_dedup(odd).collect())
    assert got == [(1, []), (1, []), (2, [(0, len(text))])]


def lines_by_hand(texts):
    first, out = {}, {}
    for doc_id, text in sorted(texts.items()):
        lines = (text or "").split("\n")
        gone = set()
        for i in range(len(lines) - 2):
            if first.setdefault(tuple(lines[i : i + 3]), (doc_id, i)) != (doc_id, i):
                gone |= {i, i + 1, i + 2}
        out[doc_id] = (len(lines), "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def test_lines_as_by_hand(spark):
    texts = [None, "", "a\nb", "a\nb\nc\nd", "x\na\nb\nc\ny", "a\nb\nc\na\nb\nc", "\n" * 9, "z\r\nz\nz\nz\nz", "a\nb\nc", "q " * 100_000]
    rows = line_dedup.line_dedup(frame(spark, texts)).collect()
    assert {r.doc_id: (r.n_lines, r.kept) for r in rows} == lines_by_hand(dict(enumerate(texts)))
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in rows}
    assert spans[3] == [] and spans[4] == [(1, 4)] and spans[5] == [(0, 6)] and spans[6] == [(1, 10)] and spans[8] == [(0, 3)]


def test_lines_of_odd_tables(spark):
    assert line_dedup.line_dedup(spark.createDataFrame([], DOCS)).collect() == []
    rows = [(1, "a\nb\nc", 0), (1, "a\nb\nc", 0), (None, "a\nb\nc", 0), (5, "a\nb\nc", None)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lines int")
    got = sorted((r.doc_id, r.kept) for r in line_dedup.line_dedup(odd).collect())
    assert got == [(1, "a\nb\nc"), (1, "a\nb\nc"), (5, "")]


def test_lines_of_the_tables(spark, sf_dir):
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    got = {r.doc_id: (r.n_lines, r.kept_sha256) for r in op1_line_dedup(spark, sf_dir).collect()}
    assert got == {k: (n, hashlib.sha256(x.encode()).hexdigest()) for k, (n, x) in lines_by_hand(texts).items()}


def runs_by_hand(text, width):
    data = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        data = data.replace(c, " ")
    found = [w for w in data.split(" ") if w]
    return [" ".join(found[i : i + width]) for i in range(max(len(found) - width + 1, 1))] if found else []


def print_by_hand(text, width=4):
    runs = runs_by_hand(text, width)
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(prints):
    """prints: doc_id -> fingerprint."""
    root = {d: d for d in prints}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {d: top(d) for d in ids}


def kept_by_hand(texts):
    """Of texts by doc_id the smallest of each group of links at 4 bits and 0.8 of five-word shingles."""
    prints = {d: print_by_hand(t, 5) for d, t in texts.items()}
    runs = {d: set(runs_by_hand(t, 5)) for d, t in texts.items()}
    root = {d: d for d in texts}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4 and len(runs[a] & runs[b]) >= 0.8 * len(runs[a] | runs[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {d for d in ids if top(d) == d}


def test_one_of_each_group_stays(spark):
    draw, texts = random.Random(6), {}
    for group in range(12):
        base = words(300, 50 + group).split()
        for i in range(4):
            texts[group * 10 + i] = " ".join(base)
            for _ in range(draw.randint(0, 12)):
                base[draw.randrange(300)] = f"new{draw.randrange(10**6)}"
    texts.update({200 + i: words(40, i % 7) for i in range(20)} | {300: "", 301: " \n", 302: "a b", 303: "A  b", 304: "a c"})
    docs = spark.createDataFrame([(i, t, 0) for i, t in texts.items()], "doc_id long, text string, root int").repartition(3)
    got = {r.doc_id for r in simhash.keep_one(docs).collect()}
    assert got == kept_by_hand(texts) and 12 < len([d for d in got if d < 200]) < 48
    assert len([d for d in got if 200 <= d < 300]) == 7


def test_a_dense_group_loses_no_document_of_its_own(spark):
    """Sixty steps away from one text: what goes is joined by similar texts to what stays."""
    base, draw, texts = words(300, 5).split(), random.Random(7), {}
    for i in range(60):
        texts[i] = " ".join(base)
        base[draw.randrange(300)] = f"new{i}"
    got = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(list(texts.items()), DOCS.replace(", source string", ""))).collect()}
    assert kept_by_hand(texts) <= got and len(got) < 30


@pytest.mark.parametrize("limit", [50_000, 20])
def test_no_link_of_a_dense_group_is_left_out(spark, monkeypatch, limit):
    """Steps away from one text, and texts of one fingerprint that are like each other but not like its first."""
    monkeypatch.setattr(simhash, "KEY_LIMIT", limit)
    base, draw, texts = words(300, 5).split(), random.Random(7), {}
    for i in range(120):
        texts[i] = " ".join(base)
        base[draw.randrange(300)] = f"new{i}"
    for i in range(40):
        tail = words(60, 900 + i // 2).split()
        tail[-1] = f"end{i}"
        texts[200 + i] = "z " * 600 + " ".join(tail)
    prints = {simhash.fingerprint(t.encode(), 5) for d, t in texts.items() if d >= 200}
    assert len(prints) == 1
    docs = spark.createDataFrame(list(texts.items()), DOCS).repartition(3)
    got = {r.doc_id for r in simhash.keep_one(docs).collect()}
    assert got == kept_by_hand(texts)
    assert len([d for d in got if d >= 200]) == 20


def test_texts_are_picked_without_a_shuffle_of_them(spark, monkeypatch):
    """Ids beyond the session's broadcast limit are sent none the less, up to SENT_IDS of them."""
    texts = [words(60, i) for i in range(30)]
    docs = frame(spark, texts + texts[:10])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for sent, join in ((simhash.SENT_IDS, "BroadcastHashJoin"), (3, "SortMergeJoin")):
            monkeypatch.setattr(simhash, "SENT_IDS", sent)
            kept = simhash.keep_one(docs)
            plan = kept._jdf.queryExecution().executedPlan().toString()
            assert join in plan and ("Exchange hashpartitioning" in plan) == (join == "SortMergeJoin")
            assert sorted(r.doc_id for r in kept.collect()) == list(range(30))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_texts_that_share_an_id_are_all_compared(spark):
    one, two = words(200, 31), words(200, 32)
    rows = [(1, one), (1, two), (2, one + " more"), (3, two + " more"), (4, words(200, 33))]
    got = sorted(r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, DOCS)).collect())
    assert got == [1, 1, 4]


def test_fingerprints_as_by_hand():
    texts = ["", " \n\t", "One", "One two Three", "a b c d", "a b c d e", "Ä Ö a\x0bb\x1cc d e f g h", words(500, 3), "x " * 4000]
    for text in texts:
        assert int.from_bytes(simhash.fingerprint(text.encode())) == print_by_hand(text)


def test_near_duplicates_of_the_tables(spark, sf_dir):
    rows = op9_simhash(spark, sf_dir).collect()
    prints = {r.doc_id: print_by_hand(r.text) for r in table(spark, sf_dir, "documents").collect()}
    assert {r.doc_id: r.fingerprint for r in rows} == {d: f"{p:016x}" for d, p in prints.items()}
    assert {r.doc_id: r.component_id for r in rows} == components_by_hand(prints)


def test_all_close_words_share_a_golay_key():
    draw = np.random.default_rng(1)
    word = draw.integers(0, 1 << 23, 3000)
    for flip in (0, *(1 << draw.integers(0, 23, 3000) for _ in range(5))):
        one, two = simhash.near_codewords(word), simhash.near_codewords(word ^ flip)
        assert (one == two[:, :1]).any(axis=1).all()
        assert ((one >= 0).sum(axis=1) <= 6).all() and (one[:, 0] >= 0).all()


@pytest.mark.parametrize("limit", [50_000, 40])
def test_links_as_by_hand(spark, monkeypatch, limit):
    """A dense ball, chains, and random prints; with a low limit hot keys are dealt in blocks."""
    monkeypatch.setattr(simhash, "KEY_LIMIT", limit)
    draw = random.Random(11)
    center = draw.getrandbits(64)
    prints = {center}
    for _ in range(400):
        p = center
        for _ in range(draw.randint(1, 6)):
            p ^= 1 << draw.randrange(64)
        prints.add(p)
    chain = draw.getrandbits(64)
    for i in range(0, 60, 4):
        chain ^= sum(1 << (i + b) for b in range(4))
        prints.add(chain)
    prints |= {draw.getrandbits(64) for _ in range(300)} | {0}
    ids = dict(enumerate(sorted(prints)))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in ids.values()]
    links = simhash.fingerprint_links(spark.createDataFrame(signed, "fp long")).collect()
    number = {p: i for i, p in ids.items()}
    root = {i: i for i in ids}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in links:
        a, b = a % (1 << 64), b % (1 << 64)
        assert (a ^ b).bit_count() <= 4
        x, y = sorted((top(number[a]), top(number[b])))
        root[y] = x
    assert {i: top(i) for i in ids} == components_by_hand(ids)


def test_links_over_the_top_bit(spark):
    """Prints that differ in bit 63 and a low bit, and one that is 5 bits away from both."""
    low, high, far = 7, 6 - (1 << 63), 7 ^ 0x1F << 30
    links = simhash.fingerprint_links(spark.createDataFrame([(low,), (high,), (far,)], "fp long")).collect()
    assert [tuple(r) for r in links] == [(high, low)]
    one, two = simhash.forest(np.array([high, low, far]))
    assert (one.tolist(), two.tolist()) == ([high], [low])


def test_near_duplicates_of_odd_tables(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []
    rows = [(3, None, 1), (2, "", 1), (9, words(90, 1), 1), (4, words(90, 1), 1), (4, words(90, 1), 1), (None, "x", 1)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, fp long")
    got = sorted((r.doc_id, r.component_id) for r in simhash.near_duplicates(odd).collect())
    assert got == [(2, 2), (3, 2), (4, 4), (4, 4), (9, 4)]
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [2, 4, 4]


def test_components_of_a_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(7, i) for i in range(1000, 1200)] + [(5, 7), (3, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(chain + hub, "a long, b long"), "c").collect()))
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 5 for i in [5, 7, *range(1000, 1200)]}}
