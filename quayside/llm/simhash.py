"""SimHash near-duplicates, found by Golay-code hashing of fingerprint segments.

Two fingerprints of 64 bits are linked if they differ in at most 4. They are cut into
three segments of 22, 21 and 21 bits. Of 4 errors, either two segments have at most one
each, or one segment has none (2 + 2 + 0). The second case is a join on the segment
itself. For the first, a segment padded to 23 bits is a word of the binary Golay code,
whose spheres of radius 3 fill the space: a word has one nearest codeword, and words
at distance 3 from it have five more at distance 4. Of two words with one error between
them, each has the other's nearest codeword among its own six or fewer. So for a pair of
segments (a, b) a fingerprint gives the keys (nearest a, any b) and (any a, nearest b),
24 bits each; fingerprints with at most one error in both segments share one of them.

Candidates that share a key are verified on all 64 bits. Within a key only the links of a
spanning forest are returned, never all pairs; ``keep_one``, which verifies texts too, compares
more pairs where texts of a forest's link are not alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import batch, by_rows, components, mapped, sent_if_small, text_bytes, texts_of
from quayside.session import stage

WORDS = 4
SEED = 42
DISTANCE = 4
#: Words of a shingle and similarity of near-duplicates where one document of each group is kept.
STAGE_WORDS, STAGE_SIMILARITY = 5, 0.8
PRINTS = "doc_id long, fp long, same binary"
#: Low bit and width of the segments.
SEGMENTS = ((42, 22), (21, 21), (0, 21))
#: Distinct fingerprints of one key that are compared in one task; more are dealt as pairs of blocks.
KEY_LIMIT = 50_000
#: So many ids of documents go to all executors, to pick texts without a shuffle of the texts; more are joined by one.
SENT_IDS = 2_000_000
#: Fixed value: the generator polynomial of the binary Golay code of length 23.
GOLAY = 0b110001110101


def fingerprint(text: bytes, width: int = WORDS) -> bytes:
    """8 bytes: a bit is set if it is set in over half the hashes of the shingles of ``width`` words."""
    words = text.lower().split()  # bytes: A-Z only, and white space is \\x20 and \\x09-\\x0D
    if not words:
        return bytes(8)
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    digest = xxhash.xxh64_digest
    if len(words) <= width:
        return digest(joined, SEED)
    starts = np.concatenate([[0], ends[:-width] + 1]).tolist()
    hashes = b"".join([digest(joined[i:j], SEED) for i, j in zip(starts, ends[width - 1 :].tolist(), strict=True)])
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(bits)).tobytes()


def hash_texts(width: int = WORDS):
    """Rows ``doc_id, fp, same``: the fingerprint, and a hash of 128 bits that equal texts share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            view, bounds = text_bytes(rows.column("text"))
            bounds = bounds.tolist()
            prints = b"".join(fingerprint(bytes(view[i:j]), width) for i, j in zip(bounds, bounds[1:], strict=False))
            same = [xxhash.xxh3_128_digest(view[i:j]) for i, j in zip(bounds, bounds[1:], strict=False)]
            yield batch(doc_id=rows.column("doc_id"), fp=np.frombuffer(prints, ">i8").astype(np.int64), same=pa.array(same, pa.binary()))

    return run


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of the words' polynomials, by the code's generator."""
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GOLAY << (bit - 11)), rest)
    return rest


def error_table() -> np.ndarray:
    """Per syndrome the errors that lead to codewords within distance 4, nearest first, -1 for none."""
    table = np.full((2048, 6), -1, np.int64)
    used = np.zeros(2048, np.int64)
    for weight in range(5):
        errors = np.array([sum(1 << b for b in bits) for bits in combinations(range(23), weight)], np.int64)
        for e, s in zip(errors.tolist(), syndromes(errors).tolist(), strict=True):
            table[s, used[s]] = e
            used[s] += 1
    return table


_ERRORS = error_table()


def near_codewords(words: np.ndarray) -> np.ndarray:
    """Numbers (the 12 high bits) of the codewords within distance 4 of each word, -1 for none."""
    errors = _ERRORS[syndromes(words)]
    return np.where(errors < 0, -1, (words[:, None] ^ errors) >> 11)


def golay_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        fp = rows.column("fp").to_numpy()
        parts = [(fp >> low) & ((1 << width) - 1) for low, width in SEGMENTS]
        near = [near_codewords(p) for p in parts]
        keys = [((3 + s) << 56) | p for s, p in enumerate(parts)]
        prints = [fp] * len(keys)
        for number, (a, b) in enumerate(combinations(range(3), 2)):
            grids = [(near[a][:, 0], near[b][:, i]) for i in range(6)] + [(near[a][:, i], near[b][:, 0]) for i in range(1, 6)]
            for one, two in grids:
                there = (one >= 0) & (two >= 0)
                keys.append((number << 56) | (one[there] << 12) | two[there])
                prints.append(fp[there])
        yield batch(key=np.concatenate(keys), fp=np.concatenate(prints))


def differing(one: np.ndarray, two: np.ndarray | np.int64) -> np.ndarray:
    """Bits that differ, of all 64: numpy counts those of a signed number's absolute value."""
    return np.bitwise_count((one ^ two).view(np.uint64))


def forest(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest over distinct fingerprints.

    Each fingerprint reached is compared with those not yet reached, so a dense group
    is settled by its first few members.
    """
    rest, a, b, front = fp, [], [], fp[:0]
    while len(rest):
        if not len(front):
            front, rest = rest[:1], rest[1:]
        reached = []
        for one in front:
            near = differing(rest, one) <= DISTANCE
            if near.any():
                hit = rest[near]
                a.append(np.full(len(hit), one))
                b.append(hit)
                reached.append(hit)
                rest = rest[~near]
        front = np.concatenate(reached) if reached else fp[:0]
    return (np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])


def link_run(groups: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
    """Links within whole groups; rows are sorted by group and fingerprint."""
    fresh = np.concatenate([[True], (groups[1:] != groups[:-1]) | (fp[1:] != fp[:-1])])
    groups, fp = groups[fresh], fp[fresh]
    heads = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    sizes = np.diff(heads, append=len(groups))
    size = np.repeat(sizes, sizes)
    a, b = [fp[:0]], [fp[:0]]
    for by in range(1, 8):  # groups of up to 8 all at once
        hit = np.flatnonzero((groups[by:] == groups[:-by]) & (size[by:] <= 8) & (differing(fp[by:], fp[:-by]) <= DISTANCE))
        a.append(fp[hit])
        b.append(fp[hit + by])
    for head, n in zip(heads[sizes > 8].tolist(), sizes[sizes > 8].tolist(), strict=True):
        one, two = forest(fp[head : head + n])
        a.append(one)
        b.append(two)
    one, two = np.concatenate(a), np.concatenate(b)
    links = np.unique(np.stack([np.minimum(one, two), np.maximum(one, two)]), axis=1)
    return batch(a=links[0], b=links[1])


def link_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group; the last group of a block waits for the next block."""
    wait: list[tuple[np.ndarray, np.ndarray]] = []
    rows = 0

    def taken(all_rows: bool) -> Iterator[pa.RecordBatch]:
        groups, fp = (np.concatenate(x) for x in zip(*wait, strict=True))
        end = len(groups) if all_rows else int(np.searchsorted(groups, groups[-1]))
        if end:
            yield link_run(groups[:end], fp[:end])
        wait[:] = [(groups[end:], fp[end:])] if end < len(groups) else []

    for rows_in in batches:
        if len(rows_in):
            wait.append((rows_in.column("grp").to_numpy(), rows_in.column("fp").to_numpy()))
            rows += len(rows_in)
        if rows >= 200_000:
            yield from taken(False)
            rows = 0
    if wait:
        yield from taken(True)


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """``a, b``: links that connect all distinct fingerprints (fp) within the distance.

    A key with more than ``KEY_LIMIT`` fingerprints is dealt as pairs of blocks to many
    tasks, so no task holds more than two blocks and no link is lost.
    """
    keys = mapped(prints.select("fp"), golay_keys, "key long, fp long")
    parts = by_rows(prints.sparkSession, prints.count() * 34, 1_000_000)
    grouped = dealt(keys, "fp").repartition(parts, "grp").sortWithinPartitions("grp", "fp")
    return mapped(grouped, link_groups, "a long, b long").distinct()


def dealt(keys: DataFrame, by: str) -> DataFrame:
    """``keys`` with ``grp`` for ``key``: a key of more than ``KEY_LIMIT`` rows in blocks (of ``by``), each pair of them a group."""
    hot = keys.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > KEY_LIMIT)
    hot = hot.select("key", F.ceil(F.col("n") / KEY_LIMIT).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64(by), F.col("blocks")).cast("int")
    other = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))
    columns = [c for c in keys.columns if c != "key"]
    return (
        keys.join(hot, "key", "left")
        .select("key", *columns, "blocks", own.alias("own"), other.alias("other"))
        .select(
            F.when(F.col("blocks").isNull(), F.col("key"))
            .otherwise(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")))
            .alias("grp"),
            *columns,
        )
    )


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, fp, component_id``: every document's fingerprint and the smallest doc_id it can reach.

    Fingerprints are of shingles of so many ``words``; links are at ``DISTANCE``, for which
    the keys are made.

    Texts are read whole; null and empty texts have fingerprint zero and are linked like
    any other. Rows without doc_id are left out; rows that repeat a doc_id each give a row.
    """
    prints = stage(mapped(texts_of(docs), hash_texts(words), PRINTS).drop("same"), "fingerprints")
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = stage(components(stage(fingerprint_links(distinct), "links"), "components"), "roots")
    labelled = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    labelled = labelled.select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints.join(labelled.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def shingle_set(text: str, width: int) -> set[tuple[bytes, ...]]:
    words = text.encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(max(len(words) - width + 1, 1))}


def alike(width: int, similarity: float):
    """Rows ``a, b`` whose texts have that similarity (Jaccard, of shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, set()
        for rows in batches:
            near = []
            for one, two in zip(rows.column("text_a").to_pylist(), rows.column("text_b").to_pylist(), strict=True):
                if one != last:
                    last, held = one, shingle_set(one, width)
                other = shingle_set(two, width)
                both = len(held & other)
                near.append(both >= similarity * (len(held) + len(other) - both))
            yield rows.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return run


def shingle_keys(width: int, similarity: float):
    """Rows ``key, t, need`` for every shingle of a text; only texts of one ``comp`` share keys.

    Texts that are alike share ``need`` keys of either at least.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            keys, needs = [], []
            for comp, text in zip(rows.column("comp").to_pylist(), rows.column("text").to_pylist(), strict=True):
                held = shingle_set(text, width)
                keys.append(np.unique(np.array([xxhash.xxh64_intdigest(b" ".join(s), comp) for s in held], np.uint64).view(np.int64)))
                needs.append(math.ceil(similarity * len(held) - 1e-6) - (len(held) - len(keys[-1])))
            if keys:
                sizes = list(map(len, keys))
                yield batch(key=np.concatenate(keys), t=np.repeat(rows.column("t").to_numpy(), sizes), need=np.repeat(needs, sizes))

    return run


def open_pairs(similarity: float):
    """Rows ``a, b`` of each group's texts that lie in different parts and whose prints and sizes allow a link."""

    def pairs(t: np.ndarray, part: np.ndarray, fp: np.ndarray, need: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b, found = [], [], 0
        for i in range(len(t) - 1):
            rest = slice(i + 1, None)
            fits = (part[rest] != part[i]) & (differing(fp[rest], fp[i]) <= DISTANCE)
            # ``need`` is the size times the similarity, rounded up
            fits &= np.minimum(need[rest], need[i]) + 1 >= similarity * (np.maximum(need[rest], need[i]) - 1)
            hit = t[rest][fits]
            a.append(np.minimum(hit, t[i]))
            b.append(np.maximum(hit, t[i]))
            found += len(hit)
            if found >= 100_000:
                yield batch(a=np.concatenate(a), b=np.concatenate(b))
                a, b, found = [], [], 0
        if found:
            yield batch(a=np.concatenate(a), b=np.concatenate(b))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("grp", "t", "part", "fp", "need")
        wait: list[tuple[np.ndarray, ...]] = []
        for rows in batches:  # sorted by group; the last group waits for the next block
            now = tuple(rows.column(c).to_numpy() for c in names)
            if len(rows) and wait and now[0][-1] != wait[0][0][0]:
                now, wait = tuple(np.concatenate(x) for x in zip(*wait, now, strict=True)), []
            if len(rows):
                heads = np.flatnonzero(np.concatenate([[True], now[0][1:] != now[0][:-1]])).tolist()
                for i, j in zip(heads, heads[1:], strict=False):
                    yield from pairs(*(x[i:j] for x in now[1:]))
                wait.append(tuple(x[heads[-1] :] for x in now))
        if wait:
            yield from pairs(*(np.concatenate(x) for x in list(zip(*wait, strict=True))[1:]))

    return run


def alike_pairs(pairs: DataFrame, held: DataFrame, words: int, similarity: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose texts in ``held`` (t, text) are alike."""
    pairs = pairs.join(held.select(F.col("t").alias("a"), F.col("text").alias("text_a")), "a")
    pairs = pairs.join(held.select(F.col("t").alias("b"), F.col("text").alias("text_b")), "b")
    return mapped(pairs.select("a", "b", "text_a", "text_b"), alike(words, similarity), "a long, b long")


def candidates(unsettled: DataFrame, similarity: float, words: int) -> DataFrame:
    """``a, b``: all pairs of texts (t, text, fp, part, comp) that may be alike, of one ``comp`` but of different parts.

    Of the shingles that texts of a comp share, ordered from the rarest on, two alike texts
    have one in common among the first few of each; only those are compared.
    """
    by_text = Window.partitionBy("t")
    keys = mapped(unsettled.select("t", "comp", "text"), shingle_keys(words, similarity), "key long, t long, need long")
    shared = keys.withColumn("n", F.count("*").over(Window.partitionBy("key"))).filter("n > 1")
    shared = shared.withColumns({"rank": F.row_number().over(by_text.orderBy("n", "key")), "shared": F.count("*").over(by_text)})
    first = shared.filter("rank <= shared - need + 1").select("key", "t", "need")
    first = stage(first.join(unsettled.select("t", "part", "fp"), "t"), "rare-shingles")
    parts = by_rows(first.sparkSession, first.count(), 1_000_000)
    grouped = dealt(first, "t").repartition(parts, "grp").sortWithinPartitions("grp")
    return mapped(grouped, open_pairs(similarity), "a long, b long").distinct()


def keep_one(docs: DataFrame, words: int = STAGE_WORDS, similarity: float = STAGE_SIMILARITY) -> DataFrame:
    """The documents without near-duplicates: of each group the one with the smallest doc_id stays.

    Two texts are linked if their fingerprints, of so many ``words``, differ in at most
    ``DISTANCE`` bits and they have ``similarity`` of their shingles in common. Links join
    documents to groups, and so do equal texts; no link is left out. First the spanning
    forests of the fingerprints are verified, and texts that share a fingerprint with its
    first one. Where a text was refused there, all pairs of parts that are not joined
    yet are compared, as far as they share a rare shingle. Rows that repeat a doc_id
    stay together if all their texts stay; rows without doc_id go.
    """
    texts = texts_of(docs)
    prints = stage(mapped(texts, hash_texts(words), PRINTS), "fingerprints")
    # a node is the first document of a text, t the text
    nodes = prints.groupBy("fp", "same").agg(F.min("doc_id").alias("node"))
    nodes = stage(nodes.withColumn("t", F.monotonically_increasing_id()), "texts-once")
    heads = stage(nodes.groupBy("fp").agg(F.min("t").alias("head")), "distinct-fingerprints")
    star = nodes.join(heads, "fp").filter("t <> head").select(F.col("head").alias("a"), F.col("t").alias("b"))
    links = stage(fingerprint_links(heads), "links")
    ends = links.join(heads.select(F.col("fp").alias("a"), F.col("head").alias("head_a")), "a")
    ends = ends.join(heads.select(F.col("fp").alias("b"), F.col("head").alias("head_b")), "b")
    links = stage(star.union(ends.select("head_a", "head_b")), "candidates")
    wanted = links.select(F.col("a").alias("t")).union(links.select("b")).distinct()
    held = nodes.join(wanted, "t", "left_semi")
    their = sent_if_small(stage(held.select("node").distinct(), "wanted"), SENT_IDS)
    some = texts.join(their, F.col("doc_id") == F.col("node"), "left_semi")
    whole = mapped(some, with_hash, "node long, same binary, text string")
    held = stage(whole.join(held, ["node", "same"]).groupBy("t", "fp").agg(F.min("text").alias("text")), "near-texts")
    near = stage(alike_pairs(links, held, words, similarity), "near")
    # texts of one document stand and fall together
    own = nodes.groupBy("node").agg(F.min("t").alias("a"), F.collect_list("t").alias("all")).filter(F.size("all") > 1)
    own = own.select("a", F.explode("all").alias("b"))
    parts = stage(components(near.union(own), "components").withColumnRenamed("root", "part"), "parts")
    part_of = nodes.select("t").join(parts.withColumnRenamed("node", "t"), "t", "left").select("t", F.coalesce("part", "t").alias("part"))

    refused = links.join(part_of.select(F.col("t").alias("a"), F.col("part").alias("part_a")), "a")
    refused = refused.join(part_of.select(F.col("t").alias("b"), F.col("part").alias("part_b")), "b")
    comps = components(refused.filter("part_a <> part_b").select(F.col("part_a").alias("a"), F.col("part_b").alias("b")), "components")
    comps = stage(comps.select(F.col("node").alias("part"), F.col("root").alias("comp")), "refused")
    unsettled = held.join(part_of.join(comps, "part"), "t")
    # of two texts the only link has been tried
    large = unsettled.groupBy("comp").agg(F.count("*").alias("n")).filter("n > 2").select("comp")
    unsettled = stage(unsettled.join(large, "comp"), "unsettled")
    more = stage(alike_pairs(stage(candidates(unsettled, similarity, words), "candidates"), held, words, similarity), "near")
    more = more.join(part_of.select(F.col("t").alias("a"), F.col("part").alias("part_a")), "a")
    more = more.join(part_of.select(F.col("t").alias("b"), F.col("part").alias("part_b")), "b")
    joined = components(more.select(F.col("part_a").alias("a"), F.col("part_b").alias("b")), "components")
    groups = part_of.join(joined.withColumnRenamed("node", "part"), "part", "left").select("t", F.coalesce("root", "part").alias("root"))
    groups = stage(nodes.join(groups, "t").select("fp", "same", "node", "root"), "groups")
    least = groups.groupBy("root").agg(F.min("node").alias("first_id"))
    groups = groups.join(least, "root").select("fp", "same", "first_id")
    gone = prints.join(groups, ["fp", "same"]).filter("doc_id <> first_id").select(F.col("doc_id").alias("near_duplicate")).distinct()
    gone = sent_if_small(stage(gone, "gone"), SENT_IDS)
    present = docs.filter("doc_id IS NOT NULL")
    return present.join(gone, F.col("doc_id").cast("long") == F.col("near_duplicate"), "left_anti").select(*docs.columns)


def with_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        view, bounds = text_bytes(rows.column("text"))
        bounds = bounds.tolist()
        same = [xxhash.xxh3_128_digest(view[i:j]) for i, j in zip(bounds, bounds[1:], strict=False)]
        yield batch(node=rows.column("doc_id"), same=pa.array(same, pa.binary()), text=rows.column("text"))
