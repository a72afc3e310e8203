"""Token ids in flat binary files, with 64-bit document offsets.

Layout below one folder: ``data/kind=ids/part-N*`` hold the ids of the documents in
ascending doc_id order, as little-endian unsigned integers and nothing else;
``index/part=N/`` holds two 64-bit integers per document, its doc_id and the number of
ids before it in the whole corpus. Numbers ascend with doc_id. ``data/kind=sizes`` holds
doc_id and length instead: prefix sums over its files' totals give each part its base.

Spark's own writer makes the files, so a lost task is repeated and commits once, on any
store. It ends each row with a separator: id 0, which ends each document, is that
separator; for the index it is the zero byte on top of a 64-bit number below 2**56.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from collections.abc import Collection, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import batch, by_rows, byte_letters, mapped, texts_of
from quayside.session import workspace

#: Bytes of text that one file covers on average; its ids are about as large again.
FILE_BYTES = 12 << 20
#: Words a worker remembers the ids of.
MEMORY = 300_000
#: Bytes of text that are encoded at once: more recurring words, fewer look-ups.
ENCODE_BYTES = 4 << 20
#: Words of one call of the library.
CALL = 5_000
#: The index is sent to all executors up to this size, beyond it is joined by a shuffle.
INDEX_BYTES = 32 << 20

FILE_PART, FOLDER_PART = r"/part-(\d+)", r"/part=(\d+)/"
TABLE = "doc_id long, start long, n_tokens long, ids_crc32 long"

#: Where a text may be cut: at a single space, or before a single end of line, between characters that are no white space.
_SPACE = re.compile(r"(?<=\S) (?=\S)")
_CUT = re.compile(r"(?<=\S)(?: (?=\S)|(?=\n\S))")
_LINE = re.compile(r"\n(?<=\S\n)(?=\S)")
#: How byte-level vocabularies write each byte.
_LETTER = {x: c for c, x in byte_letters().items()}
_SPACED = _LETTER[32]
#: An end of line, Latin letters, then marks of ASCII other than the apostrophe.
_WORD = re.compile(r"(\n?)(?=.)([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")
_TAILED = re.compile(r"()([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]+)")


class Encoder:
    """Ids of texts as bytes, by a byte-level BPE of the tokenizers library.

    Its splitting pattern never joins a space or an end of line to the character before it,
    so a text may be cut before every single one that stands between two other characters:
    the pieces' ids in a row are the text's ids. Pieces recur, and their ids are remembered;
    the new ones of many texts are learned at once. Texts with other white space next to a
    space are cut there too by a plain split, so these take a pattern instead.
    """

    def __init__(self, path: str, width: int, plain: bool = False):
        """``plain``: as the library does unasked, special tokens' names in a text are those tokens; else ordinary text."""
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not plain
        self.kind = "H" if width == 2 else "I"
        made = json.loads(self.tokenizer.to_str())
        plainly = made["normalizer"] is None and (made["pre_tokenizer"] or {}).get("type") == "ByteLevel"
        plainly = plainly and not any(_WORD.fullmatch(x["content"]) for x in made["added_tokens"])
        #: A space and letters, or marks, are one piece of the pattern, which its model can be asked for directly.
        self.direct = plainly and made["model"]["type"] == "BPE" and sys.byteorder == "little"
        self.model = self.tokenizer.model  # asking the tokenizer for it makes a new object each time
        self.coded = [i.to_bytes(width, "little") for i in range(max(self.tokenizer.get_vocab().values(), default=-1) + 1)]
        # by the word after a space, or by an end of line and the word after it; none has other white space at its ends
        self.words: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}  # words of the time before, of which those met again come back
        self.parts: dict[str, bytes] = {"": b""}  # marks that end words, and what begins a line

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.words) + len(self.parts) > MEMORY // 2:
            self.forget()
        heads, rests = map(list, zip(*map(self.split, texts), strict=True)) if texts else ([], [])
        cut = pc.split_pattern(pa.array(rests, pa.large_string()), " ")
        del rests
        bounds, words = cut.offsets.to_numpy(), cut.values.dictionary_encode()
        del cut
        ids = pa.array(self.known(words.dictionary.to_pylist()), pa.large_binary()).take(words.indices)  # in a row in its buffer
        apart = np.array([" \n" in x for x in texts], bool)
        if ids.null_count:
            apart |= np.diff(np.append(0, np.cumsum(ids.is_null()))[bounds]) > 0
        starts, data = np.frombuffer(ids.buffers()[1], np.int64)[bounds].tolist(), memoryview(ids.buffers()[2] or b"")
        out = [data[a:b] for a, b in zip(starts, starts[1:], strict=False)]
        for i in np.flatnonzero(apart).tolist():
            heads[i], *pieces = (_CUT if self.direct else _SPACE).split(texts[i])
            out[i] = self.apart(pieces)
        return [b"".join(x) for x in zip(self.ids(heads), out, strict=True)]

    def split(self, text: str) -> tuple[str, str | None]:
        """What comes before the first space, and the rest, with a space before an end of line that a word follows."""
        if self.direct:
            text = _LINE.sub(" \n", text)
        head, space, rest = text.partition(" ")
        return head, rest if space else None

    def apart(self, pieces: list[str]) -> bytes:
        """Ids of pieces that a plain split might not have given; those that it would not are not remembered."""
        kinds = list(set(pieces))
        found = dict(zip(kinds, self.known(kinds), strict=True))
        odd = [w for w in kinds if found[w] is None]
        found.update(zip(odd, self.after(odd), strict=True))
        return b"".join([found[w] for w in pieces])

    def forget(self) -> None:
        """Words that were not met since the time before go."""
        self.before, self.words, self.parts = self.words, {}, {"": b""}

    def known(self, kinds: Collection[str]) -> list[bytes | None]:
        """Ids of words, which are learned if they are new; None for those with other white space in or around them."""
        found = list(map(self.words.get, kinds))
        self.learn([w for w, x in zip(kinds, found, strict=True) if x is None])
        return list(map(self.words.get, kinds)) if None in found else found

    def learn(self, new: list[str]) -> None:
        """Remember the ids of words. Letters, the marks after them and a line's end are apart in the pattern."""
        words, before, parts, direct, one = self.words, self.before, self.parts, self.direct, self.one
        match = (_WORD if direct else _TAILED).fullmatch
        cuts, ends, whole = [], set(), []
        for word in new:
            if word in before:
                words[word] = before[word]
            elif direct and word.isascii() and word.isalpha():
                words[word] = one(word)
            elif found := match(word):
                line, letters, marks = found.groups()
                if line or letters and marks:
                    cuts.append((word, line, letters, marks))
                    ends.update((line, letters, marks) if line else (marks,))
                else:
                    words[word] = one(word)
            elif " " not in word and word.strip() == (word[1:] if direct and word[:1] == "\n" else word) != "":
                whole.append(word)
        words.update(zip(whole, self.after(whole), strict=True))
        more = list(ends.difference(parts))
        parts.update(zip(more, self.ids(more), strict=True))
        for word, line, letters, marks in cuts:
            if line:
                words[word] = parts[line] + parts[letters] + parts[marks]
                continue
            if letters not in words:
                words[letters] = before[letters] if letters in before else one(letters)
            words[word] = words[letters] + parts[marks]

    def one(self, word: str) -> bytes:
        """Ids of a space and a word that are one piece of the pattern."""
        if not self.direct:
            return self.after([word])[0]
        text = word if word.isascii() else word.encode().decode("latin-1").translate(_LETTER)
        coded = self.coded
        return b"".join([coded[t.id] for t in self.model.tokenize(_SPACED + text)])

    def after(self, words: list[str]) -> list[bytes]:
        """Ids of words, each with the space or the end of line before it."""
        return self.ids([w if w[:1] == "\n" else " " + w for w in words])

    def ids(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for i in range(0, len(texts), CALL):
            found = self.tokenizer.encode_batch_fast(texts[i : i + CALL], add_special_tokens=False)
            if sys.byteorder == "big":
                out += [np.array(x.ids, self.kind).byteswap().tobytes() for x in found]
            else:
                out += [array(self.kind, x.ids).tobytes() for x in found]
        return out


@lru_cache(maxsize=1)
def encoder(path: str, width: int, plain: bool) -> Encoder:
    """A worker's encoder, which remembers words from batch to batch."""
    return Encoder(path, width, plain)


def id_width(tokenizer: str) -> int:
    """Bytes of an id: 2 or 4, by the size of the vocabulary."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else 4


def encode_rows(tokenizer: str, width: int, plain: bool):
    """Rows ``kind, doc_id, row, value``: the ids of a document, and its id and length for the index.

    ``row`` tells a task's documents apart, so both kinds have them in one order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, first = encoder(tokenizer, width, plain).encode, 0
        for docs, texts in gathered(batches):
            ids = encode(texts)
            sizes = [doc.to_bytes(8, "little", signed=True) + (len(x) // width + 1).to_bytes(8 - width, "little") for doc, x in zip(docs, ids, strict=True)]
            kinds, rows = pa.array(["ids"] * len(docs) + ["sizes"] * len(docs)), np.arange(first, first + len(docs))
            first += len(docs)
            yield batch(kind=kinds, doc_id=pa.array(docs + docs, pa.int64()), row=np.concatenate([rows, rows]), value=pa.array(ids + sizes, pa.binary()))

    return run


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[str]]]:
    """Ids and texts of so many rows that they make ``ENCODE_BYTES``."""
    docs, texts, size = [], [], 0
    for rows in batches:
        docs += rows.column("doc_id").to_pylist()
        texts += rows.column("text").to_pylist()
        size += rows.column("text").nbytes
        if size >= ENCODE_BYTES:
            yield docs, texts
            docs, texts, size = [], [], 0
    if docs:
        yield docs, texts


def write_raw(df: DataFrame, path: str, width: int, *folders: str) -> None:
    """Values of ``df`` in row order, each followed by ``width`` zero bytes, in folders by the columns named."""
    rows = df.select(*folders, F.col("value").cast("string").alias("value"))
    rows.write.option("lineSep", "\0" * width).option("maxRecordsPerFile", 0).partitionBy(*folders).text(path)


def read_parts(spark: SparkSession, path: str, number: str) -> DataFrame:
    """``part, content`` of the files below ``path``; ``number`` is the pattern of the part in a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(path)
    return files.select(F.regexp_extract("path", number, 1).cast("int").alias("part"), "content")


def part_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encoder.cache_clear()  # workers are used again, and have encoded enough
    for rows in batches:
        sums = [int(np.frombuffer(x, "<i8")[1::2].sum()) for x in rows.column("content").to_pylist()]
        yield batch(part=rows.column("part"), n=pa.array(sums, pa.int64()))


def offset_rows(bases: dict[int, int]):
    """Rows ``part, row, value`` of the index: sizes summed up, from the base of each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for part, content in zip(rows.column("part").to_pylist(), rows.column("content").to_pylist(), strict=True):
                table = np.frombuffer(content, "<i8").reshape(-1, 2).copy()
                table[:, 1] = bases[part] + np.cumsum(table[:, 1]) - table[:, 1]
                if table[-1, 1] >= 1 << 56:
                    raise ValueError("offsets of 2**56 and more do not fit")
                values = [x.tobytes()[:-1] for x in table]
                yield batch(
                    part=np.full(len(values), part, np.int32),
                    row=np.arange(len(values), dtype=np.int64),
                    value=pa.array(values, pa.binary()),
                )

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, plain: bool = False) -> None:
    """Encode ``docs`` and write ids and index below ``path``, which must be new.

    ``tokenizer``: its file, which all executors can open. Null texts count as empty;
    every document ends with id 0, so an empty one is that id alone. With ``plain`` the
    names of special tokens in a text are those tokens, else ordinary text. Rows without doc_id
    are left out; rows that repeat a doc_id are written once each, one after another, over
    as many files as they need. An empty table gives an empty folder.
    """
    spark, texts, width = docs.sparkSession, texts_of(docs), id_width(tokenizer)
    size = texts.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    ties = (F.xxhash64("text"), F.monotonically_increasing_id())
    placed = texts.repartitionByRange(by_rows(spark, size, FILE_BYTES), "doc_id", *ties)
    rows = mapped(placed, encode_rows(tokenizer, width, plain), "kind string, doc_id long, row long, value binary")
    write_raw(rows.sortWithinPartitions("kind", "doc_id", "row"), f"{path}/data", width, "kind")
    if not size:
        return
    sizes = read_parts(spark, f"{path}/data/kind=sizes", FILE_PART)
    totals = mapped(sizes, part_sizes, "part int, n long").orderBy("part").collect()  # one short row per file
    bases, total = {}, 0
    for part, n in totals:
        bases[part] = total
        total += n
    index = mapped(sizes, offset_rows(bases), "part int, row long, value binary")
    write_raw(index.sortWithinPartitions("part", "row"), f"{path}/index", 1, "part")


def read_token_files(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (of the ids as 32-bit integers), from the files."""
    width = id_width(tokenizer)
    ids = read_parts(spark, f"{path}/data/kind=ids", FILE_PART)
    index = read_parts(spark, f"{path}/index", FOLDER_PART).withColumnRenamed("content", "entries")
    small = (index.agg(F.sum(F.octet_length("entries"))).first()[0] or 0) <= INDEX_BYTES
    joined = ids.join(F.broadcast(index) if small else index, "part")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder.cache_clear()
        for rows in batches:
            for content, entries in zip(rows.column("content"), rows.column("entries"), strict=True):
                tokens = np.frombuffer(content.as_buffer(), f"<u{width}")
                yield described(tokens, np.frombuffer(entries.as_buffer(), "<i8").reshape(-1, 2))

    return mapped(joined, documents, TABLE)


def described(tokens: np.ndarray, table: np.ndarray) -> pa.RecordBatch:
    start = table[:, 1].astype(np.int64)
    bounds = np.append(start - start[0], len(tokens))
    sums = [zlib.crc32(tokens[a:b].astype("<u4").tobytes()) for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False)]
    return batch(doc_id=table[:, 0].astype(np.int64), start=start, n_tokens=np.diff(bounds), ids_crc32=np.array(sums, np.int64))


class TokenFiles:
    """Memory-mapped view of token files on a mounted path: ``files[i]`` are the ids of the i-th document."""

    def __init__(self, path: str | Path, width: int):
        root = Path(str(path).removeprefix("file://").removeprefix("file:"))
        entries = {int(re.search(FOLDER_PART, str(p))[1]): p for p in root.glob("index/*/part-*")}
        ids = {int(re.search(FILE_PART, str(p))[1]): p for p in root.glob("data/kind=ids/part-*")}
        self.ids = [np.memmap(ids[part], f"<u{width}", "r") for part in sorted(entries)]
        self.index = [np.memmap(entries[part], "<i8", "r").reshape(-1, 2) for part in sorted(entries)]
        self.firsts = np.cumsum([0, *(len(x) for x in self.index)])

    def __len__(self) -> int:
        return int(self.firsts[-1])

    def __getitem__(self, i: int) -> np.ndarray:
        if not 0 <= i < len(self):
            raise IndexError(i)
        part = int(np.searchsorted(self.firsts, i, side="right")) - 1
        starts, at = self.index[part][:, 1], i - int(self.firsts[part])
        end = int(starts[at + 1] - starts[0]) if at + 1 < len(starts) else len(self.ids[part])
        return self.ids[part][int(starts[at] - starts[0]) : end]


def token_table(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write ``docs`` as token files in the shared folder and describe each document from them.

    The ids are those of the library's plain call, with special tokens where a text names them.
    """
    spark, path = docs.sparkSession, workspace(docs.sparkSession, "tokens")
    if texts_of(docs).isEmpty():
        return spark.createDataFrame([], TABLE)
    write_token_files(docs, path, tokenizer, plain=True)
    return read_token_files(spark, path, tokenizer)
