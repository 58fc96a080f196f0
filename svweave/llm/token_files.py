"""Operator 2, token-id files: independent zstandard frames, a frame index and a trailing seek table with checksums.

A file is a sequence of zstandard frames, one a document, holding its ids as little-endian unsigned 32-bit integers; then
a skippable frame with the documents' ids (signed 64-bit); then the seek table of the public zstandard seekable format
with a checksum (low 32 bits of XXH64) for each frame. A reader needs the tail to find a document and decompresses that
document's frame alone. Files hold ascending ranges of doc_id and are written by Spark's own committer: a task's single row
is the file without its last four bytes, which the text writer adds as its row separator (the seek table's magic number).
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import NO_ID, doc_batches, mixed, words_of

#: Fixed values of the public formats.
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEK_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUM_FLAG = 0x80
#: Raw bytes of text that one file is meant for.
FILE_TEXT_BYTES = 16 << 20
TIE_LETTERS = 16
#: Ranges of ids at most: beyond, tasks write several files.
MOST_RANGES = 1 << 14
CACHED_WORDS, SLOT_BITS = 500_000, 21
#: Masks of the lowest 0 to 8 bytes.
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


class WordEncoder:
    """Encodes texts word by word with the tokenizers library, keeping the ids of words seen before.

    Words are found and looked up as arrays: a word of at most 16 bytes is two integers and its length, which pick a slot of
    a table and are compared with the word kept there, so a hit is exact. Longer words, and those whose slot holds another
    one, are looked up by their bytes. Holds for a tokenizer whose pre-tokenizer drops white space, so that no token spans
    two words; others are refused.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        first = (parts["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        if not (first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and not parts["truncation"]):
            raise ValueError("the tokenizer doesn't drop white space between words")
        if "Lowercase" not in json.dumps(parts["normalizer"]) or r"[^\\s\\p{L}\\p{N}]+" not in json.dumps(first):
            raise ValueError("the tokenizer doesn't drop case or doesn't part letters from marks")
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t["content"].encode() for t in parts["added_tokens"]]
        # row 0 is no word; a slot holds the row of the word that came to it first
        self.slots, self.rows, self.used = np.zeros(1 << SLOT_BITS, np.int32), 1, 0
        self.low, self.high, self.size, self.start, self.count = (np.zeros(1 << 12, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
        self.ids = np.zeros(1 << 14, np.uint32)
        self.more: dict[bytes, int] = {}

    def add(self, words: list[bytes]) -> range:
        """Rows of new words."""
        coded = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        ids = [e.ids for e in coded]
        n = np.array([len(x) for x in ids], np.int64)
        at, end = self.rows, self.rows + len(words)
        while end > len(self.count):
            for name in ("low", "high", "size", "start", "count"):
                x = getattr(self, name)
                setattr(self, name, np.concatenate([x, np.zeros_like(x)]))
        while self.used + n.sum() > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + n.sum()] = np.fromiter(chain.from_iterable(ids), np.uint32, int(n.sum()))
        self.start[at:end], self.count[at:end] = self.used + np.cumsum(n) - n, n
        self.rows, self.used = end, self.used + int(n.sum())
        return range(at, end)

    def encode_all(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text; words that no text had before are encoded in one call."""
        marked = [self.has_special(t) for t in texts]
        plain = [b"" if m else t for t, m in zip(texts, marked)]
        ends = np.cumsum([len(t) for t in plain], dtype=np.int64)
        body = b"".join(plain).lower() + bytes(16)
        b = np.frombuffer(body, np.uint8)
        mark = np.flatnonzero((b == 46) | (b == 44))
        mark = mark[(mark > 0) & (b[mark - 1] >= 97) & (b[mark - 1] <= 122)]  # a mark after a letter starts a token of its own
        starts, stops, counts = words_of(body[:-16], ends, mark)
        size = stops - starts
        eight = np.ndarray((len(body) - 7,), "<u8", body, strides=(1,))
        low = eight[starts] & _LOW_BYTES[np.minimum(size, 8)]
        high = eight[np.minimum(starts + 8, len(body) - 8)] & _LOW_BYTES[np.clip(size - 8, 0, 8)]
        slot = (mixed(low + mixed(high + size.astype(np.uint64))) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        row = self.slots[slot].astype(np.int64)
        hit = (self.low[row] == low) & (self.high[row] == high) & (self.size[row] == size) & (size <= 16)
        keep, used = self.rows, self.used
        if len(miss := np.flatnonzero(~hit)):
            words = [body[s:e] for s, e in zip(starts[miss].tolist(), stops[miss].tolist())]
            new = list(set(words).difference(self.more))
            found = dict(zip(new, self.add(new))) if new else {}
            row[miss] = [found[w] if w in found else self.more[w] for w in words]
            if keep <= CACHED_WORDS:  # the words kept are those seen first, so mostly the frequent ones
                lead = miss[np.unique(row[miss], return_index=True)[1]]
                lead = lead[(size[lead] <= 16) & (row[lead] >= keep) & (self.slots[slot[lead]] == 0)]
                lead = lead[np.unique(slot[lead], return_index=True)[1]]
                r = row[lead]
                self.low[r], self.high[r], self.size[r], self.slots[slot[lead]] = low[lead], high[lead], size[lead], r
                slotted = set(r.tolist())
                self.more.update((w, k) for w, k in found.items() if k not in slotted)
                keep, used = self.rows, self.used
        n = self.count[row]
        upto = np.cumsum(n)
        flat = self.ids[np.repeat(self.start[row] - (upto - n), n) + np.arange(upto[-1] if len(upto) else 0)]
        out = np.split(flat, np.concatenate([[0], upto])[counts][:-1])
        self.rows, self.used = keep, used
        for k, t in enumerate(texts):
            if marked[k]:  # white space beside it may count: left to the library
                out[k] = np.array(self.tokenizer.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4")
        return out

    def has_special(self, text: bytes) -> bool:
        return any(s in text for s in self.special)


@lru_cache(2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def file_bytes(ids: list[int], frames: list[bytes], sizes: list[int], sums: list[int]) -> bytes:
    """A whole file but for the closing magic number."""
    index = np.array(ids, "<i8").tobytes()
    all_frames = [*frames, struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index]
    table = b"".join(struct.pack("<III", len(f), n, c) for f, n, c in zip(all_frames, [*sizes, 0], [*sums, 0]))
    footer = struct.pack("<IB", len(all_frames), CHECKSUM_FLAG)
    return b"".join(all_frames) + struct.pack("<II", SKIPPABLE_SEEK, len(table) + len(footer) + 4) + table + footer


def seek_table(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents' ids, start of each frame, and for each frame its length, raw size and checksum; ``ValueError`` if damaged."""
    if len(raw) < 9 or struct.unpack_from("<I", raw, len(raw) - 4)[0] != SEEK_MAGIC:
        raise ValueError("no seek table at the end of the file")
    n, flags = struct.unpack_from("<IB", raw, len(raw) - 9)
    if flags != CHECKSUM_FLAG or len(raw) < 17 + 12 * n:
        raise ValueError("the seek table is damaged")
    table = np.frombuffer(raw, "<u4", 3 * n, len(raw) - 9 - 12 * n).reshape(n, 3)
    at = np.concatenate([[0], np.cumsum(table[:, 0], dtype=np.int64)])
    return np.frombuffer(raw, "<i8", n - 1, int(at[n - 1]) + 8), at, table


def read_file(raw: bytes, wanted: set[int] | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """Documents of a file in their order; with ``wanted``, only the frames of those ids are decompressed.

    A damaged tail or a frame that doesn't agree with its checksum raises ``ValueError``.
    """
    import xxhash
    import zstandard

    ids, at, table = seek_table(raw)
    open_frame = zstandard.ZstdDecompressor()
    for k, i in enumerate(ids.tolist()):
        if wanted is None or i in wanted:
            body = open_frame.decompress(raw[at[k] : at[k + 1]], max_output_size=int(table[k, 1])) if table[k, 1] else b""
            if xxhash.xxh64_intdigest(body) & 0xFFFFFFFF != table[k, 2]:
                raise ValueError(f"the frame of document {i} is damaged")
            yield i, np.frombuffer(body, "<u4")


def write_tokens(df: DataFrame, path: str, tokenizer: str, end_id: int | None = 2, level: int = 1, file_bytes_target: int = FILE_TEXT_BYTES) -> None:
    """Encode ``doc_id, text`` and write the files under ``path`` in ascending ``doc_id`` order.

    Null texts count as empty and have the end id alone; null ids come last, written as the largest 64-bit number. Rows that
    repeat an id follow each other in order of the text's first ``TIE_LETTERS`` characters, then of its hash, and may lie in
    several files. An empty input leaves a folder of files without documents. There are at most ``MOST_RANGES`` ranges of ids,
    whose tasks begin a new file once one holds two times ``file_bytes_target`` bytes of text.
    """
    size = df.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, min(MOST_RANGES, -(-size // file_bytes_target)))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        import zstandard

        press, words, end = zstandard.ZstdCompressor(level=level), encoder(tokenizer), b"" if end_id is None else struct.pack("<I", end_id)
        ids, frames, sizes, sums, held, none = [], [], [], [], 0, True

        def file() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([file_bytes(ids, frames, sizes, sums)], pa.binary())], ["file"])
            for part in (ids, frames, sizes, sums):
                part.clear()
            return out

        for some, texts in doc_batches(batches):
            if ids and held >= 2 * file_bytes_target:
                yield file()
                held, none = 0, False
            held += sum(map(len, texts))
            for i, tokens in zip(some.tolist(), words.encode_all(texts)):
                body = tokens.astype("<u4", copy=False).tobytes() + end
                ids.append(i)
                frames.append(press.compress(body) if body else b"")
                sizes.append(len(body))
                sums.append(xxhash.xxh64_intdigest(body) & 0xFFFFFFFF)
        if ids or none:
            yield file()

    tie = [F.substring("text", 1, TIE_LETTERS), F.xxhash64("text")]
    ordered = df.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text").repartitionByRange(ranges, "doc_id", *tie).sortWithinPartitions("doc_id", *tie)
    magic = struct.pack("<I", SEEK_MAGIC).decode("latin-1")
    ordered.mapInArrow(encode, "file binary").select(F.col("file").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", magic).text(path)


def read_tokens(spark: SparkSession, path: str, wanted: list[int] | None = None) -> DataFrame:
    """``file, place, doc_id, ids``: the files' documents; with ``wanted``, those documents alone."""
    only = None if wanted is None else set(wanted)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, raw in zip(b.column(0).to_pylist(), b.column(1)):
                rows, size = [], 0
                for place, (i, ids) in enumerate(read_file(raw.as_py(), only)):
                    rows.append((name, place, None if i == NO_ID else i, ids.tobytes()))
                    size += ids.nbytes
                    if size > 4 << 20:
                        yield _rows(rows)
                        rows, size = [], 0
                if rows:
                    yield _rows(rows)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(parse, "file string, place long, doc_id long, ids binary")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    f, p, i, b = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(f, pa.string()), pa.array(p, pa.int64()), pa.array(i, pa.int64()), pa.array(b, pa.binary())], ["file", "place", "doc_id", "ids"])


def file_totals(spark: SparkSession, path: str) -> DataFrame:
    """``file, first, n``: each file's first document and number of ids, from its seek table alone."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, raw in zip(b.column(0).to_pylist(), b.column(1)):
                ids, _, table = seek_table(raw.as_py())
                if len(ids):
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array(ids[:1]), pa.array([int(table[:, 1].sum(dtype=np.int64)) // 4])], ["file", "first", "n"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(parse, "file string, first long, n long")


def summary(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of the documents read back; a start counts the ids of all documents before.

    Running sums are per file; only a row a file goes through the single-partition window over the files' totals.
    """
    rows = read_tokens(spark, path).select("file", "place", "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
    before = Window.orderBy("first", "file").rowsBetween(Window.unboundedPreceding, -1)
    files = file_totals(spark, path).select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("in_files"))
    inside = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    run = rows.withColumn("in_file", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return run.join(files, "file").select("doc_id", (F.col("in_files") + F.col("in_file")).alias("start"), "n_tokens", "ids_crc32")
