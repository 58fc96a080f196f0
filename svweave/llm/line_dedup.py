"""Operator 11, line dedup over levelled sorted runs of line hashes.

Documents come in batches. A batch's lines become 128-bit digests with the number of documents that hold them; those that a
compacted run already knows to be frequent leave by a merge anti-join, the rest is written as a sorted run of its own. A
level that has ``fan_in`` runs is compacted: its runs are merged into one of the next level, where documents of equal digests
add up. Runs are bucketed and sorted by digest, so the runs' side of an anti-join doesn't move; a compaction moves digests and
counts alone. What is frequent after the last compaction is joined with the digests of each pack of documents, and the packs'
texts are cut.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NO_ID, discard, free_shuffles, new_folder, packs, stored, unpack

SPACE = b" \t\n\x0b\x0c\r"
#: Batches of one call, and runs of a level that are compacted into one of the next.
BATCHES, FAN_IN = 8, 4


def line_keys(text: bytes, min_chars: int) -> list[bytes]:
    """Digest of each line's key (stripped, A-Z lower-cased), empty for keys of fewer than ``min_chars`` code points."""
    import xxhash

    keys = [line.strip(SPACE).lower() for line in text.split(b"\n")]
    short = lambda k: len(k) < 4 * min_chars and len(k.decode()) < min_chars
    return [b"" if short(k) else xxhash.xxh3_128_digest(k) for k in keys]


def _texts(ends: np.ndarray, body: bytes) -> Iterator[bytes]:
    at = 0
    for end in ends.tolist():
        yield body[at:end]
        at = end


def pack_keys(table: DataFrame, min_chars: int) -> DataFrame:
    """``pack, hi, lo, n``: each digest of a pack with the number of its documents that hold it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for pack, ends, body in zip(*(c.to_pylist() for c in b.columns)):
                _, ends, body, _ = unpack(b"", ends, body)
                found: Counter = Counter()
                for text in _texts(ends, body):
                    found.update(set(line_keys(text, min_chars)))
                found.pop(b"", None)
                halves = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
                columns = [np.full(len(halves), pack), halves[:, 0], halves[:, 1], np.fromiter(found.values(), np.int64, len(found))]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["pack", "hi", "lo", "n"])

    return table.select("pack", "ends", "body").mapInArrow(count, "pack long, hi long, lo long, n long")


class LineRuns:
    """Digests of lines with the number of documents that hold them, in levels of sorted runs."""

    def __init__(self, spark: SparkSession, min_docs: int, fan_in: int = FAN_IN) -> None:
        self.spark, self.min_docs, self.fan_in = spark, min_docs, fan_in
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = []

    def _write(self, rows: DataFrame, level: int) -> None:
        path = new_folder(self.spark, "lines")
        name = path.rsplit("/", 1)[1].replace("-", "_")
        rows.repartition(self.buckets, "hi", "lo").write.bucketBy(self.buckets, "hi", "lo").sortBy("hi", "lo").option("compression", "zstd").option("path", path).saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append((name, path))

    def _drop(self, runs: list[tuple[str, str]]) -> None:
        for name, path in runs:
            table = self.spark.table(name)
            table.stored_path = path
            self.spark.sql(f"DROP TABLE {name}")
            discard(table)

    def add(self, batch: DataFrame) -> None:
        """``batch`` (``hi, lo, n``) without what is known to be frequent becomes a run; full levels are compacted."""
        rows = batch.groupBy("hi", "lo").agg(F.sum("n").alias("n"))
        for name, _ in sum(self.levels[1:], []):
            rows = rows.join(self.spark.table(name).filter(F.col("n") >= self.min_docs).hint("merge"), ["hi", "lo"], "left_anti")
        self._write(rows, 0)
        level = 0
        while len(self.levels[level]) >= self.fan_in:
            self.compact(level)
            level += 1

    def compact(self, level: int) -> None:
        """The runs of all levels up to ``level`` become one run of the next."""
        runs = sum(self.levels[: level + 1], [])
        # plain files: over tables in buckets, Spark 4.1 takes the union as dealt by digest while it isn't
        merged = reduce(DataFrame.unionAll, [self.spark.read.schema("hi long, lo long, n long").parquet(path) for _, path in runs]).groupBy("hi", "lo").agg(F.sum("n").alias("n"))
        self._write(merged, level + 1)
        self.levels[: level + 1] = [[] for _ in range(level + 1)]
        self._drop(runs)

    def frequent(self) -> DataFrame:
        """``hi, lo`` of lines that at least ``min_docs`` documents hold."""
        if sum(map(len, self.levels)) > 1:
            self.compact(len(self.levels) - 1)
        return self.spark.table(self.levels[-1][0][0]).filter(F.col("n") >= self.min_docs).select("hi", "lo")

    def close(self) -> None:
        self._drop(sum(self.levels, []))
        self.levels = []


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = BATCHES, fan_in: int = FAN_IN) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept`` for each row of ``docs`` (``doc_id, text``).

    Lines are what ``\\n`` separates; a null or empty text is one empty line. A line's key is the line without white space at
    both ends and with A-Z in lower case. Keys of at least ``min_chars`` code points that at least ``min_docs`` rows hold lose
    all their lines; the others stay as they are, joined by ``\\n``. A row is a document: rows that repeat an id or a text, and
    rows without an id, count one each; a line repeated within a row counts once. Keys are equal if their 128-bit digests are.
    A text of which no line is left is empty. An empty table gives no rows.
    """
    spark = docs.sparkSession
    path = new_folder(spark, "line-packs")
    packs(docs).withColumn("batch", F.pmod(F.xxhash64("pack"), F.lit(batches))).write.partitionBy("batch").parquet(path)
    table = spark.read.schema("pack long, ids binary, ends binary, body binary, batch long").parquet(path)
    runs = LineRuns(spark, min_docs, fan_in)
    try:
        for batch in range(batches):
            runs.add(pack_keys(table.filter(F.col("batch") == batch), min_chars))
            free_shuffles(spark)
        hits = pack_keys(table, min_chars).join(runs.frequent(), ["hi", "lo"], "left_semi")
        lists = stored(hits.groupBy("pack").agg(F.collect_list(F.struct("hi", "lo")).alias("gone")), "line-hits")
    finally:
        runs.close()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, ends, body, gone in zip(*(c.to_pylist() for c in b.columns)):
                ids, ends, body, _ = unpack(ids, ends, body)
                drop = {np.array([x["hi"], x["lo"]], "<i8").tobytes() for x in gone or []}
                kept, lines, dropped = [], [], []
                for text in _texts(ends, body):
                    stay = [line for line, k in zip(text.split(b"\n"), line_keys(text, min_chars)) if k not in drop] if drop else None
                    n = text.count(b"\n") + 1
                    kept.append((text if stay is None else b"\n".join(stay)).decode())
                    lines.append(n)
                    dropped.append(0 if stay is None else n - len(stay))
                ids = pa.array(ids, mask=ids == NO_ID)
                yield pa.RecordBatch.from_arrays([ids, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_lines", "n_dropped", "kept"])

    found = table.join(lists.hint("merge"), "pack", "left").select("ids", "ends", "body", "gone")
    return found.mapInArrow(cut, "doc_id long, n_lines long, n_dropped long, kept string")
