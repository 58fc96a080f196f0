"""Helpers the operators share: shared-folder tables, document packs and vectorised window hashes."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of other characters than these six (the contract's ``[^\x20\x09-\x0D]+``).
WORD = r"[^\x20\x09-\x0D]+"
#: Raw text bytes that one pack holds at most (a longer document has a pack of its own).
PACK_BYTES = 1 << 20
#: A null doc_id sorts after every other one.
NO_ID = np.iinfo(np.int64).max


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); without one, a temporary folder if Spark runs on this machine alone."""
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        root = spark.sparkContext.getCheckpointDir()
    return root


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def free_shuffles(spark: SparkSession) -> None:
    """Shuffles of earlier steps that nothing refers to any more may now be cleaned from the executors' disks."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def hand_back_memory() -> None:
    """What Python has freed goes back to the system, where the C library can do so: else it keeps it for ever."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    free_shuffles(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def stored_by(df: DataFrame, name: str, key: str, compression: str = "zstd") -> DataFrame:
    """:func:`stored` as a table in buckets of ``key``, so that what joins it by ``key`` later moves and it doesn't."""
    spark = df.sparkSession
    n, path = int(spark.conf.get("spark.sql.shuffle.partitions")), new_folder(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    df.repartition(n, key).write.bucketBy(n, key).option("compression", compression).option("path", path).saveAsTable(table)
    free_shuffles(spark)
    return spark.table(table)


def discard(*tables: DataFrame) -> None:
    """Delete :func:`stored` tables that nothing will read any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def text_table(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns named so that other columns of the input can't clash: ``doc_id``, ``text``."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def doc_batches(batches: Iterator[pa.RecordBatch], limit: int = PACK_BYTES) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Ids and UTF-8 texts (null: empty), cut so that a batch holds about ``limit`` bytes."""
    for b in batches:
        ids = np.array([NO_ID if x is None else x for x in b.column(0).to_pylist()], np.int64)
        texts, size, at = [], 0, 0
        for k, t in enumerate(b.column(1).cast(pa.binary())):
            t = t.as_py() or b""
            if texts and size + len(t) > limit:
                yield ids[at:k], texts
                texts, size, at = [], 0, k
            texts.append(t)
            size += len(t)
        if texts:
            yield ids[at:], texts


PACK_SCHEMA = "pack long, ids binary, ends binary, body binary, extra binary"


def packs(df: DataFrame, extra: Callable[[np.ndarray, np.ndarray, bytes], bytes] | None = None) -> DataFrame:
    """Documents as packs: ids, end offsets, the zstandard-compressed texts, and what ``extra`` makes of them.

    A pack's number comes from the task that reads it: write the packs once before joining anything to them.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        first, k = TaskContext.get().partitionId() << 32, 0
        press = zstandard.ZstdCompressor(level=3)
        for ids, texts in doc_batches(batches):
            ends, body = np.cumsum([len(t) for t in texts], dtype=np.int64), b"".join(texts)
            more = b"" if extra is None else press.compress(extra(ids, ends, body))
            yield pa.RecordBatch.from_arrays(
                [pa.array([first + k]), pa.array([ids.tobytes()]), pa.array([ends.tobytes()]), pa.array([press.compress(body)]), pa.array([more])],
                ["pack", "ids", "ends", "body", "extra"],
            )
            k += 1

    return df.select("doc_id", "text").mapInArrow(pack, PACK_SCHEMA)


def unpack(ids: bytes, ends: bytes, body: bytes, extra: bytes = b"") -> tuple[np.ndarray, np.ndarray, bytes, bytes]:
    import zstandard

    open_frame = zstandard.ZstdDecompressor()
    return np.frombuffer(ids, np.int64), np.frombuffer(ends, np.int64), open_frame.decompress(body), open_frame.decompress(extra) if extra else b""


# --- hashes -----------------------------------------------------------------------------------------------------------

_BYTE = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _powers = 0x9E3779B97F4A7C15, {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    if len(_powers.get("up", ())) < n:
        size = 1 << max(20, (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"][:n], _powers["down"][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Bits of a polynomial hash spread over the whole word (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def range_hashes(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of ``values[lo:hi]`` for each pair; equal contents give equal hashes wherever they stand."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[1:], out=sums[1:])
    return mixed((sums[hi] - sums[lo]) * down[lo] + (hi - lo).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def window_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of each ``k`` neighbouring values; its upper bits depend on all of them, its lower bits are poorer."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.multiply(values, up[1:], out=sums[1:])
    np.cumsum(sums, out=sums)
    out = sums[k:] - sums[:-k]
    out *= down[:n]
    return out


def hashes_at(values: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """:func:`window_hashes` at the places ``at`` alone."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.multiply(values, up[1:], out=sums[1:])
    np.cumsum(sums, out=sums)
    return (sums[at + k] - sums[at]) * down[at]


def byte_values(body: bytes) -> np.ndarray:
    return _BYTE[np.frombuffer(body, np.uint8)]


_IS_WORD = np.array([not (c == 32 or 9 <= c <= 13) for c in range(256)])


def words_of(body: bytes, ends: np.ndarray, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in ``body`` and, by document, how many words stand before its end.

    At the places ``cuts`` a word ends and another begins.
    """
    b = np.frombuffer(body, np.uint8)
    inside = np.zeros(len(b) + 2, bool)
    np.take(_IS_WORD, b, out=inside[1:-1])
    cut = np.zeros(len(b) + 1, bool)
    cut[ends] = True
    cut[0] = True
    if cuts is not None:
        cut[cuts] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    stops = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    return starts, stops, np.searchsorted(starts, ends, "left")


def word_values(body: bytes, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    return range_hashes(byte_values(body), starts, stops)


_AT = np.uint64((1 << 24) - 1)


def minimizers(h: np.ndarray, width: int, slice_size: int = 1 << 18) -> np.ndarray:
    """For each run of ``width`` neighbouring hashes the place of the smallest (upper 40 bits count; ties: leftmost).

    Equal runs choose the same offset wherever they stand, so what recurs has recurring choices.
    """
    n = len(h) - width + 1
    out = np.empty(max(n, 0), np.int64)
    for at in range(0, max(n, 0), slice_size):
        part = h[at : min(at + slice_size, n) + width - 1]
        low = part & ~_AT
        low |= np.arange(len(part), dtype=np.uint64)
        span = 1
        while span < width:
            step = min(span, width - span)
            low = np.minimum(low[:-step], low[step:])
            span += step
        low &= _AT
        np.add(low.view(np.int64), at, out=out[at : at + len(low)])
    return out


def windows_inside(ends: np.ndarray, k: int, n: int) -> np.ndarray:
    """Whether the window of ``k`` that starts at each of ``n`` places ends within its document."""
    ok = np.zeros(n + 1, np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    last = np.maximum(ends - k + 1, starts)
    np.add.at(ok, np.minimum(starts, n), 1)
    np.add.at(ok, np.minimum(last, n), -1)
    return np.cumsum(ok[:-1]) > 0


#: Fingerprints keep 48 bits.
FORTY_EIGHT = np.uint64((1 << 48) - 1)

