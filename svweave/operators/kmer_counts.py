"""Counts of k-mers as numbers: texts are cut where the minimizer changes, pieces of one minimizer meet in one bucket."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters of a minimizer, buckets, letters that are worked on together, most k-mers of a piece.
M, BUCKETS, PACK, LONGEST = 11, 512, 1 << 21, 200
CODES = np.full(256, 4, np.uint8)
CODES[list(b"ACGT")] = range(4)


def codes_at(letters: np.ndarray, k: int) -> np.ndarray:
    """The number of the ``k`` letters (0 to 3) from each place on, by doubling; ``k`` is 31 at most."""
    out, size, power = None, 1, letters.astype(np.int64)
    done = 0
    while True:
        if k & size:
            n = len(letters) - done - size + 1
            out = power[:n] if out is None else (out[:n] << (2 * size)) | power[done : done + n]
            done += size
        if done == k:
            return out
        power = (power[:-size] << (2 * size)) | power[size:]
        size *= 2


def turned(codes: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the reverse complements."""
    x = ~codes.astype(np.uint64)
    for shift, mask in ((2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F)):
        x = ((x >> np.uint64(shift)) & np.uint64(mask)) | ((x & np.uint64(mask)) << np.uint64(shift))
    return (x.byteswap() >> np.uint64(64 - 2 * k)).astype(np.int64)


def canonical(codes: np.ndarray, k: int) -> np.ndarray:
    """The smaller of each number and its reverse complement's: numbers are in the order of their strings."""
    return np.minimum(codes, turned(codes, k))


def texts_of(codes: np.ndarray, k: int) -> pa.Array:
    letters = np.frombuffer(b"ACGT", np.uint8)[(codes[:, None] >> (2 * np.arange(k - 1, -1, -1))) & 3]
    return pa.StringArray.from_buffers(len(codes), pa.py_buffer((np.arange(len(codes) + 1) * k).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(letters)))


def pieces(text: bytes, k: int, m: int = M, around: bool = False, skip: list[int] = ()) -> Iterator[tuple[int, bytes]]:
    """A bucket and its pieces of ``text``, packed: their number, their k-mers' numbers, and letters of two bits. K-mers with other letters are left out.

    With ``around`` a piece has the letter before and the letter after it too, and a byte that tells if these count (bits 1 and 2).
    K-mers at ``skip`` are left out.
    """
    letters = CODES[np.frombuffer(text, np.uint8)]
    n = len(letters) - k + 1
    if n <= 0:
        return
    wrong = np.concatenate([[0], np.cumsum(letters > 3)])
    fine = wrong[k:] == wrong[:-k]
    fine[list(skip)] = False
    small = canonical(codes_at(letters & 3, m), m).astype(np.uint64)
    rank = (small * np.uint64(0x9E3779B97F4A7C15)) ^ (small >> np.uint64(7))
    width, size, low = k - m + 1, 1, rank
    while 2 * size <= width:  # the least of a window is that of two shorter ones
        low, size = np.minimum(low[:-size], low[size:]), 2 * size
    low = np.minimum(low[:n], low[width - size :][:n])
    new = np.ones(n, bool)
    new[1:] = (low[1:] != low[:-1]) | (fine[1:] != fine[:-1])
    first = np.flatnonzero(new)
    # long runs of one minimizer are cut, so that a byte holds their number
    reach = np.diff(np.append(first, n))
    parts = -(-reach // LONGEST)
    first = np.repeat(first, parts) + LONGEST * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    count = np.diff(np.append(first, n))
    first, count = first[fine[first]], count[fine[first]]
    if not len(first):
        return
    bucket = ((low[first] >> np.uint64(33)) % np.uint64(BUCKETS)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    first, count, bucket = first[order], count[order], bucket[order]
    size = -(-(count + k - 1 + 2 * around) // 4)
    upto = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(4 * upto[-1]) + np.repeat(first - around - 4 * upto[:-1], 4 * size)
    four = (letters & 3)[np.clip(at, 0, len(letters) - 1)].reshape(-1, 4)
    packed = ((four[:, 0] << 6) | (four[:, 1] << 4) | (four[:, 2] << 2) | four[:, 3]).astype(np.uint8).tobytes()
    numbers, sides = count.astype(np.uint8).tobytes(), b""
    if around:
        ended = np.concatenate([letters, [4]])  # the last stands for what is before and after the text, too
        sides = ((ended[first - 1] < 4) | ((ended[np.minimum(first + count + k - 1, len(letters))] < 4) << 1)).astype(np.uint8).tobytes()
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)]):
        yield int(bucket[a]), (b - a).to_bytes(4, "little") + numbers[a:b] + sides[a:b] + packed[upto[a] : upto[b]]


def letters_of(rows: list[bytes], k: int, around: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Letters of packed pieces, the place of each k-mer in them, and the pieces' numbers of k-mers and bytes for their sides."""
    counts = [np.frombuffer(r, np.uint8, int.from_bytes(r[:4], "little"), 4) for r in rows]
    sides = [np.frombuffer(r, np.uint8, len(c), 4 + len(c)) for r, c in zip(rows, counts)] if around else [np.zeros(0, np.uint8)]
    raw = np.frombuffer(b"".join(r[4 + (1 + around) * len(c) :] for r, c in zip(rows, counts)), np.uint8)
    count = np.concatenate(counts).astype(np.int64)
    letters = np.stack([raw >> 6, (raw >> 4) & 3, (raw >> 2) & 3, raw & 3], 1).reshape(-1)
    size = 4 * (-(-(count + k - 1 + 2 * around) // 4))
    first = np.cumsum(size) - size + around
    at = np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)
    return letters, at, count, np.concatenate(sides)


def unpacked(rows: list[bytes], k: int) -> np.ndarray:
    """Numbers of the canonical k-mers of packed pieces."""
    letters, at, _, _ = letters_of(rows, k)
    return canonical(codes_at(letters, k)[at], k)


def merged(known: tuple[np.ndarray, np.ndarray] | None, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted numbers and their counts with those of ``codes`` added."""
    one, n = np.unique(codes, return_counts=True)
    if known is None:
        return one, n
    every, place = np.unique(np.concatenate([known[0], one]), return_inverse=True)
    total = np.zeros(len(every), np.int64)
    total[place[: len(known[0])]] += known[1]
    total[place[len(known[0]) :]] += n
    return every, total


def packs(texts: list[bytes], k: int, around: bool = False) -> Iterator[tuple[bytes, list[int]]]:
    """Texts together, with a letter between them that no k-mer has, and the k-mers that stand in another part of a long text."""
    pack, filled, skip = [], 0, []
    for text in texts:
        for a in range(0, max(len(text) - k + 1, 0), PACK):
            low = max(a - around, 0)
            part = text[low : a + PACK + k - 1 + around]
            if pack and filled + len(part) > PACK:
                yield b"-".join(pack), skip
                pack, filled, skip = [], 0, []
            if around:
                skip += [filled] * (a > 0) + [filled + a + PACK - low] * (a + PACK + k <= len(text))
            pack.append(part)
            filled += len(part) + 1
    if pack:
        yield b"-".join(pack), skip


def dealt_pieces(seqs: DataFrame, k: int, by: list[str], m: int = M, around: bool = False) -> tuple[DataFrame, str]:
    """``*by, _bucket, _packed`` of ``seqs`` (:func:`pieces`), a bucket's rows one after another in one task, and the types of ``by``."""
    rows = seqs.select(*by, F.encode("seq", "UTF-8").alias("seq")).filter(F.length("seq") >= k)
    schema = rows.select(*by).schema
    names = [f.name for f in schema]
    head = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # texts of one collection together
            keys = list(zip(*(b.column(c).to_pylist() for c in names))) if names else [()] * len(b)
            held: dict[tuple, list[int]] = {}
            for i, key in enumerate(keys):
                held.setdefault(key, []).append(i)
            texts = b.column("seq")
            out = [(own[0], *p) for own in held.values() for pack, skip in packs((texts[i].as_py() for i in own), k, around) for p in pieces(pack, k, m, around, skip)]
            for a in range(0, len(out), 50_000):
                index, bucket, packed = zip(*out[a : a + 50_000])
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(index)) for c in names), pa.array(bucket, pa.int32()), pa.array(packed, pa.binary())], [*names, "_bucket", "_packed"])

    # few bytes but seconds of work: a number given keeps them from being gathered into few tasks
    dealt = rows.mapInArrow(cut, f"{head}_bucket int, _packed binary").repartition(int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by, "_bucket")
    return dealt.sortWithinPartitions(*by, "_bucket"), head


def pure_kmers(seqs: DataFrame, k: int, by: list[str], cutoff: float) -> DataFrame:
    """``*by, kmer, n`` of canonical k-mers of A, C, G, T above ``cutoff`` times.

    A k-mer and its reverse complement have one minimizer, so each is counted in one of ``BUCKETS`` buckets. Rows of a bucket come one
    after another, and a task keeps the bucket's different k-mers alone.
    """
    dealt, head = dealt_pieces(seqs, k, by)
    names = [f.name for f in dealt.select(*by).schema]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, known, waiting, held, kept, rows_kept, kinds = None, None, [], 0, [], 0, []

        def flushed() -> Iterator[pa.RecordBatch]:
            codes, n = (np.concatenate([x[j] for x in kept]) for j in (1, 2))
            own = [[v for key, c, _ in kept for v in [key[j]] * len(c)] for j in range(len(names))]
            for a in range(0, len(codes), 1 << 16):
                z = a + (1 << 16)
                yield pa.RecordBatch.from_arrays([*(pa.array(v[a:z], t) for v, t in zip(own, kinds)), texts_of(codes[a:z], k), pa.array(n[a:z].astype(np.int64))], [*names, "kmer", "n"])

        def close() -> None:
            nonlocal known, rows_kept
            if waiting:
                known = merged(known, unpacked(waiting, k))
            keep = known[1] > cutoff
            kept.append((at, known[0][keep], known[1][keep]))
            rows_kept += int(keep.sum())

        for b in batches:
            kinds = [b.column(c).type for c in names]
            keys = list(zip(*(b.column(c).to_pylist() for c in names), b.column("_bucket").to_pylist()))
            for key, packed in zip(keys, b.column("_packed")):
                if key != at:
                    if at is not None:
                        close()
                    if rows_kept >= 1 << 16:
                        yield from flushed()
                        kept, rows_kept = [], 0
                    at, known, waiting, held = key, None, [], 0
                waiting.append(packed.as_py())
                held += len(waiting[-1])
                if held > PACK:
                    known, waiting, held = merged(known, unpacked(waiting, k)), [], 0
        if at is not None:
            close()
            yield from flushed()

    return dealt.mapInArrow(count, f"{head}kmer string, n long")
