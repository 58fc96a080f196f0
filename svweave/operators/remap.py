"""Remapping: reads of a call against the reference at their own place and at the rearranged one, by local alignment."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import expr
from ..sources.shared import freed, stored
from .segments import collect_support_reads

#: Bases of a tile of the reference, and cells of one anti-diagonal that are worked on together.
TILE, CELLS = 4096, 1 << 15


def tiles(seqs: DataFrame, size: int = TILE) -> DataFrame:
    """``chr, tile, seq``: sequences ``chr, seq`` in tiles of ``size`` bases (the last may be shorter), in upper case."""
    at = F.explode(F.sequence(F.lit(0), F.floor((F.length("seq") - 1) / size).cast("int"))).alias("tile")
    cut = seqs.filter("length(seq) > 0").select("chr", "seq", at)
    return cut.select("chr", F.col("tile").cast("long").alias("tile"), F.upper(F.substring(F.col("seq"), F.col("tile") * size + 1, F.lit(size))).alias("seq"))


def fetch_regions(regions: DataFrame, reference: DataFrame, size: int = TILE) -> DataFrame:
    """``regions`` (``chr, lo, hi``, 1-based and closed) with ``seq``, the bases of ``reference`` (:func:`tiles`) there.

    Regions start at base 1 at least and end with the reference; null where it has none. Tiles are met by their numbers, so
    that no more than a region's own tiles move. Equal regions are fetched once.
    """
    wanted = regions.select("chr", "lo", "hi").distinct()
    base = F.greatest("lo", F.lit(1)) - 1
    first, last = F.floor(base / size), F.floor((F.col("hi") - 1) / size)
    parts = wanted.filter(F.col("hi") >= F.greatest("lo", F.lit(1))).select("*", F.explode(F.sequence(first, last)).alias("tile")).join(reference.select("chr", "tile", "seq"), ["chr", "tile"])
    # a tile's bases outside the region stay behind
    start = F.greatest(base - F.col("tile") * size, F.lit(0))
    piece = F.substring(F.col("seq"), (start + 1).cast("int"), (F.least(F.col("hi") - F.col("tile") * size, F.lit(size)) - start).cast("int"))
    whole = parts.select("chr", "lo", "hi", "tile", piece.alias("seq")).groupBy("chr", "lo", "hi").agg(F.array_sort(F.collect_list(F.struct("tile", "seq"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["seq"]), "")
    cut = whole.select(*(F.col(c).alias("_" + c) for c in ("chr", "lo", "hi")), text.alias("seq"))
    same = [F.col(c).eqNullSafe(F.col("_" + c)) for c in ("chr", "lo", "hi")]
    return regions.join(cut, same[0] & same[1] & same[2], "left").drop("_chr", "_lo", "_hi")


def _codes(texts: list[str], width: int, pad: int) -> np.ndarray:
    """Columns of letters, filled with ``pad``."""
    out = np.full((len(texts), width), pad, np.uint16)
    for row, t in zip(out, texts):
        raw = np.frombuffer(t.encode("latin-1", "replace"), np.uint8)
        row[: len(raw)] = raw
    return np.ascontiguousarray(out.T)


def batch_scores(reads: list[str], windows: list[str], match: int, mismatch: int, gap_open: int, gap_extend: int) -> np.ndarray:
    """Best local score of each read in its window; a gap of k letters costs ``gap_open + k * gap_extend``.

    All pairs advance together along anti-diagonals, of which the last two are kept: cell ``(i, j)`` stands at ``i`` of
    diagonal ``i + j``. Letters other than themselves mismatch; nothing matches what fills a shorter text. Pairs are columns, so
    that neighbouring cells of a diagonal are blocks.
    """
    m, n = max(map(len, reads), default=0), max(map(len, windows), default=0)
    if not m or not n:
        return np.zeros(len(reads), np.int32)
    kind = np.int16 if m * max(match, -mismatch) + n * gap_extend + gap_open < 1 << 14 else np.int32
    a = _codes(reads, m, 0)
    # the window runs backwards between m - 1 letters of filling, so that a diagonal's letters lie side by side
    b = np.full((n + 2 * (m - 1), len(reads)), 1, np.uint16)
    b[m - 1 : m - 1 + n] = _codes(windows, n, 1)[::-1]
    low, first = kind(-(1 << 14 if kind is np.int16 else 1 << 28)), kind(gap_open + gap_extend)
    extend, match, step = kind(gap_extend), kind(match), kind(match - mismatch)
    shape = (m + 1, len(reads))
    before, last, cell, across, down = (np.zeros(shape, kind) for _ in range(5))
    across[:], down[:] = low, low
    opened, fits, unlike = np.empty(shape, kind), np.empty((m, len(reads)), kind), np.empty((m, len(reads)), np.uint16)
    top = np.zeros((m, len(reads)), kind)
    for d in range(m + n - 1):
        at = m + n - 2 - d  # place of the letter that meets the read's first one
        np.subtract(last, first, out=opened)
        np.subtract(across, extend, out=across)
        np.maximum(across, opened, out=across)  # no cell is negative, so neither falls below a new gap
        np.subtract(down[:-1], extend, out=fits)
        np.maximum(fits, opened[:-1], out=down[1:])
        np.minimum(np.bitwise_xor(a, b[at : at + m], out=unlike), np.uint16(1), out=unlike)
        np.multiply(unlike.view(np.int16), step, out=fits)
        np.subtract(before[:-1], fits, out=fits)
        np.add(fits, match, out=fits)
        # places left of the window or right of it hold filling: they mismatch, and end at 0
        np.maximum(np.maximum(fits, across[1:], out=fits), down[1:], out=fits)
        np.maximum(fits, kind(0), out=cell[1:])
        np.maximum(top, cell[1:], out=top)
        before, last, cell = last, cell, before
    return top.max(0).astype(np.int32)


def local_scores(pairs: DataFrame, match: int = 2, mismatch: int = -2, gap_open: int = 6, gap_extend: int = 1) -> DataFrame:
    """``pairs`` without its ``read`` and ``window`` but with ``score``, their best local alignment (null if either is null)."""
    rest = [c for c in pairs.columns if c not in ("read", "window")]
    plain = match >= max(mismatch, 0) and gap_extend >= 0 and gap_open + gap_extend >= 0  # no alignment beats a whole match

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            reads, windows = b.column("read").to_pylist(), b.column("window").to_pylist()
            known = np.array([k for k, (r, w) in enumerate(zip(reads, windows)) if r is not None and w is not None], np.int64)
            out = np.zeros(len(reads), np.int32)
            mask = np.ones(len(reads), bool)
            mask[known] = False
            if plain:
                whole = np.array([reads[k] in windows[k] for k in known.tolist()], bool)
                out[known[whole]] = [match * len(reads[k]) for k in known[whole].tolist()]
                known = known[~whole]
            order = known[np.argsort([len(reads[k]) for k in known.tolist()], kind="stable")] if len(known) else known
            at = 0
            while at < len(order):
                step = max(1, CELLS // max(1, len(reads[int(order[-1])])))
                part = order[at : at + step].tolist()
                out[part] = batch_scores([reads[k] for k in part], [windows[k] for k in part], match, mismatch, gap_open, gap_extend)
                at += step
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(out, mask=mask)], [*rest, "score"])

    schema = pairs.select(*rest).schema.add("score", T.IntegerType())
    return pairs.select(*rest, "read", "window").mapInArrow(score, schema)


def remap_calls(calls: DataFrame, reads: DataFrame, names: DataFrame, reference: DataFrame, slop: int = 1000, read_slop: int = 1000, least: int = 3, small: int = 1000, size: int = TILE, unfold: Callable[[DataFrame], DataFrame] | None = None, **scoring: int) -> DataFrame:
    """Scores and footprints for each call ``id, chr1, pos1, strand1, chr2, pos2, strand2``: ``id, low_score, high_score,
    low_footprint, high_footprint, has_n, small_indel``, what :func:`..results.filter_remap` takes.

    An end's reads (``reads`` as for :func:`..segments.collect_support_reads`, with ``seq``, or with ``body_chr, body_lo, body_hi``, the
    place in ``reference`` whose bases they are, or as pairs that ``unfold`` makes such reads of; their ``names`` by ``id``) are aligned to ``slop`` bases around their own breakpoint and around the other one, which is reversed if the strands are equal.
    The score is the most by which a read fits its own place better; null with fewer than ``least`` reads. Calls with an N in
    either window (``has_n``) and +/- calls of one chromosome of at most ``small`` bases (``small_indel``) are not aligned.
    Footprints run from the first base of an end's reads to the last; without enough reads they are null.
    """
    around = calls.select("id", "chr1", "pos1", "strand1", "chr2", "pos2", "strand2").withColumn("small_indel", expr.is_small_indel(F.col("chr1"), F.col("chr2"), F.col("strand1"), F.col("strand2"), F.col("pos1"), F.col("pos2"), small))
    ends = around.select("id", "small_indel", (F.col("strand1") == F.col("strand2")).alias("turned"), F.explode(F.array(*(F.struct(F.lit(k).alias("end"), F.col(f"chr{k}").alias("chr"), (F.col(f"pos{k}") - slop).alias("lo"), (F.col(f"pos{k}") + slop).alias("hi")) for k in (1, 2)))).alias("w")).select("id", "small_indel", "turned", "w.*")
    fetched = fetch_regions(ends, reference, size)
    windows = fetched.groupBy("id", "small_indel", "turned").agg(*(F.max(F.when(F.col("end") == k, F.col("seq"))).alias(f"seq{k}") for k in (1, 2)))
    windows = windows.withColumn("has_n", F.coalesce(F.col("seq1").contains("N") | F.col("seq2").contains("N"), F.lit(False)))
    places = lambda x, y: [F.col(f"{c}{s}").alias(f"{c}{t}") for c in ("chr", "pos", "strand") for s, t in ((x, "1"), (y, "2"))]
    ways = F.explode(F.array(F.struct(F.lit(1).alias("side"), *places("1", "2")), F.struct(F.lit(2).alias("side"), *places("2", "1")))).alias("w")
    placed = "seq" not in reads.columns
    body = ("body_chr", "body_lo", "body_hi")
    own = collect_support_reads(calls.select("id", ways).select("id", "w.*"), reads, names, read_slop, by=("id", "side"), carry=("pos", "read_len", *(body if placed else ("seq",))), unfold=unfold)
    last = F.col("pos") + F.col("read_len") - 1
    counted, again = [F.count("*").alias("n"), F.min("pos").alias("first"), F.max(last).alias("last")], [F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last")]
    if placed:
        # reads with one place are counted together before bases move
        places = stored(own.groupBy("id", "side", *(F.col(c).alias(c[5:]) for c in body)).agg(*counted), "places")
        freed(calls.sparkSession)
        own, counted = fetch_regions(places, reference, size), again
    # equal texts of one end align alike: each is aligned once
    texts = stored(own.groupBy("id", "side", F.upper("seq").alias("read")).agg(*counted), "texts")
    freed(calls.sparkSession, *([places] if placed else []))
    footprints = texts.groupBy("id", "side").agg((F.max("last") - F.min("first") + 1).alias("footprint"), F.sum("n").alias("n"))
    windows = stored(windows, "windows")
    # rows are few bytes but seconds of work: dealt anew, as they would else be gathered into few tasks by their size
    aligned = texts.join(windows.filter("NOT small_indel AND NOT has_n"), "id").repartition(int(calls.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id", "side", "read")
    other = F.when(F.col("side") == 1, F.col("seq2")).otherwise(F.col("seq1"))
    here, there = F.when(F.col("side") == 1, F.col("seq1")).otherwise(F.col("seq2")), F.when(F.col("turned"), expr.revcomp(other)).otherwise(other)
    source = local_scores(aligned.select("id", "side", "n", F.col("read").alias("again"), there.alias("there"), "read", here.alias("window")), **scoring)
    both = local_scores(source.select("id", "side", "n", F.col("score").alias("source"), F.col("again").alias("read"), F.col("there").alias("window")), **scoring)
    judged = both.groupBy("id", "side").agg(F.sum("n").alias("n_reads"), F.max(F.col("source") - F.coalesce("score", F.lit(0))).alias("most"))
    judged = judged.select("id", "side", F.when(F.col("n_reads") >= least, F.col("most")).alias("score"))
    ends = stored(footprints.join(judged, ["id", "side"], "left"), "ends")
    out = windows.select("id", "has_n", "small_indel")
    for name, side in (("low", 1), ("high", 2)):
        wide = F.when(F.col("small_indel") | (F.col("n") >= least), F.col("footprint"))
        found = ends.filter(F.col("side") == side).select("id", "footprint", "n", F.col("score").alias(f"{name}_score"))
        out = out.join(found, "id", "left").withColumn(f"{name}_footprint", wide).drop("footprint", "n")
    return out.select("id", "low_score", "high_score", "low_footprint", "high_footprint", "has_n", "small_indel")
