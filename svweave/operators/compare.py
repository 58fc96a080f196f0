"""Comparison of call sets, reads against regions, and segment statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .interval import interval_join, renamed


def compare_calls(old: DataFrame, new: DataFrame, slop: int = 500) -> DataFrame:
    """``id, n_old, tag`` of each new call: old ones on the same chromosomes and strands whose ends lie within ``slop``."""
    keys = ["chr1", "chr2", "strand1", "strand2"]
    a = new.select("id", *keys, (F.col("start1") - slop).alias("lo1"), (F.col("end1") + slop).alias("hi1"), (F.col("start2") - slop).alias("lo2"), (F.col("end2") + slop).alias("hi2"))
    b = renamed(old.select(*keys, "start1", "end1", "start2", "end2"), "o_", tuple(keys))
    met = interval_join(a, b, keys, "lo1", "hi1", "o_start1", "o_end1").filter("lo2 <= o_end2 AND o_start2 <= hi2")
    counted = met.groupBy("id").agg(F.count("*").alias("n_old"))
    n = F.coalesce("n_old", F.lit(0))
    return new.select("id").join(counted, "id", "left").select("id", n.alias("n_old"), F.when(n == 0, "UNIQUE").when(n == 1, "COMMON").otherwise("MULTI").alias("tag"))


def exclude_overlapping(reads: DataFrame, regions: DataFrame) -> DataFrame:
    """Reads ``qname, chr, start, end`` that meet none of the regions ``chr, start, end`` (0-based, half-open).

    Each stretch that reads cover alike is compared once, so reads themselves aren't multiplied."""
    a = reads.select("chr", "start", (F.col("end") - 1).alias("last")).distinct()
    b = regions.select("chr", F.col("start").alias("r_start"), (F.col("end") - 1).alias("r_last")).distinct()
    met = interval_join(a, b, ["chr"], "start", "last", "r_start", "r_last").select("chr", "start", (F.col("last") + 1).alias("end")).distinct()
    return reads.join(met, ["chr", "start", "end"], "left_anti").select(*reads.columns)


def segment_medians(points: DataFrame, segments: DataFrame, value: str, min_bins: int = 10, size: int = 500) -> DataFrame:
    """``seg_id, n_win, median`` of the windows ``chr, bin`` that start inside each segment; null below ``min_bins``."""
    a = points.select("chr", (F.col("bin") * size).alias("at"), F.col(value).alias("value"))
    b = segments.select("seg_id", "chr", "start", (F.col("end") - 1).alias("last"))
    met = interval_join(a, b, ["chr"], "at", "at", "start", "last").groupBy("seg_id").agg(F.count("*").alias("n_win"), F.median("value").alias("median"))
    out = segments.select("seg_id").join(met, "seg_id", "left")
    return out.select("seg_id", F.coalesce("n_win", F.lit(0)).alias("n_win"), F.when(F.col("n_win") >= min_bins, F.col("median")).alias("median"))


def discard_small(calls: DataFrame, low: int = 4, high: int = 10, inversion: int = 5000, deletion: int = 500) -> DataFrame:
    """Without small inversions of few reads (under ``low``, or under ``high`` and with two bounds near) and short deletions."""
    same, size, n = F.col("chr1") == F.col("chr2"), F.col("start2") - F.col("end1"), F.col("tumour_count")
    nearest = F.least(*(F.abs(F.col(a) - F.col(b)) for a in ("start1", "end1") for b in ("start2", "end2")))
    inverted = same & (F.col("strand1") == F.col("strand2")) & ((n < low) | ((n < high) & (nearest < inversion)))
    deleted = same & (F.col("strand1") == "+") & (F.col("strand2") == "-") & (size < deletion)
    return calls.filter(~(inverted | deleted))
