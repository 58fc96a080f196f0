"""Filters, flags and merges of rearrangement calls (BEDPE rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import expr
from .interval import band_pairs, interval_join, renamed

END1, END2 = ["chr1", "start1", "end1", "strand1"], ["chr2", "start2", "end2", "strand2"]


def min_tumour_reads(depth: float, threshold: float = 25, low: int = 2, high: int = 4) -> int:
    """Tumour reads a group needs: the high number where the sequencing depth exceeds the threshold."""
    return high if depth > threshold else low


def fail_reason(
    calls: DataFrame, min_tumour: int = 4, max_normal: int = 0, max_panel: int = 0, max_panel_samples: int = 0, distance: int = 100, foldback: int = 5000, foldback_extra: int = 2,
    discard_repeats: bool = False, decoy: str = "hs37d5cs", strict: bool = False,
) -> DataFrame:
    """First test of the somatic filter that a call fails, null if none; small foldbacks may have a few panel reads more.

    Tests in order: decoy sequence, identical ends, repeats (if asked for; column ``repeats``), tumour, normal, panel reads,
    panel samples, a low end above the high one (an error if ``strict``), distance of the ends' starts.
    """
    same = F.col("chr1") == F.col("chr2")
    middle = (F.col("start2") + 1 + F.col("end2")) / 2 - (F.col("start1") + 1 + F.col("end1")) / 2
    extra = F.when(same & (F.col("strand1") == F.col("strand2")) & (middle <= foldback), foldback_extra).otherwise(0)
    identical = same & (F.col("start1") == F.col("start2")) & (F.col("end1") == F.col("end2"))
    swapped = same & (F.col("start1") > F.col("start2"))
    reason = F.when((F.col("chr1").cast("string") == decoy) | (F.col("chr2").cast("string") == decoy), "decoy").when(identical, "identical")
    if discard_repeats:
        reason = reason.when(F.length("repeats") > 0, "repeats")
    reason = (
        reason.when(F.col("tumour_count") < min_tumour, "tumour").when(F.col("normal_count") > max_normal, "normal")
        .when(F.col("np_count") > max_panel + extra, "panel").when(F.col("np_sample_count") > max_panel_samples, "panel_samples")
        .when(swapped, F.raise_error(F.lit("a call's low end lies above its high end")) if strict else F.lit("order"))
        .when(same & (F.col("start2") - F.col("start1") <= distance), "distance")
    )
    return calls.withColumn("fail_reason", reason)


def filter_marked_groups(calls: DataFrame, **params) -> DataFrame:
    return fail_reason(calls, **params).filter("fail_reason IS NULL").drop("fail_reason")


def filter_recurrent_ends(calls: DataFrame, max_occ: int = 10) -> DataFrame:
    """Without calls one of whose ends occurs more than ``max_occ`` times among all ends."""
    names = ["chr", "start", "end", "strand"]
    ends = calls.select(*(F.col(c).alias(n) for c, n in zip(END1, names))).unionAll(calls.select(*(F.col(c).alias(n) for c, n in zip(END2, names))))
    often = ends.groupBy(*names).agg(F.count("*").alias("occurs")).filter(F.col("occurs") > max_occ).drop("occurs")
    out = calls
    for end in (END1, END2):
        out = out.join(often.select(*(F.col(n).alias(c) for c, n in zip(end, names))), end, "left_anti")
    return out.select(*calls.columns)


def id_list(column: str):
    """Distinct ids, comma-joined in the order of their texts."""
    return F.array_join(F.array_sort(F.transform(F.collect_set(column), lambda x: x.cast("string"))), ",")


def flag_balanced(calls: DataFrame, dist: int = 100_000) -> DataFrame:
    """``id, bal_trans``: partners between the same two chromosomes, in either order, with other strands at both ends, whose
    ranges at both ends lie inside the call's own, widened by ``dist`` (strictly)."""
    apart = calls.filter("chr1 <> chr2")
    a = renamed(apart, "a_").withColumns({"k1": F.col("a_chr1"), "k2": F.col("a_chr2"), "lo": F.col("a_start1") - dist + 1, "hi": F.col("a_end1") + dist - 1})
    hits = None
    for one, other in (("1", "2"), ("2", "1")):
        b = renamed(apart, "b_").withColumns({"k1": F.col("b_chr" + one), "k2": F.col("b_chr" + other)})
        met = interval_join(a, b, ["k1", "k2"], "lo", "hi", "b_start" + one, "b_end" + one, size=dist)
        inside = (F.col("b_start" + one) >= F.col("lo")) & (F.col("b_end" + one) <= F.col("hi"))
        inside &= (F.col("b_start" + other) > F.col("a_start2") - dist) & (F.col("b_end" + other) < F.col("a_end2") + dist)
        opposite = (F.col("a_strand1") != F.col("b_strand" + one)) & (F.col("a_strand2") != F.col("b_strand" + other)) & (F.col("a_id") != F.col("b_id"))
        found = met.filter(inside & opposite).select("a_id", "b_id")
        hits = found if hits is None else hits.union(found)
    return hits.groupBy(F.col("a_id").alias("id")).agg(id_list("b_id").alias("bal_trans"))


def flag_inversions(calls: DataFrame, dist: int = 1000) -> DataFrame:
    """``id, inv``: ++ and -- calls on one chromosome with starts within ``dist``, direct or crossed."""
    same = calls.filter("chr1 = chr2 AND strand1 = strand2")
    key = {"chr1": "chr1"}
    both = None
    for at, other, rest in (("start1", "start1", ("start2", "start2")), ("start1", "start2", ("start2", "start1"))):
        near = band_pairs(same, key, at, other, dist).filter((F.col("a_strand1") != F.col("b_strand1")) & (F.abs(F.col("a_" + rest[0]) - F.col("b_" + rest[1])) < dist)).select("a_id", "b_id")
        both = near if both is None else both.union(near)
    return both.groupBy(F.col("a_id").alias("id")).agg(id_list("b_id").alias("inv"))


def flag_occurrences(calls: DataFrame, within: int = 500) -> DataFrame:
    """``id, occ_l, occ_h``: distinct ranges of either end on the chromosome that meet the end's range, widened by ``within`` (strictly)."""
    ends = calls.select(F.col("chr1").alias("chr"), F.col("start1").alias("s"), F.col("end1").alias("e")).union(calls.select("chr2", "start2", "end2")).distinct()
    wide = ends.withColumns({"lo": F.col("s") - within + 1, "hi": F.col("e") + within - 1})
    hits = interval_join(wide, ends.select("chr", F.col("s").alias("s2"), F.col("e").alias("e2")), ["chr"], "lo", "hi", "s2", "e2")
    counted = hits.groupBy("chr", "s", "e").agg(F.count("*").alias("n"))
    low = counted.select(F.col("chr").alias("chr1"), F.col("s").alias("start1"), F.col("e").alias("end1"), F.col("n").alias("occ_l"))
    high = counted.select(F.col("chr").alias("chr2"), F.col("s").alias("start2"), F.col("e").alias("end2"), F.col("n").alias("occ_h"))
    return calls.join(low, ["chr1", "start1", "end1"]).join(high, ["chr2", "start2", "end2"]).select("id", "occ_l", "occ_h")


def flag_cn_changepoints(calls: DataFrame, segments: DataFrame, within: int = 100_000, one_end: bool = False) -> DataFrame:
    """``id, copynumber_flag``: sources (A, N, B) with a change-point within ``within`` of each end, ``_`` between them.

    ``segments``: ``source, chr, start, end``. Both ends must have one, unless ``one_end``; else the flag is ``_``.
    """
    points = segments.select("source", "chr", F.explode(F.array("start", "end")).alias("at")).distinct()
    wide = points.withColumn("_near", F.explode(F.array(*(F.floor(F.col("at") / within) + k for k in (-1, 0, 1)))))
    ends = calls.select("id", F.lit(1).alias("k"), F.col("chr1").alias("chr"), F.col("start1").alias("x")).union(calls.select("id", F.lit(2), "chr2", "end2"))
    hit = ends.withColumn("_near", F.floor(F.col("x") / within)).join(wide, ["chr", "_near"]).filter(F.abs(F.col("x") - F.col("at")) < within)
    sides = hit.groupBy("id").agg(*(F.concat(*(F.max(F.when((F.col("k") == k) & (F.col("source") == s), s).otherwise("")) for s in "ANB")).alias(f"side{k}") for k in (1, 2)))
    out = calls.select("id").join(sides, "id", "left").select("id", *(F.coalesce(f"side{k}", F.lit("")).alias(f"side{k}") for k in (1, 2)))
    found = ((F.col("side1") != "") | (F.col("side2") != "")) if one_end else ((F.col("side1") != "") & (F.col("side2") != ""))
    return out.select("id", F.when(found, F.concat_ws("_", "side1", "side2")).otherwise("_").alias("copynumber_flag"))


def merge_double_calls(calls: DataFrame, score: str = "tumour_count", slop: int = 300) -> DataFrame:
    """Overlapping calls (both ends, ``slop``, same strands) lose to a higher score, or to a smaller id as text.

    Each call is judged once against all its partners; survivors take the outer bounds of their partners.
    """
    keys = ["chr1", "chr2", "strand1", "strand2"]
    size = 5000
    a = renamed(calls, "a_", tuple(keys)).withColumn("_bin", F.explode(F.sequence(F.floor((F.col("a_start1") - slop) / size), F.floor((F.col("a_end1") + slop) / size))))
    b = renamed(calls, "b_", tuple(keys)).withColumn("_bin", F.explode(F.sequence(F.floor(F.col("b_start1") / size), F.floor(F.col("b_end1") / size))))
    meets = (F.col("a_id") != F.col("b_id")) & (F.col("a_start1") - slop < F.col("b_end1")) & (F.col("b_start1") < F.col("a_end1") + slop) & (F.col("a_start2") - slop < F.col("b_end2")) & (F.col("b_start2") < F.col("a_end2") + slop)
    pairs = a.join(b, [*keys, "_bin"]).filter(meets).drop("_bin").distinct()
    lost = F.col(f"a_{score}") < F.col(f"b_{score}")
    tie = (F.col(f"a_{score}") == F.col(f"b_{score}")) & (F.col("a_id").cast("string") > F.col("b_id").cast("string"))
    judged = pairs.groupBy(F.col("a_id").alias("id")).agg(F.max(lost | tie).alias("loses"), *(f(f"b_{c}").alias(f"m_{c}") for c, f in (("start1", F.min), ("end1", F.max), ("start2", F.min), ("end2", F.max))))
    kept = calls.join(judged, "id", "left").filter(~F.coalesce("loses", F.lit(False)))
    for c, f in (("start1", F.least), ("end1", F.greatest), ("start2", F.least), ("end2", F.greatest)):
        kept = kept.withColumn(c, f(c, f"m_{c}"))
    return kept.select(*calls.columns)


def annotate(calls: DataFrame) -> DataFrame:
    """Class, distances and the small-indel mark of each call."""
    c = F.col
    return calls.select(
        "id", expr.sv_class(c("chr1"), c("chr2"), c("strand1"), c("strand2")).alias("svclass"), expr.breakpoint_distance(c("chr1"), c("chr2"), c("start1"), c("start2")).alias("bkpt_distance"),
        expr.sv_distance(c("chr1"), c("chr2"), c("end1"), c("start2")).alias("bkdist"), expr.is_small_indel(c("chr1"), c("chr2"), c("strand1"), c("strand2"), c("end1"), c("start2")).alias("small_indel"),
    )


def filter_small_deletions(calls: DataFrame, histogram: DataFrame, quantile: float = 0.99) -> DataFrame:
    """Without +/- calls on one chromosome no longer than the insert sizes' quantile (one row, so it is broadcast)."""
    q = quantile_from_freq(histogram, quantile)
    small = (F.col("chr1") == F.col("chr2")) & (F.col("strand1") == "+") & (F.col("strand2") == "-") & (F.col("start2") - F.col("end1") <= F.col("quantile"))
    return calls.crossJoin(F.broadcast(q)).filter(~F.coalesce(small, F.lit(False))).drop("quantile")


def quantile_from_freq(histogram: DataFrame, q: float) -> DataFrame:
    """``quantile``: the smallest ``size`` whose running count reaches ``q`` of all (``size, n``; at most a row a size)."""
    run = Window.orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return histogram.withColumn("cum", F.sum("n").over(run)).withColumn("all", F.sum("n").over(every)).filter(F.col("cum") >= q * F.col("all")).agg(F.min("size").alias("quantile"))
