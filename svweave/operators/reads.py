"""Read preparation, support of calls by reads, and smoothing along the genome."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import expr
from ..sources.shared import stored, tasks_for
from .interval import interval_islands, interval_join


def limit_refs(reads: DataFrame, refs: DataFrame) -> DataFrame:
    """Reads that lie, and whose mates lie, on a chromosome of ``refs`` (column ``chr``); ``=`` (as the read) and ``*`` (none) pass."""
    names = refs.select(F.col("chr").cast("string").alias("chr")).union(reads.sparkSession.createDataFrame([("=",), ("*",)], "chr string")).distinct()
    out = reads
    for side in ("chr", "mate_chr"):
        own = names.select(F.col("chr").alias("_name"))
        out = out.join(own, out[side].cast("string") == own["_name"], "left_semi")
    return out


def prep_pairs(reads: DataFrame, min_mapq: int = 6) -> DataFrame:
    """``qname`` of complete pairs (mates 1 and 2 once each), both mapped well, that are no overlapping pair of one chromosome."""
    seen = [F.count(F.when(F.col("mate") == k, 1)).alias(f"n{k}") for k in (1, 2)]
    short = (F.col("chr") == F.col("mate_chr")) & (F.abs("tlen") < 2 * F.col("read_len"))
    pairs = reads.groupBy("qname").agg(*seen, F.min("mapq").alias("least"), F.max(short).alias("short"))
    return pairs.filter((F.col("n1") == 1) & (F.col("n2") == 1) & (F.col("least") >= min_mapq) & ~F.col("short")).select("qname")


def exclude_by_qname(reads: DataFrame, *selected: DataFrame) -> DataFrame:
    """Reads whose name no row of ``selected`` carries; with none selected all stay. Tasks grow with the reads."""
    n = tasks_for(reads.sparkSession, reads.count()) if selected else 0
    for rows in selected:
        names = rows.select("qname").distinct().repartition(n, "qname").withColumn("_out", F.lit(True))
        # an anti join would move below the shuffle, to one of as few tasks as its bytes ask for
        reads = reads.repartition(n, "qname").join(names, "qname", "left").filter("_out IS NULL").select(*reads.columns)
    return reads


def keys_with_names(rows: DataFrame, keys: list[str], name: str, least: int) -> DataFrame:
    """Different ``keys`` (none of them null) beside which at least ``least`` different values of ``name`` stand; null is no value.

    Each value sets one bit of 64: a key with ``least`` bits set has as many values, and of its rows no name moves. Only rows of
    keys with fewer bits, though with rows enough, are counted by value.
    """
    known = rows.filter(F.col(name).isNotNull())
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(name), F.lit(64)).cast("int"))
    marks = stored(known.groupBy(*keys).agg(F.bit_or(bit).alias("_bits"), F.count("*").alias("_rows")).filter(F.col("_rows") >= least), "marks")
    enough = F.bit_count("_bits") >= least
    unsure = stored(marks.filter(~enough).select(*keys), "unsure")
    counted = known.join(unsure, keys, "left_semi").groupBy(*keys).agg(F.count_distinct(name).alias("_names")).filter(F.col("_names") >= least)
    return marks.filter(enough).select(*keys).unionByName(counted.select(*keys))


def footprint(reads: DataFrame, keys: list[str]) -> DataFrame:
    """Reference bases from the first to the last that reads of each key cover."""
    last = expr.ref_end(F.col("pos"), F.col("cigar"))
    return reads.groupBy(*keys).agg((F.max(last) - F.min("pos") + 1).alias("footprint"))


def clip_mode(reads: DataFrame, keys: list[str], side: str, min_clipped: int = 2) -> DataFrame:
    """``n_clipped, bkpt``: where most reads of each key are clipped at ``side`` (low: start, ties larger; high: end, ties smaller).

    With fewer than ``min_clipped`` clipped reads: the smallest start, or largest end, of all. Counts by place come first, so
    a deep key is pre-aggregated.
    """
    low = side == "low"
    at = F.col("pos") if low else expr.ref_end(F.col("pos"), F.col("cigar"))
    clipped = expr.clip_side(F.col("cigar")).isin(side, "both")
    places = reads.groupBy(*keys, at.alias("at")).agg(F.count(F.when(clipped, 1)).alias("n"))
    best = F.max(F.when(F.col("n") > 0, F.struct("n", (F.col("at") if low else -F.col("at")).alias("rank"))))
    out = places.groupBy(*keys).agg(F.sum("n").alias("n_clipped"), best.alias("best"), (F.min if low else F.max)("at").alias("edge"))
    mode = F.col("best.rank") if low else -F.col("best.rank")
    return out.select(*keys, "n_clipped", F.when(F.col("n_clipped") >= min_clipped, mode).otherwise(F.col("edge")).alias("bkpt"))


def segment_mean_depth(reads: DataFrame, segments: DataFrame) -> DataFrame:
    """``seg_id, mean_depth``: mean coverage by base of each segment ``chr, start, end`` (half-open) plus 0.01."""
    a = segments.select("seg_id", "chr", "start", (F.col("end") - 1).alias("last"))
    b = reads.select("chr", F.col("start").alias("r_start"), (F.col("end") - 1).alias("r_last"))
    b = b.groupBy("chr", "r_start", "r_last").agg(F.count("*").alias("n"))
    met = interval_join(a, b, ["chr"], "start", "last", "r_start", "r_last")
    shared = F.least("last", "r_last") - F.greatest("start", "r_start") + 1
    bases = met.groupBy("seg_id").agg(F.sum(shared * F.col("n")).alias("bases"))
    return segments.join(bases, "seg_id", "left").select("seg_id", (F.coalesce("bases", F.lit(0)) / (F.col("end") - F.col("start")) + 0.01).alias("mean_depth"))


def united(features: DataFrame) -> DataFrame:
    """``chr, start, end`` of the islands of overlapping features; empty ones stay as they are."""
    known = features.select("chr", "start", "end").distinct()
    islands = interval_islands(known.filter("start < end"), ["chr"], "start", "end", ["start", "end"])
    whole = islands.groupBy("chr", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return whole.select("chr", "start", "end").unionByName(known.filter("start >= end"))


def covered_by(reads: DataFrame, features: DataFrame, max_uncovered: int = 10) -> DataFrame:
    """Reads ``qname, mate, chr, start, end`` of which the union of features leaves at most ``max_uncovered`` bases free.

    Features that overlap are joined first, so a read meets their union and not each of them."""
    features = united(features)
    a = reads.select("qname", "mate", "chr", "start", (F.col("end") - 1).alias("last"))
    b = features.select("chr", F.col("start").alias("f_start"), (F.col("end") - 1).alias("f_last")).distinct()
    met = interval_join(a, b, ["chr"], "start", "last", "f_start", "f_last")
    part = met.select("qname", "mate", F.greatest("start", "f_start").alias("lo"), (F.least("last", "f_last") + 1).alias("hi"), (F.col("last") + 1 - F.col("start")).alias("len"))
    reach = F.max("hi").over(Window.partitionBy("qname", "mate").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1))
    gain = F.greatest(F.col("hi") - F.greatest("lo", F.coalesce("reach", "lo")), F.lit(0))
    total = part.withColumn("reach", reach).groupBy("qname", "mate").agg(F.sum(gain).alias("covered"), F.max("len").alias("len"))
    return total.filter(F.col("covered") >= F.col("len") - max_uncovered).select("qname", "mate", "covered")


def collect_end_reads(calls: DataFrame, reads: DataFrame, left: int = 900, right: int = 100, ignore_mate: bool = False) -> DataFrame:
    """``id, qname``: reads that overlap a call's low end, on its strand, whose mates overlap its high end on that one's strand.

    An end reaches from ``left`` bases before its middle to ``right`` after it if it is a + end, mirrored at a - end. On one
    chromosome and strand the read must lie on its mate's side as the ends do. With ``ignore_mate`` the mate isn't looked at.
    Reads that are unpaired or unmapped (``flag``, if there is one) take no part; a mate counts as long as its read.
    """
    def reach(strand: str, start: str, end: str):
        middle, plus = (F.col(start) + F.col(end)) / 2, F.col(strand) == "+"
        return (middle - F.when(plus, left).otherwise(right)).cast("long"), (middle + F.when(plus, right).otherwise(left)).cast("long")

    (lo1, hi1), (lo2, hi2) = reach("strand1", "start1", "end1"), reach("strand2", "start2", "end2")
    low_first = F.col("start1") + F.col("end1") <= F.col("start2") + F.col("end2")
    mate = ["mate_chr", "mate_strand"]
    a = calls.select("id", F.col("chr1").alias("chr"), F.col("strand1").alias("strand"), F.col("chr2").alias(mate[0]), F.col("strand2").alias(mate[1]), lo1.alias("lo1"), hi1.alias("hi1"), lo2.alias("lo2"), hi2.alias("hi2"), low_first.alias("low_first"))
    if "flag" in reads.columns:
        reads = reads.filter(expr.flags_fit(F.col("flag"), expr.PAIRED, expr.UNMAPPED))
    b = reads.select("qname", "chr", "strand", *mate, "pos", "mate_pos", "read_len", (F.col("pos") + F.col("read_len") - 1).alias("last"))
    if ignore_mate:
        b, a = b.drop(*mate), a.drop(*mate)
        return interval_join(a, b, ["chr", "strand"], "lo1", "hi1", "pos", "last").select("id", "qname").distinct()
    met = interval_join(a, b, ["chr", "strand", *mate], "lo1", "hi1", "pos", "last")
    ordered = F.when(F.col("low_first"), F.col("pos") <= F.col("mate_pos")).otherwise(F.col("pos") >= F.col("mate_pos"))
    apart = (F.col("chr") != F.col("mate_chr")) | (F.col("strand") != F.col("mate_strand"))
    near = (F.col("mate_pos") <= F.col("hi2")) & (F.col("mate_pos") + F.col("read_len") - 1 >= F.col("lo2"))
    return met.filter(near & (apart | ordered)).select("id", "qname").distinct()


def prefilter_groups(calls: DataFrame, most: int = 200) -> DataFrame:
    """Calls with tumour reads, without +/- ones of one chromosome whose ends lie within ``most``."""
    near = (F.col("chr1") == F.col("chr2")) & (F.col("strand1") == "+") & (F.col("strand2") == "-") & (F.col("start2") + 1 - F.col("end1") <= most)
    return calls.filter((F.col("tumour_count") > 0) & ~near)


def running_median(points: DataFrame, value: str, out: str = "smooth") -> DataFrame:
    """Median of five neighbours along each chromosome; three at the second place from an end, Tukey's rule at the first.

    Chromosomes of fewer than five points keep their values.
    """
    order = Window.partitionBy("chr").orderBy("bin")
    back, every = Window.partitionBy("chr").orderBy(F.desc("bin")), Window.partitionBy("chr")
    ranked = points.withColumn("_n", F.count("*").over(every)).withColumn("_i", F.row_number().over(order)).withColumn("_j", F.row_number().over(back))
    middle = lambda k: F.get(F.array_sort(F.collect_list(F.col(value).cast("double")).over(order.rowsBetween(-k, k))), F.lit(k))
    inner = ranked.withColumn("_3", middle(1)).withColumn("_5", middle(2))
    inner = inner.withColumn("_s", F.when(F.least("_i", "_j") == 2, F.col("_3")).otherwise(F.col("_5")))
    ends = F.when(F.col("_i") == 1, F.struct(F.lead("_s", 1).over(order).alias("a"), F.lead("_s", 2).over(order).alias("b"))).when(F.col("_j") == 1, F.struct(F.lag("_s", 1).over(order).alias("a"), F.lag("_s", 2).over(order).alias("b")))
    third = 3 * F.col("_e.a") - 2 * F.col("_e.b")
    tukey = F.array_sort(F.array(F.col(value).cast("double"), F.col("_e.a"), third))[1]
    smooth = F.when(F.col("_n") < 5, F.col(value).cast("double")).when(F.least("_i", "_j") == 1, tukey).otherwise(F.col("_s"))
    return inner.withColumn("_e", ends).select(*points.columns, smooth.alias(out))


def snap_segment_edges(segments: DataFrame) -> DataFrame:
    """Neighbouring segments of a chromosome meet halfway between the one's end and the other's start."""
    w = Window.partitionBy("chr").orderBy("start", "end", "seg_id")
    start = F.floor((F.lag("end").over(w) + F.col("start")) / 2)
    end = F.floor((F.col("end") + F.lead("start").over(w)) / 2)
    return segments.select("seg_id", "chr", F.coalesce(start, "start").alias("start"), F.coalesce(end, "end").alias("end"))


def foldback_ratio(windows: DataFrame, quantile: float = 0.99) -> DataFrame:
    """``fb_ratio`` of windows with ``depth`` and ``fb_depth``, shrunk to the mean ratio and capped at the quantile."""
    mean = windows.agg(F.avg(F.when(F.col("depth") + F.col("fb_depth") > 0, F.col("fb_depth") / (F.col("depth") + F.col("fb_depth")))).alias("mean"))
    raw = windows.crossJoin(F.broadcast(mean)).withColumn("raw", (F.col("fb_depth") + F.col("mean")) / (F.col("depth") + F.col("fb_depth") + 1))
    cap = raw.agg(F.percentile("raw", F.lit(quantile)).alias("cap"))
    return raw.crossJoin(F.broadcast(cap)).withColumn("fb_ratio", F.least("raw", "cap")).drop("mean", "raw", "cap")
