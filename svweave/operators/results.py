"""From filtered groups to results: read groups, remapping and contamination filters, copy-number support, collation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .interval import interval_join


def augment_read_groups(read_groups: DataFrame, bas: DataFrame, prefix: str = "", panel: bool = False) -> DataFrame:
    """``rg_id, sample, max_insert`` from ``rg_id, sample`` and statistics ``rg_id, mean_insert_size, insert_size_sd``.

    The insert is at most the mean and two deviations, cut to a whole number; ``prefix`` stands before ids, ``NP_`` before
    samples of a panel. A read group without statistics is an error.
    """
    size = F.floor(F.col("mean_insert_size") + 2 * F.col("insert_size_sd"))
    size = F.when(F.col("mean_insert_size").isNull(), F.raise_error(F.concat(F.lit("no statistics of read group "), F.col("rg_id").cast("string")))).otherwise(size)
    sample = F.concat(F.lit("NP_"), F.col("sample")) if panel else F.col("sample")
    return read_groups.join(bas, "rg_id", "left").select(F.concat(F.lit(prefix), F.col("rg_id").cast("string")).alias("rg_id"), sample.alias("sample"), size.cast("int").alias("max_insert"))


def lesser_mate(chrom: Column, pos: Column, mate_chrom: Column, mate_pos: Column, first: Column) -> Column:
    """Whether a read comes before its mate: by chromosome, position, and the first of the pair."""
    return F.when(chrom != mate_chrom, chrom < mate_chrom).when(pos != mate_pos, pos < mate_pos).otherwise(first)


def augment_original(reads: DataFrame, original: DataFrame, pairwise: bool = False) -> DataFrame:
    """``reads`` (by ``qname, mate``) with ``zm``, the mapping quality they had in ``original``, and ``z1``, its ``x1`` if it has one.

    Reads meet one to one: a read without an original mapping and a key that either side repeats are errors; with
    ``pairwise``, so is a name of which ``reads`` lacks a mate.
    """
    x1 = F.col("x1") if "x1" in original.columns else F.lit(None).cast("int")
    old = original.select("qname", "mate", F.col("mapq").alias("_zm"), x1.alias("_z1"), F.lit(False).alias("_read"))
    # reads and originals move once, by name, and meet in windows
    both = reads.withColumn("_read", F.lit(True)).unionByName(old, allowMissingColumns=True).repartition("qname")
    own, name = Window.partitionBy("qname", "mate"), Window.partitionBy("qname")
    of = lambda c, side: F.when(F.col("_read") == F.lit(side), F.col(c))
    met = both.withColumns({"_own": F.count(of("_read", True)).over(own), "_old": F.count(of("_read", False)).over(own), "_zm": F.max("_zm").over(own), "_z1": F.max("_z1").over(own)})
    if pairwise:
        met = met.withColumn("_mates", F.size(F.collect_set(of("mate", True)).over(name)))

    def wrong(text: str) -> Column:
        return F.raise_error(F.concat(F.lit(text + ": "), F.coalesce("qname", F.lit("null"))))

    unknown = (F.col("_old") == 0) | F.col("qname").isNull() | F.col("mate").isNull()
    zm = F.when(unknown, wrong("a read has no original mapping")).when((F.col("_own") > 1) | (F.col("_old") > 1), wrong("a read is there more than once"))
    if pairwise:
        zm = zm.when(F.col("_mates") < 2, wrong("a read has no mate"))
    return met.filter("_read").select(*(F.col(c) for c in reads.columns), zm.otherwise(F.col("_zm")).alias("zm"), F.col("_z1").alias("z1"))


def groups_to_bedpe(groups: DataFrame, members: DataFrame) -> DataFrame:
    """Ten BEDPE columns and the number of samples with reads, from ``group_id, chr_l, .., h3`` and ``group_id, sample, qname``.

    The score counts pairs; the name is the smallest read of the first sample (by name) that has some. Groups without members
    have score 0 and no name.
    """
    by_sample = members.groupBy("group_id", "sample").agg(F.count("*").alias("n"), F.min("qname").alias("qname"))
    best = by_sample.groupBy("group_id").agg(F.sum("n").alias("score"), F.min(F.struct("sample", "qname")).alias("lead"), F.count("*").alias("n_samples"))
    zero = F.lit(0).cast("long")
    return groups.join(best, "group_id", "left").select(
        F.col("chr_l").alias("chr1"), (F.col("l5") - 1).alias("start1"), F.col("l3").alias("end1"), F.col("chr_h").alias("chr2"), (F.col("h5") - 1).alias("start2"), F.col("h3").alias("end2"),
        F.col("lead.qname").alias("name"), F.coalesce("score", zero).alias("score"), F.col("strand_l").alias("strand1"), F.col("strand_h").alias("strand2"), F.coalesce("n_samples", zero).alias("n_samples"),
    )


def support_counts(members: DataFrame, keys: list[str], least: int = 2) -> DataFrame:
    """One row ``total, small, emitted``: groups, those with fewer than ``least`` pairs, and the rest."""
    sizes = members.groupBy(*keys).agg(F.count("*").alias("n"))
    small = F.count(F.when(F.col("n") < least, 1))
    return sizes.agg(F.count("*").alias("total"), small.alias("small"), (F.count("*") - small).alias("emitted"))


def filter_foldback_artefacts(calls: DataFrame, classes: DataFrame) -> DataFrame:
    """Without calls whose class (``id, keep``) is false; calls without a class stay."""
    return calls.join(classes.filter("NOT keep").select("id").distinct(), "id", "left_anti").select(*calls.columns)


def keep_by_expected_false(posteriors: DataFrame, budget: float = 5.0, by: str | None = None) -> DataFrame:
    """``id, keep``: rows ``id, p_true`` whose rank by ``1 - p_true`` (ties share the mean) lies before the place where the running
    sum of it first exceeds ``budget``. If it never does, the place is the first and nothing is kept.

    Sums are per value of ``1 - p_true`` first; a window then runs over the distinct values of each ``by``.
    """
    keys = [by] if by else []
    miss = F.round(1 - F.col("p_true"), 12)
    values = posteriors.groupBy(*keys, miss.alias("miss")).agg(F.count("*").alias("n"))
    run = Window.partitionBy(*keys).orderBy("miss").rowsBetween(Window.unboundedPreceding, -1)
    before = values.withColumn("rows", F.coalesce(F.sum("n").over(run), F.lit(0))).withColumn("sum", F.coalesce(F.sum(F.col("n") * F.col("miss")).over(run), F.lit(0.0)))
    # the first row at which the sum exceeds the budget: after so many whole steps of this value
    steps = F.floor((budget - F.col("sum")) / F.col("miss")) + 1
    passes = (F.col("miss") > 0) & (F.col("sum") <= budget) & (F.col("sum") + F.col("n") * F.col("miss") > budget)
    place = F.coalesce(F.min(F.when(passes, F.col("rows") + steps)).over(Window.partitionBy(*keys)), F.lit(1))
    judged = before.withColumn("keep", F.col("rows") + (F.col("n") + 1) / 2 < place).select(*keys, "miss", "keep")
    return posteriors.withColumn("miss", miss).join(judged, [*keys, "miss"]).select(*keys, "id", "keep")


def filter_remap(calls: DataFrame, scores: DataFrame, score: int = 80, footprint: int = 50, reads: str = "score") -> DataFrame:
    """Calls that keep their place after remapping, by ``id, low_score, high_score, low_footprint, high_footprint, has_n,
    small_indel, microbes``.

    Dropped: an unknown or small footprint, at least as many microbe reads as the call's score (its column ``reads``) and,
    unless ``small_indel``, no reads at an end (null score), N in the reference and a score of at most ``score``.
    """
    ends = [F.col("small_indel") | (F.col(f"{e}_score") > score) for e in ("low", "high")]
    wide = [F.col(f"{e}_footprint") > footprint for e in ("low", "high")]
    good = ends[0] & ends[1] & wide[0] & wide[1] & (F.col("small_indel") | ~F.col("has_n")) & (F.coalesce("microbes", F.lit(0)) < F.col(reads))
    return calls.join(scores, "id").filter(F.coalesce(good, F.lit(False))).select(*(calls[c] for c in calls.columns))


def microbe_counts(hits: DataFrame, least: int = 80) -> DataFrame:
    """``id, microbe_counts, microbes`` of hits ``id, read_id, organism, score``: each read counts for its best organism (ties:
    smaller name) with at least ``least``; lists are comma-joined in order of names."""
    best = hits.filter(F.col("score") >= least).groupBy("id", "read_id").agg(F.min(F.struct((-F.col("score")).alias("rank"), "organism")).alias("best"))
    counted = best.groupBy("id", F.col("best.organism").alias("organism")).agg(F.count("*").alias("n"))
    lists = counted.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("organism", "n"))).alias("all"))
    join = lambda name: F.array_join(F.transform("all", lambda x: x[name].cast("string")), ",")
    return lists.select("id", join("n").alias("microbe_counts"), join("organism").alias("microbes"))


def in_centromere_or_telomere(pos: Column) -> Column:
    """Whether a place lies in the p telomere, the centromere or the q telomere (``ptel, cen_start, cen_end, qtel``)."""
    return (pos <= F.col("ptel")) | ((pos >= F.col("cen_start")) & (pos <= F.col("cen_end"))) | (pos >= F.col("qtel"))


def drop_cen_tel(calls: DataFrame, centtel: DataFrame, absent: str | None = None) -> DataFrame:
    """Calls ``chr1, start1, chr2, start2`` of which no end lies in a centromere or telomere or on the ``absent`` chromosome."""
    out = calls if absent is None else calls.filter((F.col("chr1").cast("string") != absent) & (F.col("chr2").cast("string") != absent))
    for chrom, pos in (("chr1", "start1"), ("chr2", "start2")):
        bad = centtel.select(F.col("chr").alias("_chr"), "ptel", "cen_start", "cen_end", "qtel")
        out = out.join(bad, (out[chrom] == bad["_chr"]) & in_centromere_or_telomere(out[pos]), "left_anti")
    return out


def trusted_cn_breaks(segments: DataFrame, breakpoints: DataFrame, centtel: DataFrame, near: int = 20_000, min_bins: int = 10, change: float = 0.3) -> DataFrame:
    """``chr, start``: where a segment ``chr, start, end, cn, n_win`` begins with a large change of copy number from the one before.

    Both need ``min_bins`` windows; no breakpoint ``chr, pos`` may lie within ``near``, nor a centromere or telomere there.
    """
    w = Window.partitionBy("chr").orderBy("start", "end")
    both = segments.withColumn("_cn", F.lag("cn").over(w)).withColumn("_n", F.lag("n_win").over(w))
    big = both.filter((F.col("n_win") >= min_bins) & (F.col("_n") >= min_bins) & (F.abs(F.col("cn") - F.col("_cn")) > change)).select("chr", "start").distinct()
    wide = big.withColumn("lo", F.col("start") - near).withColumn("hi", F.col("start") + near)
    hit = interval_join(wide, breakpoints.select("chr", "pos").distinct(), ["chr"], "lo", "hi", "pos", "pos", size=near).select("chr", "start").distinct()
    far = big.join(hit, ["chr", "start"], "left_anti")
    bad = centtel.select(F.col("chr").alias("_chr"), "ptel", "cen_start", "cen_end", "qtel")
    return far.join(bad, (far["chr"] == bad["_chr"]) & in_centromere_or_telomere(far["start"]), "left_anti")


def collate_calls(calls: DataFrame, remapped: DataFrame, cn_pass: DataFrame) -> DataFrame:
    """Calls that ``remapped`` (``id, bkpt_l, bkpt_h``) holds, at their breakpoints, with ``copynumber_flag`` 1 if ``cn_pass`` has the id."""
    passed = cn_pass.select("id", F.lit(1).alias("_flag")).distinct()
    out = calls.join(remapped.select("id", "bkpt_l", "bkpt_h"), "id").join(passed, "id", "left")
    changed = {"start1": F.col("bkpt_l") - 1, "end1": F.col("bkpt_l"), "start2": F.col("bkpt_h") - 1, "end2": F.col("bkpt_h"), "copynumber_flag": F.coalesce("_flag", F.lit(0))}
    return out.withColumns(changed).drop("_flag", "bkpt_l", "bkpt_h")


def combine_results(calls: DataFrame, assembled: DataFrame) -> DataFrame:
    """Calls with the coordinates and strands of their assembly ``id, start1, end1, start2, end2, strand1, strand2, score, notation``
    where there is one. An id assembled more than once is an error."""
    names = ["start1", "end1", "start2", "end2", "strand1", "strand2"]
    once = assembled.groupBy("id").agg(F.count("*").alias("_n"), F.min(F.struct(*names, F.col("score").alias("assembly_score"), "notation")).alias("_a"))
    once = once.withColumn("_a", F.when(F.col("_n") > 1, F.raise_error(F.lit("a call is assembled more than once"))).otherwise(F.col("_a"))).drop("_n")
    out = calls.join(once, "id", "left").withColumns({c: F.coalesce(F.col("_a." + c), F.col(c)) for c in names})
    return out.withColumn("assembly_score", F.col("_a.assembly_score")).withColumn("notation", F.col("_a.notation")).drop("_a")


def annotate_spanning_features(groups: DataFrame, features: DataFrame, max_insert: int = 1000) -> DataFrame:
    """``id, notes``: features (``chr, start, end, name``; half-open) that may explain a +/- group of one chromosome.

    They start at or after its low end, end at or before its high one, are at least as long as the group less ``max_insert``,
    and meet the ``max_insert`` bases after the low end. Names with counts, in order.
    """
    g = groups.filter("chr1 = chr2 AND strand1 = '+' AND strand2 = '-'").select("id", F.col("chr1").alias("chr"), (F.col("start1") + 1).alias("l5"), F.col("end2").alias("h3"), F.col("start1").alias("lo"), (F.col("start1") + max_insert).alias("hi"))
    f = features.select("chr", "name", F.col("start").alias("f_start"), F.col("end").alias("f_end"), (F.col("end") - 1).alias("f_last"))
    met = interval_join(g, f, ["chr"], "lo", "hi", "f_start", "f_last")
    fits = (F.col("f_start") >= F.col("l5")) & (F.col("f_end") <= F.col("h3")) & (F.col("f_end") - F.col("f_start") >= F.col("h3") - F.col("l5") - max_insert)
    counted = met.filter(fits).groupBy("id", "name").agg(F.count("*").alias("n"))
    lists = counted.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("name", "n"))).alias("all"))
    return lists.select("id", F.array_join(F.transform("all", lambda x: F.concat_ws("*", x["name"], x["n"].cast("string"))), " ").alias("notes"))


def tag_counts(tagged: DataFrame) -> DataFrame:
    """``tag, n``: calls of each tag of a comparison, and ``TOTAL``."""
    return tagged.groupBy("tag").agg(F.count("*").alias("n")).union(tagged.agg(F.lit("TOTAL"), F.count("*")))


def segment_shards(segments: DataFrame, most: int = 10_000, gap: int = 500) -> DataFrame:
    """``seg_id, kind`` of segments ``seg_id, chr, start, end, low_rg, high_rg``: a ``shard`` is short with breakpoints of two
    rearrangements at its ends; a ``gap`` has none itself but stands short between those of two rearrangements; else null."""
    w = Window.partitionBy("chr").orderBy("start", "end", "seg_id")
    length = F.col("end") - F.col("start") + 1
    linked = segments.withColumn("_before", F.lag("high_rg").over(w)).withColumn("_after", F.lead("low_rg").over(w))
    shard = (length <= most) & (F.col("low_rg") != F.col("high_rg"))
    between = F.col("low_rg").isNull() & F.col("high_rg").isNull() & (length <= gap) & (F.col("_before") != F.col("_after"))
    return linked.select("seg_id", F.when(shard, "shard").when(between, "gap").alias("kind"))


def arm_cn(segments: DataFrame) -> DataFrame:
    """``chr, mean_cn`` of segments ``chr, start, end, low_boundary, high_boundary, cn``: the mean of what is known of four copy
    numbers, at both telomeres and on both sides of the centromere.

    The first segment of a chromosome must begin at a telomere (``.._ptel``) and the last end at one (``.._qtel``); the
    centromere's sides are the first segment that ends at a ``centromere`` and the last that begins at one. A chromosome
    without one of these, or of whose four none is known, is an error.
    """
    at = F.struct("start", "end")
    ends, cen = F.struct("low_boundary", "high_boundary", "cn"), F.struct("cn")
    sides = segments.groupBy("chr").agg(
        F.min_by(ends, F.when(F.col("low_boundary").endswith("_ptel"), F.struct(F.lit(0), at)).otherwise(F.struct(F.lit(1), at))).alias("p"),
        F.max_by(ends, F.when(F.col("high_boundary").endswith("_qtel"), F.struct(F.lit(1), at)).otherwise(F.struct(F.lit(0), at))).alias("q"),
        F.min_by(cen, F.when(F.col("high_boundary") == "centromere", at)).alias("pc"), F.max_by(cen, F.when(F.col("low_boundary") == "centromere", at)).alias("qc"),
    )
    whole = F.col("p.low_boundary").endswith("_ptel") & F.col("q.high_boundary").endswith("_qtel") & F.col("pc").isNotNull() & F.col("qc").isNotNull()
    known = F.filter(F.array("p.cn", "pc.cn", "q.cn", "qc.cn"), lambda x: x.isNotNull())
    wrong = F.raise_error(F.concat(F.lit("telomeres, centromere or copy numbers are missing on "), F.col("chr").cast("string")))
    mean = F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / F.size(known)
    return sides.select("chr", F.when(F.coalesce(whole, F.lit(False)) & (F.size(known) > 0), mean).otherwise(wrong).alias("mean_cn"))
