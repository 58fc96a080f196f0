"""Coverage parts, segments between boundaries and their breakpoints, reads that support calls, merged calls."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import expr
from .results import in_centromere_or_telomere

SUPPLEMENTARY = 0x800


def merge_coverage(parts: DataFrame, refs: DataFrame) -> DataFrame:
    """Rows of ``parts`` (``chr, start, ..``) on the chromosomes of ``refs`` (``chr, ref_idx``), in their order.

    A chromosome without a row is an error; rows on other chromosomes are left out.
    """
    absent = sorted(str(r.chr) for r in refs.join(parts.select("chr").distinct(), "chr", "left_anti").select("chr").collect())
    if absent:
        raise ValueError("no coverage of " + ", ".join(absent))
    return parts.join(F.broadcast(refs.select("chr", "ref_idx")), "chr").orderBy("ref_idx", "start").select(*parts.columns)


def build_segments(calls: DataFrame, breaks: DataFrame, centtel: DataFrame) -> DataFrame:
    """``chr, start, end, start_bkpt, end_bkpt, no_cn``: the stretches between neighbouring boundaries of each chromosome.

    Boundaries are the telomeres' bounds (``chr_ptel``, ``chr_qtel``), breakpoints of calls ``id, chr1, pos1, chr2, pos2``
    (``id:1``, ``id:2``; none of a call with an end in a telomere or centromere), copy-number breaks ``chr, pos``
    (``cn_bkpt``) and the centromere's bounds that aren't 0 (``centromere``). At one place breakpoints come first (by id),
    then breaks. ``no_cn`` marks the first stretch of a chromosome whose centromere starts at 0.
    """
    ends = calls.select("id", F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col(f"chr{k}").alias("chr"), F.col(f"pos{k}").cast("long").alias("pos")) for k in (1, 2)))).alias("e")).select("id", "e.*")
    marked = ends.join(F.broadcast(centtel), "chr").withColumn("bad", in_centromere_or_telomere(F.col("pos")))
    bad = marked.filter("bad").select("id").distinct()
    name = F.col("chr").cast("string")
    none = F.lit(None).cast(calls.schema["id"].dataType)

    def boundary(df: DataFrame, pos: Column, rank: int, label: Column) -> DataFrame:
        return df.select("chr", pos.cast("long").alias("pos"), F.lit(rank).alias("rank"), (F.col("id") if "id" in df.columns else none).alias("id"), label.alias("label"))

    cuts = boundary(marked.join(bad, "id", "left_anti"), F.col("pos"), 1, F.concat_ws(":", F.col("id").cast("string"), F.col("k").cast("string")))
    cuts = cuts.unionByName(boundary(breaks.select("chr", "pos"), F.col("pos"), 2, F.lit("cn_bkpt")))
    for side in ("cen_start", "cen_end"):
        cuts = cuts.unionByName(boundary(centtel.filter(F.col(side) != 0), F.col(side), 3, F.lit("centromere")))
    cuts = cuts.unionByName(boundary(centtel, F.col("ptel"), 0, F.concat(name, F.lit("_ptel")))).unionByName(boundary(centtel, F.col("qtel"), 4, F.concat(name, F.lit("_qtel"))))
    # the telomeres stand first and last whatever their places are
    w = Window.partitionBy("chr").orderBy(F.when(F.col("rank") == 0, 0).when(F.col("rank") == 4, 2).otherwise(1), "pos", "rank", "id", "label")
    out = cuts.withColumn("end", F.lead("pos").over(w)).withColumn("end_bkpt", F.lead("label").over(w)).filter("end IS NOT NULL")
    out = out.join(F.broadcast(centtel.select("chr", F.col("cen_start").alias("_cen"))), "chr")
    return out.select("chr", F.col("pos").alias("start"), "end", F.col("label").alias("start_bkpt"), "end_bkpt", ((F.col("rank") == 0) & (F.col("_cen") == 0)).alias("no_cn"))


def attach_breakpoints(segments: DataFrame, calls: DataFrame) -> DataFrame:
    """``segments`` with ``low_boundary, low_bkpt, high_boundary, high_bkpt`` for their labels ``start_bkpt, end_bkpt``.

    A label ``id:end`` of a call (``id, strand1, strand2``) is the boundary ``rg``; the breakpoint itself belongs to the
    segment on its own side: the one that starts there if the end's strand is -, that ends there if it is +. A label of an
    unknown call becomes ``cn_bkpt``; others stay.
    """
    out = segments
    for side, label, strand in (("low", "start_bkpt", "-"), ("high", "end_bkpt", "+")):
        names = F.explode(F.array(*(F.struct(F.concat(F.col("id").cast("string"), F.lit(f":{k}")).alias("name"), F.col(f"strand{k}").alias("strand")) for k in (1, 2))))
        ends = calls.select(names.alias("e")).select(F.col("e.name").alias("_name"), F.col("e.strand").alias("_strand"))
        known = F.col("_name").isNotNull()
        kind = F.when(known, "rg").when(F.col(label).contains(":"), "cn_bkpt").otherwise(F.col(label))
        out = out.join(ends, F.col(label) == F.col("_name"), "left")
        out = out.withColumn(f"{side}_boundary", kind).withColumn(f"{side}_bkpt", F.when(known & (F.col("_strand") == strand), F.col(label))).drop("_name", "_strand")
    return out


def collect_support_reads(calls: DataFrame, reads: DataFrame, names: DataFrame, slop: int = 1000, by: tuple[str, ...] = ("id",), carry: tuple[str, ...] = (), unfold: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``id, qname, mate`` of a call's own reads (``names``: ``id, qname``) that lie at its first end with mates at its second.

    Ends are ``chr1, pos1, strand1, chr2, pos2, strand2``; a read and its mate overlap ``slop`` bases around them on their
    strands, and on one chromosome and strand they lie in the ends' order. Supplementary, unpaired and unmapped reads
    (``flag``, if there is one) take no part. Reads are found by name, so no interval is searched. Calls may be told apart by
    more columns (``by``), and a read's columns ``carry`` come along. If a row of ``reads`` stands for a pair, ``unfold`` makes reads of the
    rows that have met, whose ``id`` and ``qname`` stay.
    """
    if "flag" in reads.columns:
        reads = reads.filter(expr.flags_fit(F.col("flag"), expr.PAIRED, expr.UNMAPPED | expr.MATE_UNMAPPED | SUPPLEMENTARY))
    # names and reads move once, by name; calls, which are fewer, come to what has met
    named = names.select("id", "qname").repartition("qname").distinct()
    columns = ["qname", "mate", "chr", "pos", "strand", "mate_chr", "mate_pos", "mate_strand", "read_len", *(x for x in carry if x not in ("pos", "read_len"))]
    met = unfold(named.join(reads, "qname")).select("id", *columns) if unfold else named.join(reads.select(*columns), "qname")
    met = met.join(calls.select(*by, "chr1", "pos1", "strand1", "chr2", "pos2", "strand2"), "id")
    c = F.col
    placed = (c("chr") == c("chr1")) & (c("strand") == c("strand1")) & (c("mate_chr") == c("chr2")) & (c("mate_strand") == c("strand2"))
    near = [(c(p) <= c(e) + slop) & (c(p) + c("read_len") - 1 >= c(e) - slop) for p, e in (("pos", "pos1"), ("mate_pos", "pos2"))]
    apart = (c("chr1") != c("chr2")) | (c("strand1") != c("strand2"))
    ordered = F.when(c("pos1") <= c("pos2"), c("pos") <= c("mate_pos")).otherwise(c("pos") >= c("mate_pos"))
    return met.filter(placed & near[0] & near[1] & (apart | ordered)).select(*by, "qname", "mate", *carry).dropDuplicates([*by, "qname", "mate"])


def remap_scores(reads: DataFrame, scores: DataFrame, least: int = 3) -> DataFrame:
    """``id, side, n_reads, score`` of reads ``id, side, read_id`` and their best alignments ``read_id, target, score``.

    The score is the most by which a read fits its own place (``target`` false) better than the rearranged one (0 without an
    alignment there); null with fewer than ``least`` reads, or if none fits its own place.
    """
    best = scores.groupBy("read_id").agg(F.max(F.when(~F.col("target"), F.col("score"))).alias("source"), F.max(F.when(F.col("target"), F.col("score"))).alias("there"))
    met = reads.join(best, "read_id", "left").groupBy("id", "side").agg(F.count("*").alias("n_reads"), F.max(F.col("source") - F.coalesce("there", F.lit(0))).alias("most"))
    return met.select("id", "side", "n_reads", F.when(F.col("n_reads") >= least, F.col("most")).alias("score"))


def joined_names(col: str, unique: bool) -> Column:
    """Comma-joined lists as one list in order: of each name once, or of all."""
    every = F.filter(F.flatten(F.collect_list(F.split(col, ","))), lambda x: x != "")
    return F.array_join(F.array_sort(F.array_distinct(every) if unique else every), ",")


def merge_expressions(columns: list[str]) -> dict[str, Column]:
    """What becomes of each column when calls are merged: bounds widen, counts of reads are those of different ``names``, counts
    of other samples add up, lists are joined, ``count`` adds up what has become of the columns ``*_count``, ``bkpt_distance`` is
    that of the merged bounds, ``occ_l`` and ``occ_h`` are those of the last call by location."""
    names = F.size(F.array_distinct(F.filter(F.flatten(F.collect_list(F.split("names", ","))), lambda x: x != "")))
    rules = {
        "start1": F.min("start1"), "end1": F.max("end1"), "start2": F.min("start2"), "end2": F.max("end2"), "id": joined_names("id", unique=False),
        "names": joined_names("names", unique=True), "score": names, "tumour_count": names, "normal_count": F.sum("normal_count"), "np_count": F.sum("np_count"),
        "np_sample_count": F.sum("np_sample_count"), "sample": joined_names("sample", unique=True), "sample_type": joined_names("sample_type", unique=True), "repeats": joined_names("repeats", unique=False),
        "inv": joined_names("inv", unique=False), "range_blat": joined_names("range_blat", unique=False),
    }
    last = F.struct(*(c for c in ("start1", "end1", "start2", "end2", "id") if c in columns))
    rules |= {c: F.max_by(c, last) for c in ("occ_l", "occ_h")}
    counts = [rules[c] for c in columns if c.endswith("_count") and c in rules]
    rules["count"] = sum(counts[1:], counts[0]) if counts else F.lit(0)
    apart = F.count(F.when(F.col("bkpt_distance") == -1, 1))
    mixed = F.raise_error(F.lit("calls within and across chromosomes can't be merged"))
    rules["bkpt_distance"] = F.when(apart == F.count("*"), F.lit(-1)).when(apart > 0, mixed).otherwise(F.min("start2") - F.min("start1"))
    return rules


def merge_calls(calls: DataFrame, key: str) -> DataFrame:
    """One call for each value of ``key``, where calls of one row stay as they are.

    Columns without a rule of :func:`merge_expressions` must be equal within it, else an error.
    """
    rules = merge_expressions(calls.columns)

    def same(col: str) -> Column:
        wrong = F.raise_error(F.concat(F.lit(f"{col} differs within "), F.col(key).cast("string")))
        return F.when(F.min(col).eqNullSafe(F.max(col)) & (F.count(col).isin(0) | (F.count(col) == F.count("*"))), F.min(col)).otherwise(wrong)

    one = F.count("*") == 1
    return calls.groupBy(key).agg(*((F.when(one, F.min(c)).otherwise(rules[c]) if c in rules else same(c)).alias(c) for c in calls.columns if c != key))
