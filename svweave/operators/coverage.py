"""Counts over genome windows, insert sizes, and copy-number arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WINDOW = 500


def coverage(windows: DataFrame, reads: DataFrame, size: int = WINDOW, out: str = "depth") -> DataFrame:
    """Reads ``chr, start, end`` (0-based, half-open) that overlap each fixed-size window ``chr, bin``; zeros are kept.

    A read is counted in each bin it touches before anything is shuffled, so a window's rows are pre-aggregated.
    """
    hit = reads.select("chr", F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((F.col("end") - 1) / size))).alias("bin"))
    counted = hit.groupBy("chr", "bin").agg(F.count("*").alias(out))
    return windows.join(counted, ["chr", "bin"], "left").withColumn(out, F.coalesce(out, F.lit(0)))


def insert_size_histogram(pairs: DataFrame, chrom: int = 5, most: int = 3000) -> DataFrame:
    """Dense ``size, n`` from 0 to ``most`` of pairs within one chromosome."""
    spark = pairs.sparkSession
    sizes = pairs.filter((F.col("chr_l") == chrom) & (F.col("chr_h") == chrom)).select((F.col("pos_h") - F.col("pos_l")).alias("size")).filter(F.col("size").between(0, most))
    counted = sizes.groupBy("size").agg(F.count("*").alias("n"))
    return spark.range(most + 1).select(F.col("id").alias("size")).join(counted, "size", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def log_ratios(depths: DataFrame, ploidy: float = 2.0, purity: float = 0.75) -> DataFrame:
    """``logratio`` of tumour and normal depths after scaling to equal totals, and ``abs_cn`` around the median."""
    every = depths.agg(F.sum("normal").alias("sn"), F.sum("tumour").alias("st"))
    scaled = depths.crossJoin(F.broadcast(every)).withColumn("logratio", F.log2((F.col("tumour") * F.col("sn") / F.col("st") + 0.1) / (F.col("normal") + 0.1)))
    middle = scaled.agg(F.median("logratio").alias("middle"))
    level = F.log2(F.lit((purity * ploidy + (1 - purity) * 2) / 2))
    out = scaled.crossJoin(F.broadcast(middle)).withColumn("logratio", F.col("logratio") - F.col("middle") + level)
    return out.withColumn("abs_cn", (F.pow(F.lit(2.0), 1 + F.col("logratio")) - 2 * (1 - purity)) / purity).drop("sn", "st", "middle")


def link_segments(segments: DataFrame) -> DataFrame:
    """Previous and next segment of each on its chromosome."""
    w = Window.partitionBy("chr").orderBy("start", "end", "seg_id")
    return segments.withColumn("prev_id", F.lag("seg_id").over(w)).withColumn("next_id", F.lead("seg_id").over(w))
