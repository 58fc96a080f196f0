"""Operators on nucleotide sequences: k-mers, composition and screens against a library."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import expr
from . import kmer_counts

#: Letters of a piece: a long sequence is cut into overlapping pieces first, as finding a place in a string costs its offset.
PIECE = 256


def kmer_rows(seqs: DataFrame, k: int, seq: str = "seq", strandless: bool = False, step: int = 1) -> DataFrame:
    """A row ``pos, kmer`` (``pos`` from 0) for each place, or each ``step``-th, of each sequence; sequences shorter than ``k`` have none.

    ``strandless`` gives the smaller of each k-mer and its reverse complement, which is cut from that of the whole piece.
    """
    rest, size = [c for c in seqs.columns if c != seq], max(PIECE // step, 1) * step
    long_enough = seqs.filter(F.length(seq) >= k)
    starts = F.explode(F.sequence(F.lit(0), F.floor((F.length(seq) - k) / size).cast("int"))).alias("_piece")
    pieces = long_enough.select(*rest, seq, starts).select(*rest, "_piece", F.substring(F.col(seq), F.col("_piece") * size + 1, F.lit(size + k - 1)).alias("_text"))
    n = F.length("_text") - k
    if strandless:
        pieces = pieces.withColumn("_back", expr.revcomp(F.col("_text")))
    at = lambda text, place: F.substring(F.col(text), place + 1, F.lit(k))
    places = F.explode(F.sequence(F.lit(0), n, F.lit(step))).alias("_at")
    kmer = F.least(at("_text", F.col("_at")), at("_back", n - F.col("_at"))) if strandless else at("_text", F.col("_at"))
    return pieces.select("*", places).select(*rest, (F.col("_piece") * size + F.col("_at")).cast("long").alias("pos"), kmer.alias("kmer"))


def kmers(seqs: DataFrame, k: int, by: list[str], cutoff: float = 1.001, pure: bool = False) -> DataFrame:
    """``*by, kmer, n``: how often each k-mer, or its reverse complement if that is smaller, occurs; above ``cutoff`` times.

    With ``pure`` those of A, C, G, T alone. These are counted as numbers if ``k`` is 31 at most (:mod:`.kmer_counts`).
    """
    if kmer_counts.M <= k <= 31:
        counted = kmer_counts.pure_kmers(seqs.select(*by, "seq"), k, by, cutoff)
        if pure:
            return counted
        seqs, rest = seqs.filter(F.col("seq").rlike("[^ACGT]")), F.col("kmer").rlike("[^ACGT]")
    else:
        counted, rest = None, F.col("kmer").rlike("^[ACGT]+$") if pure else F.lit(True)
    others = kmer_rows(seqs.select(*by, "seq"), k, strandless=True).filter(rest).groupBy(*by, "kmer").agg(F.count("*").alias("n")).filter(F.col("n") > cutoff)
    return others if counted is None else counted.unionByName(others)


def letters(text: Column, kept: str) -> Column:
    """Number of letters of ``text`` among ``kept``."""
    return F.length(F.regexp_replace(text, f"[^{kept}]", ""))


def gc_bins(seqs: DataFrame, size: int = 500) -> DataFrame:
    """``n_non_n`` and ``gc`` of each window of ``size`` letters; ``gc`` has six decimals and is null where it is 0."""
    rest = [c for c in seqs.columns if c != "seq"]
    at = F.explode(F.sequence(F.lit(0), F.floor((F.length("seq") - 1) / size).cast("int"))).alias("bin")
    windows = seqs.filter("length(seq) > 0").select(*rest, "seq", at).select(*rest, "bin", F.substring(F.col("seq"), F.col("bin") * size + 1, F.lit(size)).alias("part"))
    counted = windows.select(*rest, F.col("bin").cast("long").alias("bin"), letters(F.col("part"), "ACGT").cast("long").alias("n_non_n"), letters(F.col("part"), "GC").alias("_gc"))
    return counted.select(*rest, "bin", "n_non_n", F.when(F.col("_gc") > 0, F.round(F.col("_gc") / F.col("n_non_n"), 6)).alias("gc"))


def contaminant_hits(reads: DataFrame, library: DataFrame, min_match: int = 80, k: int = 40) -> DataFrame:
    """``read_id, item_id, score``: the library entry that shares the longest string with each read, of ``min_match`` letters
    at least; ties go to the smaller entry. Shared k-mers seed the search; seeds in a row on one diagonal are one string.

    A string of ``min_match`` letters has a k-mer at one of the read's places that ``min_match - k + 1`` divides: reads without a
    shared one there have none and are left out first."""
    seeds = kmer_rows(library.select("item_id", "seq"), k).withColumnRenamed("pos", "library_pos")
    sampled = kmer_rows(reads.select("read_id", "seq"), k, step=max(min_match - k + 1, 1))
    some = sampled.join(seeds.select("kmer").distinct(), "kmer", "left_semi").select("read_id").distinct()
    reads = reads.join(some, "read_id", "left_semi")
    hits = kmer_rows(reads.select("read_id", "seq"), k).join(seeds, "kmer").select("read_id", "item_id", "pos", (F.col("pos") - F.col("library_pos")).alias("diagonal"))
    line = Window.partitionBy("read_id", "item_id", "diagonal").orderBy("pos")
    runs = hits.withColumn("run", F.col("pos") - F.row_number().over(line)).groupBy("read_id", "item_id", "diagonal", "run").agg((F.count("*") + k - 1).alias("score"))
    found = runs.filter(F.col("score") >= min_match)
    best = found.groupBy("read_id").agg(F.max(F.struct("score", (-F.col("item_id")).alias("_item"))).alias("best"))
    return best.select("read_id", (-F.col("best._item")).alias("item_id"), F.col("best.score").alias("score"))
