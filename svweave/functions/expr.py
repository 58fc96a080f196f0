"""Column expressions on alignments, pairs and calls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the SAM format.
PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED, REVERSE, MATE_REVERSE, FIRST = 0x1, 0x2, 0x4, 0x8, 0x10, 0x20, 0x40


def flags_fit(flag: Column, require: int = 0, exclude: int = 0) -> Column:
    """All bits of ``require`` and none of ``exclude``."""
    return (flag.bitwiseAND(require) == require) & (flag.bitwiseAND(exclude) == 0)


def is_foldback_read(flag: Column, rname: Column, rnext: Column) -> Column:
    """Mate on the same chromosome and both on one strand."""
    return ((rnext == "=") | (rnext == rname)) & ((flag.bitwiseAND(REVERSE) > 0) == (flag.bitwiseAND(MATE_REVERSE) > 0))


def window_low(pos: Column, strand: Column, read_len: Column, max_insert: Column) -> Column:
    return F.when(strand == "+", pos).otherwise(F.greatest(pos + read_len - max_insert, F.lit(1)))


def window_high(pos: Column, strand: Column, read_len: Column, max_insert: Column, ref_len: Column) -> Column:
    return F.least(F.when(strand == "+", pos + max_insert).otherwise(pos + read_len), ref_len)


def sanitise_sample(name: Column) -> Column:
    return F.regexp_replace(name, r"(?i)[^a-z0-9_\-.]", "_")


def breakpoint_distance(chr1: Column, chr2: Column, start1: Column, start2: Column) -> Column:
    """-1 across chromosomes; else from start to start, 0 if unknown."""
    return F.when(chr1 != chr2, F.lit(-1)).otherwise(F.coalesce(start2 - start1, F.lit(0)))


def sv_class(chr1: Column, chr2: Column, strand1: Column, strand2: Column, convention: str = "group") -> Column:
    """Class from the ends' strands; ``group``: +/- is a deletion, ``final``: ++ is one (the second strand is flipped)."""
    other = F.when(strand2 == "+", "-").otherwise("+") if convention == "final" else strand2
    kind = F.when(strand1 == other, "inversion").when(strand1 == "+", "deletion").otherwise("tandem-duplication")
    return F.when(chr1 != chr2, "translocation").otherwise(kind)


def sv_distance(chr1: Column, chr2: Column, end1: Column, start2: Column) -> Column:
    """-1 across chromosomes; else from the low end's end to the high end's start."""
    return F.when(chr1 != chr2, F.lit(-1)).otherwise(F.abs(start2 - end1))


def is_small_indel(chr1: Column, chr2: Column, strand1: Column, strand2: Column, end1: Column, start2: Column, most: int = 1000) -> Column:
    return (chr1 == chr2) & (strand1 == "+") & (strand2 == "-") & (start2 - end1 <= most)


def revcomp(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def clip_side(cigar: Column) -> Column:
    """``low``, ``high``, ``both`` or null: where a read is clipped."""
    low, high = cigar.rlike(r"^\d+[HS]"), cigar.rlike(r"\d+[HS]$")
    return F.when(low & high, "both").when(low, "low").when(high, "high")


def ref_end(pos: Column, cigar: Column) -> Column:
    """Last reference base that the alignment covers."""
    spans = F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    return pos + F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + x.cast("long")) - 1
