"""Variant records of calls: assembled breakends take the place of the others, and classes are written to both ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

COLUMNS = ["chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", "format", "normal", "tumour"]
#: Fixed values of the format: what the combined records add to a header.
NEW_INFO = (
    '##INFO=<ID=BAS,Number=.,Type=Integer,Description="Assembly score: at most 100, for a perfect pattern of five vertices">',
    '##INFO=<ID=SVCLASS,Number=.,Type=String,Description="Class: deletion, inversion, tandem-duplication, translocation">',
)
NEW_FORMAT = '##FORMAT=<ID=PS,Number=1,Type=Integer,Description="Count of pairs that span this breakpoint">'


def joined(*parts: Column) -> Column:
    """Entries with single semicolons between them."""
    return F.regexp_replace(F.concat_ws(";", *parts), ";;", ";")


def combine_vcf(records: DataFrame, assembled: DataFrame, classes: DataFrame) -> DataFrame:
    """``records`` (:data:`COLUMNS`, two rows ``call_1``, ``call_2`` a call) with what ``assembled`` and ``classes`` know of them.

    A record whose id is in ``assembled`` takes its place, alleles and INFO, to which its own ``TSRDS`` and the assembly score (the
    other's QUAL, as ``BAS``) are added, and loses its QUAL. FORMAT gains ``PS``, which is 0 in the normal and, in the tumour, what the
    assembled record has, else 0; the counts stand first. Both ends of a call get ``BKDIST`` (a number of its own goes) and
    ``SVCLASS`` from ``classes`` (``id, bkptdist, svclass`` by call). A call without two records, or that ``classes`` lacks, and an id that
    ``assembled`` repeats are errors.
    """
    taken = ["pos", "ref", "alt", "qual", "info", "tumour"]
    once = assembled.groupBy("id").agg(F.count("*").alias("_n"), F.first(F.struct(*taken)).alias("_a"))
    base = F.substring_index("id", "_", 1)
    met = records.join(once, "id", "left").withColumn("_call", base).withColumn("_ends", F.count("*").over(Window.partitionBy("_call")))
    known = classes.select(F.col("id").cast("string").alias("_call"), F.col("bkptdist").alias("_far"), F.col("svclass").alias("_class"))
    met = met.join(known, "_call", "left")

    def wrong(words: str) -> Column:
        return F.raise_error(F.concat(F.lit(words + ": "), F.col("id")))

    there = F.col("_a").isNotNull()
    own = F.nullif(F.regexp_extract("info", r"(TSRDS=[^;]+)", 1), F.lit(""))
    info = F.when(there, joined(F.col("_a.info"), own, F.concat(F.lit("BAS="), F.col("_a.qual")))).otherwise(F.col("info"))
    out = met.withColumn("_info", info)
    at = F.regexp_instr("_info", F.lit("BKDIST=[0-9]+"))
    number = F.regexp_extract("_info", "BKDIST=[0-9]+", 0)
    bare = F.when(at > 0, F.concat(F.substring(F.col("_info"), F.lit(1), at - 1), F.substring(F.col("_info"), at + F.length(number), F.length("_info")))).otherwise(F.col("_info"))
    added = joined(bare, F.concat(F.lit("BKDIST="), F.col("_far").cast("string")), F.concat(F.lit("SVCLASS="), F.col("_class")))
    whole = F.when(F.col("_ends") != 2, wrong("a call needs two records")).when(F.col("_class").isNull() | F.col("_far").isNull(), wrong("a call has no class")).when(F.col("_n") > 1, wrong("a record is assembled more than once")).otherwise(added)
    changed = {c: F.when(there, F.col("_a." + c)).otherwise(F.col(c)) for c in ("pos", "ref", "alt")}
    changed |= {"info": whole, "qual": F.when(there, F.lit(".")).otherwise(F.col("qual")), "format": F.concat("format", F.lit(":PS")), "normal": F.concat(F.lit("0:"), F.col("normal"))}
    changed["tumour"] = F.concat(F.when(there, F.concat(F.col("_a.tumour"), F.lit(":"))).otherwise(F.lit("0:")), F.col("tumour"))
    return out.withColumns(changed).select(*records.columns)


def combine_header(lines: list[str], tumour_facts: str) -> list[str]:
    """Header lines with the new INFO and FORMAT entries before the first of their kind and ``tumour_facts`` in the tumour's SAMPLE line."""
    out, seen = [], set()
    for line in lines:
        for kind, new in (("##INFO", NEW_INFO), ("##FORMAT", (NEW_FORMAT,))):
            if line.startswith(kind) and kind not in seen:
                seen.add(kind)
                out += new
        if line.startswith("##SAMPLE") and "=TUMOUR," in line and "sample" not in seen:
            seen.add("sample")
            line = f"{line[:-1]},{tumour_facts}{line[-1]}"
        out.append(line)
    return out


def write_vcf(records: DataFrame, header: list[str], path: str) -> None:
    """Text of records in order of place and id, each file headed by ``header``; nulls as ``.``."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in COLUMNS]
    ordered = records.repartitionByRange("chrom", "pos", "id").sortWithinPartitions("chrom", "pos", "id")
    text = ordered.select(F.concat_ws("\t", *fields).alias("value"))
    head = "\n".join([*header, "#" + "\t".join(["CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", "NORMAL", "TUMOUR"])])
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    text.select(F.when(first, F.concat(F.lit(head + "\n"), F.col("value"))).otherwise(F.col("value")).alias("value")).write.text(path)
