"""Text sources and sinks: SAM, BEDPE and copy-number CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BEDPE10 = "chr1 string, start1 long, end1 long, chr2 string, start2 long, end2 long, id string, score int, strand1 string, strand2 string"
_SAM = ["qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"]
_NUMBERS = {"flag": "int", "pos": "long", "mapq": "int", "pnext": "long", "tlen": "long"}


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of SAM text (gz too): eleven fields and ``tags`` as a map of TAG to its value."""
    f = F.split("value", "\t")
    tags = F.filter(F.slice(f, 12, F.greatest(F.size(f), F.lit(1))), lambda t: t.rlike("^[A-Za-z][A-Za-z0-9]:"))
    named = F.map_from_entries(F.transform(tags, lambda t: F.struct(F.substring(t, 1, 2), F.regexp_replace(t, "^..:.:", ""))))
    lines = spark.read.text(path).filter(~F.col("value").startswith("@"))
    return lines.select(*(F.get(f, F.lit(k)).cast(_NUMBERS.get(n, "string")).alias(n) for k, n in enumerate(_SAM)), named.alias("tags"))


def read_groups(spark: SparkSession, path: str) -> DataFrame:
    """``rg_id, sample, max_insert`` of the header's @RG lines (tag MI with or without ``Z:``)."""
    lines = spark.read.text(path).filter(F.col("value").startswith("@RG"))
    at = lambda tag: F.nullif(F.regexp_extract("value", rf"\t{tag}:(?:Z:)?([^\t]*)", 1), F.lit(""))
    return lines.select(at("ID").alias("rg_id"), at("SM").alias("sample"), at("MI").cast("int").alias("max_insert"))


def read_bedpe(spark: SparkSession, path: str) -> DataFrame:
    """The first ten BEDPE columns; header lines and malformed rows are left out."""
    return spark.read.option("sep", "\t").option("comment", "#").option("mode", "DROPMALFORMED").schema(BEDPE10).csv(path).filter("strand1 IN ('+', '-') AND strand2 IN ('+', '-')")


def read_cn_segments(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Copy-number segments of 8 or 6 comma-separated fields; 8-field rows with equal tumour and normal states are skipped."""
    f = F.split("value", ",")
    rows = spark.read.text(path).filter(F.size(f).isin(6, 8)).select(f.alias("f"))
    changed = (F.size("f") == 6) | ~((F.get("f", F.lit(4)) == F.get("f", F.lit(6))) & (F.get("f", F.lit(5)) == F.get("f", F.lit(7))))
    return rows.filter(changed).select(F.lit(source).alias("source"), F.get("f", F.lit(1)).alias("chr"), F.get("f", F.lit(2)).try_cast("long").alias("start"), F.get("f", F.lit(3)).try_cast("long").alias("end")).filter("start IS NOT NULL")


def write_bedpe(calls: DataFrame, path: str, columns: list[str]) -> None:
    """Tab-separated text; nulls as ``_``."""
    calls.select(*columns).write.option("sep", "\t").option("nullValue", "_").csv(path)


def write_by_chromosome(calls: DataFrame, path: str) -> None:
    """Parquet by chromosome, sorted by start: what region queries prune."""
    calls.repartitionByRange("chr1", "start1").sortWithinPartitions("chr1", "start1").write.partitionBy("chr1").parquet(path)
