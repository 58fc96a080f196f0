"""Registered queries of the sequence and comparison operators, and the SQL for their rows."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr
from ..operators import compare, sequences
from .queries import CALL, CALL_COLUMNS, DEPTH, ENDS, C, P, S, depths
from .views import BEDPE, READ_PAIRS, SEGMENTS, view

LETTERS, BASES = string.ascii_lowercase + string.ascii_uppercase, ("ACGT" * 13)[:52]
SEQ = f"translate(regexp_replace(coalesce(text, ''), '[^a-zA-Z]', '', 'g'), '{LETTERS}', '{BASES}')"
QUERIES, SQL = {}, {}


def sequence_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Texts as sequences: other characters than A-Z and a-z go, letters become bases."""
    seq = F.translate(F.regexp_replace(F.coalesce("text", F.lit("")), "[^a-zA-Z]", ""), LETTERS, BASES)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns, seq.alias("seq"))


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


@query(f"SELECT doc_id, md5(reverse(translate({SEQ}, 'ACGT', 'TGCA'))) AS revcomp_md5 FROM documents")
def b26_revcomp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence_table(spark, sf_dir, "documents", "doc_id").select("doc_id", F.md5(expr.revcomp(F.col("seq"))).alias("revcomp_md5"))


@query(f"""WITH s AS (SELECT doc_id, {SEQ} AS seq FROM documents), w AS (SELECT doc_id, seq, unnest(range((length(seq) + 499) // 500)) AS bin FROM s),
 p AS (SELECT doc_id, bin, substr(seq, bin * 500 + 1, 500) AS part FROM w)
 SELECT doc_id, bin, length(part) AS n_non_n, CASE WHEN regexp_matches(part, '[GC]') THEN round(length(regexp_replace(part, '[^GC]', '', 'g')) / length(part), 6) END AS gc FROM p""")
def e08_gc_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.gc_bins(sequence_table(spark, sf_dir, "documents", "doc_id"))


def kmer_sql(table: str, key: str, k: int) -> str:
    """Rows ``key, pos, kmer``; texts are ASCII, so places in them are cheap."""
    return f"(SELECT {key}, pos, substr(seq, pos + 1, {k}) AS kmer FROM (SELECT {key}, seq, unnest(range(length(seq) - {k - 1})) AS pos FROM (SELECT {key}, {SEQ} AS seq FROM {table}) WHERE length(seq) >= {k}))"


@query(f"SELECT source, least(kmer, reverse(translate(kmer, 'ACGT', 'TGCA'))) AS kmer, count(*) AS n FROM {kmer_sql('documents', 'source', 21)} GROUP BY 1, 2 HAVING count(*) > 1")
def h01_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.kmers(sequence_table(spark, sf_dir, "documents", "source"), 21, ["source"], pure=True)


@query(f"""WITH h AS (SELECT doc_id, item_id, r.pos, r.pos - l.pos AS diagonal FROM {kmer_sql('documents', 'doc_id', 40)} r JOIN {kmer_sql('benchmark', 'item_id', 40)} l ON r.kmer = l.kmer),
 n AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY pos) AS run FROM h),
 s AS (SELECT doc_id, item_id, count(*) + 39 AS score FROM n GROUP BY doc_id, item_id, diagonal, run HAVING count(*) + 39 >= 80),
 b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, item_id) AS r FROM s) SELECT doc_id AS read_id, item_id, score FROM b WHERE r = 1""")
def f03_contaminant_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = sequence_table(spark, sf_dir, "documents", "doc_id").withColumnRenamed("doc_id", "read_id")
    return sequences.contaminant_hits(reads, sequence_table(spark, sf_dir, "benchmark", "item_id"))


@query(f"""WITH c AS {C}, n AS (SELECT a.id, count(b.id) AS n_old FROM (SELECT * FROM c WHERE id % 2 = 1) a LEFT JOIN (SELECT * FROM c WHERE id % 2 = 0) b ON a.chr1 = b.chr1 AND a.chr2 = b.chr2 AND a.strand1 = b.strand1
 AND a.strand2 = b.strand2 AND a.start1 - 5000 <= b.end1 AND b.start1 <= a.end1 + 5000 AND a.start2 - 5000 <= b.end2 AND b.start2 <= a.end2 + 5000 GROUP BY a.id)
 SELECT id, n_old, CASE n_old WHEN 0 THEN 'UNIQUE' WHEN 1 THEN 'COMMON' ELSE 'MULTI' END AS tag FROM n""")
def c18_compare_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls of odd ids against those of even ids: two call sets from one table, every call in one of them."""
    every = view(spark, sf_dir, BEDPE)
    return compare.compare_calls(every.filter("id % 2 = 0"), every.filter("id % 2 = 1"), slop=5000)


@query(f"""WITH s AS {S} SELECT qname, chr_l AS chr, pos_l - 1 AS "start", pos_l - 1 + read_len AS "end" FROM {P}
 WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.source = 'A' AND s.chr = chr_l AND s."start" < pos_l - 1 + read_len AND pos_l - 1 < s."end")""")
def c04_exclude_overlapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = view(spark, sf_dir, READ_PAIRS)
    reads = pairs.select("qname", F.col("chr_l").alias("chr"), (F.col("pos_l") - 1).alias("start"), (F.col("pos_l") - 1 + F.col("read_len")).alias("end"))
    return compare.exclude_overlapping(reads, view(spark, sf_dir, SEGMENTS).filter("source = 'A'"))


@query(f"""WITH {ENDS}, {DEPTH}, s AS {S} SELECT seg_id, count(d.bin) AS n_win, CASE WHEN count(d.bin) >= 10 THEN median(d.tumour) END AS "median"
 FROM s LEFT JOIN d ON d.chr = s.chr AND d.bin * 500 >= s."start" AND d.bin * 500 < s."end" GROUP BY seg_id""")
def e14_segment_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.segment_medians(depths(spark, sf_dir), view(spark, sf_dir, SEGMENTS), "tumour")


@query(f"""SELECT {CALL} FROM {C} WHERE NOT (chr1 = chr2 AND ((strand1 = strand2 AND (tumour_count < 4 OR (tumour_count < 10 AND list_min([abs(start1 - start2), abs(start1 - end2), abs(end1 - start2), abs(end1 - end2)]) < 5000))) OR (strand1 = '+' AND strand2 = '-' AND start2 - end1 < 500)))""")
def e17_discard_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.discard_small(view(spark, sf_dir, BEDPE)).select(*CALL_COLUMNS)
