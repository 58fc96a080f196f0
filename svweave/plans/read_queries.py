"""Registered queries of read preparation, support and smoothing, and the SQL for their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import coverage, reads
from .queries import CALL, CALL_COLUMNS, DEPTH, ENDS, C, S, depths
from .views import BEDPE, READ_PAIRS, SEGMENTS, duck, view

_END = """SELECT qname, sample, {k} AS mate, chr_{a} AS chr, pos_{a} AS pos, strand_{a} AS strand, chr_{b} AS mate_chr, pos_{b} AS mate_pos, strand_{b} AS mate_strand, (mapq + {q}) % 61 AS mapq, read_len,
 CASE WHEN chr_l = chr_h THEN (pos_h + read_len - pos_l) * {s} ELSE 0 END AS tlen, CASE pos_{a} % 3 WHEN 0 THEN '40S60M' WHEN 1 THEN '100M' ELSE '70M30S' END AS cigar FROM rp"""
#: Two alignments a pair.
ALIGNMENTS = f"WITH rp AS ({READ_PAIRS}) " + _END.format(k=1, a="l", b="h", q=0, s=1) + " UNION ALL " + _END.format(k=2, a="h", b="l", q="pos_h", s=-1)
FEATURES = 'SELECT 1 + CAST(p_partkey AS BIGINT) % 5 chr, (CAST(p_partkey AS BIGINT) % 200) * 5000 + CAST(p_size AS BIGINT) "start", (CAST(p_partkey AS BIGINT) % 200) * 5000 + CAST(p_size AS BIGINT) * 21 "end" FROM part'
A = f"({duck(ALIGNMENTS)})"
QUERIES, SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey").cast("long"), F.col("p_size").cast("long")
    return spark.read.parquet(f"{sf_dir}/part.parquet").select((1 + key % 5).alias("chr"), (key % 200 * 5000 + size).alias("start"), (key % 200 * 5000 + size * 21).alias("end"))


def placed(df: DataFrame) -> DataFrame:
    return df.withColumn("start", F.col("pos") - 1).withColumn("end", F.col("pos") - 1 + F.col("read_len"))


@query(f"WITH r AS (SELECT DISTINCT chr FROM {S} WHERE source = 'A' AND chr <> 3) SELECT qname, mate FROM {A} WHERE chr IN (SELECT chr FROM r) AND mate_chr IN (SELECT chr FROM r)")
def b02_limit_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.limit_refs(view(spark, sf_dir, ALIGNMENTS), view(spark, sf_dir, SEGMENTS).filter("source = 'A' AND chr <> 3")).select("qname", "mate")


@query(f"""SELECT qname FROM {A} GROUP BY qname HAVING count(*) FILTER (mate = 1) = 1 AND count(*) FILTER (mate = 2) = 1 AND min(mapq) >= 6 AND NOT bool_or(chr = mate_chr AND abs(tlen) < 2 * read_len)""")
def b03_prep_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.prep_pairs(view(spark, sf_dir, ALIGNMENTS))


@query(f"WITH a AS {A} SELECT qname, mate, mapq FROM a ANTI JOIN (SELECT DISTINCT qname FROM a WHERE mapq < 10) USING (qname)")
def b10_exclude_by_qname(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = view(spark, sf_dir, ALIGNMENTS)
    return reads.exclude_by_qname(every, every.filter("mapq < 10")).select("qname", "mate", "mapq")


@query(f"SELECT {CALL} FROM {C} WHERE tumour_count > 0 AND NOT (chr1 = chr2 AND strand1 = '+' AND strand2 = '-' AND start2 + 1 - end1 <= 200)")
def b15_prefilter_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.prefilter_groups(view(spark, sf_dir, BEDPE)).select(*CALL_COLUMNS)


FOLD = f"f AS (SELECT chr, unnest(range((pos - 1) // 500, (pos + 98) // 500 + 1)) AS bin FROM {A} WHERE sample = 'T1' AND chr = mate_chr AND strand = mate_strand), n AS (SELECT chr, bin, count(*) AS n FROM f GROUP BY ALL)"
BOTH = f"b AS (SELECT d.chr, d.bin, d.tumour AS depth, coalesce(n.n, 0) AS fb_depth FROM d LEFT JOIN n ON d.chr = n.chr AND d.bin = n.bin)"


def foldback_coverage(spark: SparkSession, sf_dir: str, depth: DataFrame) -> DataFrame:
    """Windows of ``depth`` with their foldback reads."""
    fold = placed(view(spark, sf_dir, ALIGNMENTS).filter("sample = 'T1' AND chr = mate_chr AND strand = mate_strand"))
    return coverage.coverage(depth.select("chr", "bin", F.col("tumour").alias("depth")), fold, out="fb_depth")


@query(f"WITH {ENDS}, {DEPTH}, {FOLD}, {BOTH} SELECT * FROM b")
def c02_foldback_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return foldback_coverage(spark, sf_dir, depths(spark, sf_dir))


@query(f"""WITH {ENDS}, {DEPTH}, {FOLD}, {BOTH}, r AS (SELECT *, (fb_depth + (SELECT avg(fb_depth / (depth + fb_depth)) FROM b WHERE depth + fb_depth > 0)) / (depth + fb_depth + 1) AS raw FROM b)
 SELECT chr, bin, round(least(raw, (SELECT quantile_cont(raw, 0.99) FROM r)), 6) AS fb_ratio FROM r""")
def m02_foldback_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.foldback_ratio(c02_foldback_coverage(spark, sf_dir)).select("chr", "bin", F.round("fb_ratio", 6).alias("fb_ratio"))


@query(f"""WITH a AS (SELECT qname, mate, chr, pos - 1 AS s, pos - 1 + read_len AS e FROM {A}), f AS (SELECT DISTINCT * FROM ({FEATURES})),
 m AS (SELECT qname, mate, e - s AS len, greatest(s, "start") AS lo, least(e, "end") AS hi FROM a JOIN f ON a.chr = f.chr AND s < "end" AND "start" < e),
 w AS (SELECT *, max(hi) OVER (PARTITION BY qname, mate ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM m)
 SELECT qname, mate, sum(greatest(hi - greatest(lo, coalesce(reach, lo)), 0))::BIGINT AS covered FROM w GROUP BY qname, mate HAVING covered >= max(len) - 10""")
def c05_covered_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.covered_by(placed(view(spark, sf_dir, ALIGNMENTS)), features(spark, sf_dir))


def _reach(k: int) -> str:
    return f"trunc((start{k} + end{k}) / 2 - CASE strand{k} WHEN '+' THEN 900 ELSE 100 END) AS lo{k}, trunc((start{k} + end{k}) / 2 + CASE strand{k} WHEN '+' THEN 100 ELSE 900 END) AS hi{k}"


@query(f"""WITH c AS (SELECT *, {_reach(1)}, {_reach(2)} FROM {C}), a AS {A} SELECT DISTINCT id, qname FROM c JOIN a ON chr = chr1 AND strand = strand1 AND mate_chr = chr2 AND mate_strand = strand2
 AND pos <= hi1 AND pos + 99 >= lo1 AND mate_pos <= hi2 AND mate_pos + 99 >= lo2
 AND (chr <> mate_chr OR strand <> mate_strand OR (start1 + end1 <= start2 + end2 AND pos <= mate_pos) OR (start1 + end1 > start2 + end2 AND pos >= mate_pos))""")
def c13_collect_end_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.collect_end_reads(view(spark, sf_dir, BEDPE), view(spark, sf_dir, ALIGNMENTS))


LAST = "pos + CASE cigar WHEN '40S60M' THEN 59 WHEN '100M' THEN 99 ELSE 69 END"


@query(f"""WITH p AS (SELECT chr, strand, pos // 5000 AS spot, {LAST} AS place, count(*) FILTER (cigar = '70M30S') AS n FROM {A} GROUP BY ALL),
 g AS (SELECT chr, strand, spot, sum(n)::BIGINT AS n_clipped, max(place) AS edge FROM p GROUP BY ALL),
 m AS (SELECT chr, strand, spot, place, row_number() OVER (PARTITION BY chr, strand, spot ORDER BY n DESC, place) AS r FROM p WHERE n > 0)
 SELECT g.chr, g.strand, g.spot, n_clipped, CASE WHEN n_clipped >= 2 THEN place ELSE edge END AS bkpt FROM g LEFT JOIN m ON g.chr = m.chr AND g.strand = m.strand AND g.spot = m.spot AND r = 1""")
def e09_clip_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.clip_mode(view(spark, sf_dir, ALIGNMENTS).withColumn("spot", F.floor(F.col("pos") / 5000)), ["chr", "strand", "spot"], "high")


@query(f"SELECT sample, chr, pos // 5000 AS spot, max({LAST}) - min(pos) + 1 AS footprint FROM {A} GROUP BY ALL")
def e11_footprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.footprint(view(spark, sf_dir, ALIGNMENTS).withColumn("spot", F.floor(F.col("pos") / 5000)), ["sample", "chr", "spot"])


@query(f"""WITH s AS {S}, m AS (SELECT seg_id, sum(least("end", pos - 1 + read_len) - greatest("start", pos - 1)) AS bases FROM s JOIN {A} a ON a.chr = s.chr AND pos - 1 < "end" AND "start" < pos - 1 + read_len GROUP BY 1)
 SELECT seg_id, round(coalesce(bases, 0) / ("end" - "start") + 0.01, 6) AS mean_depth FROM s LEFT JOIN m USING (seg_id)""")
def e15_segment_mean_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.segment_mean_depth(placed(view(spark, sf_dir, ALIGNMENTS)), view(spark, sf_dir, SEGMENTS)).select("seg_id", F.round("mean_depth", 6).alias("mean_depth"))


@query(f"""WITH {ENDS}, {DEPTH}, i AS (SELECT chr, bin, tumour, least(bin + 1, 2002 - bin) AS edge, median(tumour) OVER (PARTITION BY chr ORDER BY bin ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS m3,
 median(tumour) OVER (PARTITION BY chr ORDER BY bin ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS m5 FROM d), s AS (SELECT *, CASE WHEN edge = 2 THEN m3 ELSE m5 END AS s FROM i),
 t AS (SELECT *, CASE WHEN bin = 0 THEN lead(s) OVER w ELSE lag(s) OVER w END AS a, CASE WHEN bin = 0 THEN lead(s, 2) OVER w ELSE lag(s, 2) OVER w END AS b FROM s WINDOW w AS (PARTITION BY chr ORDER BY bin))
 SELECT chr, bin, CASE WHEN edge = 1 THEN list_sort([tumour::DOUBLE, a, 3 * a - 2 * b])[2] ELSE s END AS smooth FROM t""")
def w01_running_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.running_median(depths(spark, sf_dir).select("chr", "bin", "tumour"), "tumour").select("chr", "bin", "smooth")


@query(f"""SELECT seg_id, chr, coalesce(floor((lag("end") OVER w + "start") / 2), "start")::BIGINT AS "start", coalesce(floor(("end" + lead("start") OVER w) / 2), "end")::BIGINT AS "end" FROM {S} WINDOW w AS (PARTITION BY chr ORDER BY "start", "end", seg_id)""")
def w03_snap_segment_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.snap_segment_edges(view(spark, sf_dir, SEGMENTS))
