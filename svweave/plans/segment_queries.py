"""Registered queries of segments, supporting reads and merged calls, and the SQL for their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr
from ..operators import results, segments
from .queries import DEPTH, ENDS, C, P, S, depths
from .read_queries import A, ALIGNMENTS
from .result_queries import T, bad, centtel
from .views import BEDPE, READ_PAIRS, SEGMENTS, view

QUERIES, SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


BOUNDS = f"""c AS {C}, ok AS (SELECT * FROM c WHERE NOT {bad('chr1', 'start1')} AND NOT {bad('chr2', 'end2')}),
 b AS (SELECT chr1 AS chr, start1 AS pos, 1 AS rank, id, id || ':1' AS label FROM ok UNION ALL SELECT chr2, end2, 1, id, id || ':2' FROM ok
 UNION ALL SELECT chr, "start", 2, NULL, 'cn_bkpt' FROM {S} UNION ALL SELECT chr, cen_start, 3, NULL, 'centromere' FROM {T} WHERE cen_start <> 0 UNION ALL SELECT chr, cen_end, 3, NULL, 'centromere' FROM {T}
 UNION ALL SELECT chr, ptel, 0, NULL, chr || '_ptel' FROM {T} UNION ALL SELECT chr, qtel, 4, NULL, chr || '_qtel' FROM {T}),
 g AS (SELECT chr, rank, pos AS start, lead(pos) OVER w AS "end", label AS start_bkpt, lead(label) OVER w AS end_bkpt FROM b WINDOW w AS (PARTITION BY chr ORDER BY rank = 4, rank <> 0, pos, rank, id, label))"""


def bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of all calls and of the starts of copy-number segments."""
    calls = view(spark, sf_dir, BEDPE).select("id", "chr1", F.col("start1").alias("pos1"), "chr2", F.col("end2").alias("pos2"))
    breaks = view(spark, sf_dir, SEGMENTS).select("chr", F.col("start").alias("pos"))
    return segments.build_segments(calls, breaks, centtel(spark))


@query(f'WITH {BOUNDS} SELECT chr, start, "end", start_bkpt, end_bkpt, rank = 0 AND chr = 5 AS no_cn FROM g WHERE "end" IS NOT NULL')
def m09_build_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bounded(spark, sf_dir)


@query(f"""WITH {BOUNDS}, k AS (SELECT id || ':1' AS name, strand1 AS strand FROM c WHERE id % 5 <> 0 UNION ALL SELECT id || ':2', strand2 FROM c WHERE id % 5 <> 0)
 SELECT g.start_bkpt, g.end_bkpt, CASE WHEN l.name IS NOT NULL THEN 'rg' WHEN position(':' IN start_bkpt) > 0 THEN 'cn_bkpt' ELSE start_bkpt END AS low_boundary, CASE WHEN l.strand = '-' THEN start_bkpt END AS low_bkpt,
 CASE WHEN h.name IS NOT NULL THEN 'rg' WHEN position(':' IN end_bkpt) > 0 THEN 'cn_bkpt' ELSE end_bkpt END AS high_boundary, CASE WHEN h.strand = '+' THEN end_bkpt END AS high_bkpt
 FROM g LEFT JOIN k l ON l.name = start_bkpt LEFT JOIN k h ON h.name = end_bkpt WHERE "end" IS NOT NULL""")
def c19_attach_breakpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = view(spark, sf_dir, BEDPE).filter("id % 5 <> 0")
    return segments.attach_breakpoints(bounded(spark, sf_dir), known).select("start_bkpt", "end_bkpt", "low_boundary", "low_bkpt", "high_boundary", "high_bkpt")


NAMES = "SELECT ((((chr_l * 8 + chr_h) * 2 + CASE strand_l WHEN '+' THEN 1 ELSE 0 END) * 2 + CASE strand_h WHEN '+' THEN 1 ELSE 0 END) * 1024 + CAST(floor((pos_l - 1) / 5000) AS BIGINT)) * 1024 + CAST(floor((pos_h - 1) / 5000) AS BIGINT) AS id, qname, sample, mapq FROM {pairs}"


@query(f"""WITH c AS (SELECT id, chr1, chr2, strand1, strand2, (start1 + end1) // 2 AS p1, (start2 + end2) // 2 AS p2 FROM {C}), n AS ({NAMES.format(pairs=P)})
 SELECT DISTINCT c.id, a.qname, a.mate FROM c JOIN n ON n.id = c.id AND n.mapq >= 20 JOIN {A} a ON a.qname = n.qname AND a.chr = chr1 AND a.strand = strand1 AND a.mate_chr = chr2 AND a.mate_strand = strand2
 WHERE a.pos BETWEEN p1 - 1099 AND p1 + 1000 AND a.mate_pos BETWEEN p2 - 1099 AND p2 + 1000 AND NOT (chr1 = chr2 AND strand1 = strand2 AND (a.pos <> a.mate_pos) AND (p1 <= p2) <> (a.pos < a.mate_pos))""")
def c14_support_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = view(spark, sf_dir, BEDPE).withColumn("pos1", F.floor((F.col("start1") + F.col("end1")) / 2)).withColumn("pos2", F.floor((F.col("start2") + F.col("end2")) / 2))
    names = spark.sql(NAMES, pairs=view(spark, sf_dir, READ_PAIRS)).filter("mapq >= 20")
    return segments.collect_support_reads(calls, view(spark, sf_dir, ALIGNMENTS), names)


@query(f"""WITH r AS (SELECT n.*, mapq AS m FROM ({NAMES.format(pairs=P)}) n WHERE sample = 'T1'), s AS (SELECT id, 1 + mapq % 2 AS side, CASE WHEN m % 7 <> 0 THEN m * 5 % 90 END AS own, CASE WHEN m % 3 <> 0 THEN m * 7 % 60 ELSE 0 END AS there FROM r)
 SELECT id, side, count(*) AS n_reads, CASE WHEN count(*) >= 3 THEN max(own - there) END AS score FROM s GROUP BY ALL""")
def e12_remap_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = spark.sql(NAMES, pairs=view(spark, sf_dir, READ_PAIRS)).filter("sample = 'T1'").withColumn("read_id", F.col("qname"))
    m, both = F.col("mapq"), F.explode(F.array(F.lit(False), F.lit(True)))
    scores = reads.select("read_id", "mapq", both.alias("target")).filter((~F.col("target") & (m % 7 != 0)) | (F.col("target") & (m % 3 != 0)))
    scores = scores.select("read_id", "target", F.when(F.col("target"), m * 7 % 60).otherwise(m * 5 % 90).alias("score"))
    return segments.remap_scores(reads.select("id", (1 + m % 2).alias("side"), "read_id"), scores)


@query(f"""WITH c AS (SELECT *, chr1 || '/' || chr2 || strand1 || strand2 || start1 // 20000 AS spot, CASE WHEN chr1 <> chr2 THEN -1 ELSE start2 - start1 END AS far FROM {C}), n AS ({NAMES.format(pairs=P)}),
 t AS (SELECT id, count(DISTINCT qname) AS own FROM n WHERE sample = 'T1' GROUP BY id), m AS (SELECT spot, string_agg(DISTINCT n.qname, ',' ORDER BY n.qname) AS names, count(DISTINCT n.qname) AS together FROM c JOIN n USING (id) WHERE n.sample = 'T1' GROUP BY spot),
 g AS (SELECT spot, count(*) AS k, min(start1) AS start1, max(end1) AS end1, min(start2) AS start2, max(end2) AS end2, any_value(chr1) AS chr1, any_value(chr2) AS chr2, any_value(strand2) AS strand2, string_agg(id::VARCHAR, ',' ORDER BY id::VARCHAR) AS id,
 max(own) AS own, sum(normal_count)::BIGINT AS normal_count, sum(np_count)::BIGINT AS np_count, max_by(id % 13, (start1, end1, start2, end2, id::VARCHAR))::BIGINT AS occ_l, min(far) AS far, max(id % 31)::BIGINT AS lone FROM c JOIN t USING (id) GROUP BY spot)
 SELECT spot, start1, end1, start2, end2, chr1, strand2, id, names, CASE WHEN k = 1 THEN own ELSE together END::INTEGER AS tumour_count, normal_count, np_count, occ_l,
 CASE WHEN k = 1 THEN far WHEN chr1 <> chr2 THEN -1 ELSE start2 - start1 END AS bkpt_distance, CASE WHEN k = 1 THEN lone ELSE together + normal_count + np_count END AS count FROM g JOIN m USING (spot)""")
def b28_merge_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = spark.sql(NAMES, pairs=view(spark, sf_dir, READ_PAIRS)).filter("sample = 'T1'").groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("qname")), ",").alias("names"), F.count_distinct("qname").cast("int").alias("tumour_count"))
    spot = F.concat(*(F.col(x).cast("string") if x != "/" else F.lit("/") for x in ("chr1", "/", "chr2", "strand1", "strand2")), F.floor(F.col("start1") / 20000).cast("string"))
    calls = view(spark, sf_dir, BEDPE).drop("tumour_count").withColumn("spot", spot).join(names, "id").withColumn("occ_l", F.col("id") % 13).withColumn("count", F.col("id") % 31)
    calls = calls.withColumn("bkpt_distance", expr.breakpoint_distance(F.col("chr1"), F.col("chr2"), F.col("start1"), F.col("start2"))).withColumn("id", F.col("id").cast("string"))
    return segments.merge_calls(calls.select("spot", "start1", "end1", "start2", "end2", "chr1", "strand2", "id", "names", "tumour_count", "normal_count", "np_count", "occ_l", "bkpt_distance", "count"), "spot")


@query(f"""WITH {BOUNDS}, s AS (SELECT *, CASE WHEN start % 7 <> 2 THEN (start % 9)::DOUBLE END AS cn FROM g WHERE "end" IS NOT NULL),
 v AS (SELECT chr, (SELECT cn FROM s x WHERE x.chr = s.chr AND start_bkpt LIKE '%ptel') AS a, (SELECT cn FROM s x WHERE x.chr = s.chr AND end_bkpt LIKE '%qtel') AS b,
 arg_min(struct_pack(c := cn), (start, "end")) FILTER (end_bkpt = 'centromere') AS c, arg_max(struct_pack(c := cn), (start, "end")) FILTER (start_bkpt = 'centromere') AS d FROM s GROUP BY chr)
 SELECT chr, list_avg(list_filter([a, b, c.c, d.c], lambda x: x IS NOT NULL)) AS mean_cn FROM v""")
def g16_arm_cn(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = segments.attach_breakpoints(bounded(spark, sf_dir), view(spark, sf_dir, BEDPE))
    return results.arm_cn(rows.withColumn("cn", F.when(F.col("start") % 7 != 2, (F.col("start") % 9).cast("double"))))


@query(f"WITH {ENDS}, {DEPTH} SELECT chr, bin AS start, tumour FROM d")
def c03_merge_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = depths(spark, sf_dir).select("chr", F.col("bin").alias("start"), "tumour")
    return segments.merge_coverage(parts, spark.createDataFrame([(k, 9 - k) for k in range(1, 6)], "chr long, ref_idx int"))
