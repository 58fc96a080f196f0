"""Registered queries of read groups, filters after grouping, and results, and the SQL for their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import compare, results
from ..operators.calls import annotate
from ..operators.vcf import combine_vcf
from ..sources.shared import stored
from .queries import C, CALL, CALL_COLUMNS, P, S
from .read_queries import A, ALIGNMENTS
from .views import BEDPE, READ_PAIRS, SEGMENTS, view

QUERIES, SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


#: A table of five chromosomes' ends and centromeres; the last one's centromere starts at 0.
CENTTEL = [(k, 5000 * k, 400_000 + 1000 * k if k < 5 else 0, 420_000 + 1000 * k if k < 5 else 1000, 1_001_000 - 3000 * k) for k in range(1, 6)]
T = "(SELECT range AS chr, 5000 * range AS ptel, CASE WHEN range < 5 THEN 400000 + 1000 * range ELSE 0 END AS cen_start, CASE WHEN range < 5 THEN 420000 + 1000 * range ELSE 1000 END AS cen_end, 1001000 - 3000 * range AS qtel FROM range(1, 6))"


def centtel(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CENTTEL, "chr long, ptel long, cen_start long, cen_end long, qtel long")


def bad(chrom: str, pos: str) -> str:
    return f"EXISTS (SELECT 1 FROM {T} t WHERE t.chr = {chrom} AND ({pos} <= ptel OR ({pos} >= cen_start AND {pos} <= cen_end) OR {pos} >= qtel))"


@query("SELECT 'x_' || s_suppkey AS rg_id, 'NP_' || s_name AS sample, CAST(floor(170 + s_suppkey % 50 + 2 * ((s_suppkey % 40) / 4.0)) AS INTEGER) AS max_insert FROM supplier")
def a03_augment_read_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("rg_id"), F.col("s_name").alias("sample"))
    bas = rows.select("rg_id", (170 + F.col("rg_id") % 50).alias("mean_insert_size"), (F.col("rg_id") % 40 / 4).alias("insert_size_sd"))
    return results.augment_read_groups(rows, bas, "x_", panel=True)


@query(f"SELECT qname, mate FROM {A} WHERE chr < mate_chr OR (chr = mate_chr AND (pos < mate_pos OR (pos = mate_pos AND mate = 1)))")
def b09_lesser_mate(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return view(spark, sf_dir, ALIGNMENTS).filter(results.lesser_mate(c("chr"), c("pos"), c("mate_chr"), c("mate_pos"), c("mate") == 1)).select("qname", "mate")


@query(f"""WITH a AS (SELECT *, row_number() OVER (PARTITION BY qname, mate ORDER BY chr, pos, strand, mate_chr, mate_pos, mate_strand, sample, mapq) AS k FROM {A}), o AS (SELECT qname, mate, k, (mapq * 3) % 61 AS zm, CASE WHEN mapq % 4 <> 0 THEN pos % 5 END AS z1 FROM a)
 SELECT r.qname || '/' || r.k AS qname, r.mate, r.mapq, o.zm, o.z1 FROM a r JOIN o ON r.qname = o.qname AND r.mate = o.mate AND r.k = o.k""")
def b11_augment_original(spark: SparkSession, sf_dir: str) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy("qname", "mate").orderBy("chr", "pos", "strand", "mate_chr", "mate_pos", "mate_strand", "sample", "mapq"))
    # both sides are made from one table, whose rows are numbered once
    reads = stored(view(spark, sf_dir, ALIGNMENTS).select(F.concat_ws("/", "qname", nth.cast("string")).alias("qname"), "mate", "mapq", "pos"), "numbered")
    original = reads.withColumn("x1", F.when(F.col("mapq") % 4 != 0, F.col("pos") % 5)).withColumn("mapq", F.col("mapq") * 3 % 61)
    return results.augment_original(reads, original, pairwise=True).select("qname", "mate", "mapq", "zm", "z1")


SPOT = "chr_l, strand_l, chr_h, strand_h, CAST(floor(pos_l / 20000) AS BIGINT) AS spot"
KEY = ["chr_l", "strand_l", "chr_h", "strand_h", "spot"]


@query(f"""WITH p AS (SELECT {SPOT}, * EXCLUDE (chr_l, strand_l, chr_h, strand_h) FROM {P}), g AS (SELECT chr_l, strand_l, chr_h, strand_h, spot, min(pos_l) - 1 AS start1, max(pos_l) AS end1, min(pos_h) - 1 AS start2, max(pos_h) AS end2,
 count(*) AS score, count(DISTINCT sample) AS n_samples, min(sample) AS lead FROM p GROUP BY ALL)
 SELECT chr_l AS chr1, start1, end1, chr_h AS chr2, start2, end2, (SELECT min(qname) FROM p WHERE p.chr_l = g.chr_l AND p.strand_l = g.strand_l AND p.chr_h = g.chr_h AND p.strand_h = g.strand_h AND p.spot = g.spot AND p.sample = g.lead) AS name,
 score, strand_l AS strand1, strand_h AS strand2, n_samples FROM g""")
def b14_groups_to_bedpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = view(spark, sf_dir, READ_PAIRS).withColumn("spot", F.floor(F.col("pos_l") / 20000)).withColumn("group_id", F.concat_ws("/", *KEY))
    groups = pairs.groupBy("group_id", *KEY).agg(F.min("pos_l").alias("l5"), F.max("pos_l").alias("l3"), F.min("pos_h").alias("h5"), F.max("pos_h").alias("h3"))
    return results.groups_to_bedpe(groups, pairs.select("group_id", "sample", "qname"))


@query(f"SELECT count(*) AS total, count(*) FILTER (n < 6) AS small, count(*) FILTER (n >= 6) AS emitted FROM (SELECT {SPOT}, count(*) AS n FROM {P} GROUP BY ALL)")
def e02_support_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.support_counts(view(spark, sf_dir, READ_PAIRS).withColumn("spot", F.floor(F.col("pos_l") / 20000)), KEY, least=6)


@query(f"SELECT {CALL} FROM {C} WHERE id % 7 <> 0")
def b19_filter_foldback_artefacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = view(spark, sf_dir, BEDPE)
    classes = calls.filter("id % 3 <> 1 OR id % 7 = 0").select("id", (F.col("id") % 7 != 0).alias("keep"))
    return results.filter_foldback_artefacts(calls, classes).select(*CALL_COLUMNS)


@query(f"""WITH p AS (SELECT id, strand1, (id % 97) / 128.0::DOUBLE AS miss FROM {C} WHERE tumour_count >= 4), r AS (SELECT id, strand1, sum(miss) OVER w AS run, row_number() OVER w AS n, avg(0) OVER w AS z, miss FROM p WINDOW w AS (PARTITION BY strand1 ORDER BY miss, id ROWS UNBOUNDED PRECEDING)),
 k AS (SELECT *, avg(n) OVER (PARTITION BY strand1, miss) AS tied, min(CASE WHEN run > 5 THEN n END) OVER (PARTITION BY strand1) AS place FROM r) SELECT strand1, id, tied < coalesce(place, 1) AS keep FROM k""")
def w06_keep_by_expected_false(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = view(spark, sf_dir, BEDPE).filter("tumour_count >= 4")
    return results.keep_by_expected_false(calls.select("strand1", "id", (1 - F.col("id") % 97 / F.lit(128.0)).alias("p_true")), by="strand1")


def scores(calls: DataFrame) -> DataFrame:
    i = F.col("id")
    small = (F.col("chr1") == F.col("chr2")) & (F.col("strand1") == "+") & (F.col("strand2") == "-") & (F.col("start2") - F.col("end1") <= 1000)
    return calls.select(
        "id", F.when(i % 17 != 0, i * 53 % 400).alias("low_score"), F.when(i % 19 != 0, i * 59 % 400).alias("high_score"), F.when(i % 11 != 0, i * 37 % 300).alias("low_footprint"),
        F.when(i % 23 != 0, i * 31 % 300).alias("high_footprint"), (i % 13 == 0).alias("has_n"), small.alias("small_indel"), F.when(i % 5 != 0, i % 9).alias("microbes"),
    )


@query(f"""SELECT {CALL} FROM (SELECT *, chr1 = chr2 AND strand1 = '+' AND strand2 = '-' AND start2 - end1 <= 1000 AS indel FROM {C}) WHERE NOT (NOT indel AND (id % 17 = 0 OR id * 53 % 400 <= 80)) AND NOT (NOT indel AND (id % 19 = 0 OR id * 59 % 400 <= 80))
 AND NOT (id % 11 = 0 OR id % 23 = 0 OR id * 37 % 300 <= 50 OR id * 31 % 300 <= 50) AND (indel OR id % 13 <> 0) AND NOT (CASE WHEN id % 5 <> 0 THEN id % 9 ELSE 0 END >= tumour_count + normal_count)""")
def b20_filter_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = view(spark, sf_dir, BEDPE).withColumn("score", F.col("tumour_count") + F.col("normal_count"))
    return results.filter_remap(calls, scores(calls)).select(*CALL_COLUMNS)


@query(f"""WITH h AS (SELECT chr_l * 10 + chr_h AS id, qname AS read_id, u.organism, u.score FROM {P}, (SELECT unnest([1, 2]) AS k) x, LATERAL (SELECT 'org' || CAST((pos_l * k) % 5 AS VARCHAR) AS organism, (pos_h * (2 * k - 1)) % 161 AS score) u),
 b AS (SELECT id, read_id, organism FROM h WHERE score >= 80 QUALIFY row_number() OVER (PARTITION BY id, read_id ORDER BY score DESC, organism) = 1), n AS (SELECT id, organism, count(*) AS n FROM b GROUP BY ALL)
 SELECT id, string_agg(n::VARCHAR, ',' ORDER BY organism) AS microbe_counts, string_agg(organism, ',' ORDER BY organism) AS microbes FROM n GROUP BY id""")
def e13_microbe_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = view(spark, sf_dir, READ_PAIRS).withColumn("k", F.explode(F.array(F.lit(1), F.lit(2))))
    hits = pairs.select((F.col("chr_l") * 10 + F.col("chr_h")).alias("id"), F.col("qname").alias("read_id"), F.concat(F.lit("org"), (F.col("pos_l") * F.col("k") % 5).cast("string")).alias("organism"), (F.col("pos_h") * (2 * F.col("k") - 1) % 161).alias("score"))
    return results.microbe_counts(hits)


@query(f"SELECT {CALL} FROM {C} c WHERE chr1 <> 5 AND chr2 <> 5 AND NOT {bad('chr1', 'start1')} AND NOT {bad('chr2', 'start2')}")
def b21_drop_cen_tel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.drop_cen_tel(view(spark, sf_dir, BEDPE), centtel(spark), absent="5").select(*CALL_COLUMNS)


@query(f"""WITH s AS (SELECT chr, "start", "end", (seg_id % 8) / 4.0 AS cn, 5 + seg_id % 40 AS n_win, lag((seg_id % 8) / 4.0) OVER w AS before, lag(5 + seg_id % 40) OVER w AS n_before FROM {S} WINDOW w AS (PARTITION BY chr ORDER BY "start", "end", seg_id)),
 u AS (SELECT DISTINCT chr, "start" FROM s WHERE n_win >= 10 AND n_before >= 10 AND abs(cn - before) > 0.3), b AS (SELECT chr1 AS chr, start1 AS pos FROM {C} WHERE id % 977 = 0)
 SELECT chr, "start" FROM u WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.chr = u.chr AND abs(b.pos - u."start") <= 20000) AND NOT {bad('u.chr', 'u."start"')}""")
def m08_trusted_cn_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("seg_id")
    s = view(spark, sf_dir, SEGMENTS).select("chr", "start", "end", (i % 8 / 4).alias("cn"), (5 + i % 40).alias("n_win"))
    points = view(spark, sf_dir, BEDPE).filter("id % 977 = 0").select(F.col("chr1").alias("chr"), F.col("start1").alias("pos"))
    return results.trusted_cn_breaks(s, points, centtel(spark))


@query(f"""SELECT id, chr1, start1 + id % 50 - 1 AS start1, start1 + id % 50 AS end1, chr2, end2 - id % 60 - 1 AS start2, end2 - id % 60 AS end2, CASE WHEN id % 3 = 0 THEN 1 ELSE 0 END AS copynumber_flag FROM {C} WHERE id % 4 <> 1""")
def c15_collate_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = view(spark, sf_dir, BEDPE)
    remapped = calls.filter("id % 4 <> 1").select("id", (F.col("start1") + F.col("id") % 50).alias("bkpt_l"), (F.col("end2") - F.col("id") % 60).alias("bkpt_h"))
    return results.collate_calls(calls, remapped, calls.filter("id % 3 = 0")).select("id", "chr1", "start1", "end1", "chr2", "start2", "end2", "copynumber_flag")


@query(f"""SELECT id, CASE WHEN a THEN start1 + 7 ELSE start1 END AS start1, CASE WHEN a THEN start1 + 8 ELSE end1 END AS end1, CASE WHEN a THEN start2 + 7 ELSE start2 END AS start2, CASE WHEN a THEN start2 + 8 ELSE end2 END AS end2,
 CASE WHEN a THEN strand2 ELSE strand1 END AS strand1, CASE WHEN a THEN strand1 ELSE strand2 END AS strand2, CASE WHEN a THEN id % 101 END AS assembly_score, CASE WHEN a THEN 'L] ' || id || ' [H' END AS notation FROM (SELECT *, id % 5 = 2 AS a FROM {C})""")
def c16_combine_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, c = view(spark, sf_dir, BEDPE), F.col
    assembled = calls.filter("id % 5 = 2").select("id", (c("start1") + 7).alias("start1"), (c("start1") + 8).alias("end1"), (c("start2") + 7).alias("start2"), (c("start2") + 8).alias("end2"), c("strand2").alias("strand1"), c("strand1").alias("strand2"), (c("id") % 101).alias("score"), F.format_string("L] %s [H", c("id").cast("string")).alias("notation"))
    return results.combine_results(calls, assembled).select("id", "start1", "end1", "start2", "end2", "strand1", "strand2", "assembly_score", "notation")


@query(f"""WITH f AS (SELECT 1 + CAST(p_partkey AS BIGINT) % 5 AS chr, (CAST(p_partkey AS BIGINT) % 200) * 5000 + CAST(p_size AS BIGINT) AS fs, (CAST(p_partkey AS BIGINT) % 200) * 5000 + CAST(p_size AS BIGINT) * 301 AS fe, p_brand AS name FROM part),
 n AS (SELECT id, name, count(*) AS n FROM {C} JOIN f ON f.chr = chr1 WHERE chr1 = chr2 AND strand1 = '+' AND strand2 = '-' AND fs >= start1 + 1 AND fe <= end2 AND fe - fs >= end2 - (start1 + 1) - 4000 AND fs <= start1 + 4000 AND fe > start1 GROUP BY ALL)
 SELECT id, string_agg(name || '*' || n, ' ' ORDER BY name) AS notes FROM n GROUP BY id""")
def c07_annotate_spanning_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey").cast("long"), F.col("p_size").cast("long")
    named = spark.read.parquet(f"{sf_dir}/part.parquet").select((1 + key % 5).alias("chr"), (key % 200 * 5000 + size).alias("start"), (key % 200 * 5000 + size * 301).alias("end"), F.col("p_brand").alias("name"))
    return results.annotate_spanning_features(view(spark, sf_dir, BEDPE), named, max_insert=4000)


@query(f"""WITH c AS {C}, n AS (SELECT a.id, count(b.id) AS n FROM c a LEFT JOIN c b ON b.id % 2 = 0 AND a.chr1 = b.chr1 AND a.chr2 = b.chr2 AND a.strand1 = b.strand1 AND a.strand2 = b.strand2 AND a.start1 - 5000 <= b.end1 AND b.start1 <= a.end1 + 5000
 AND a.start2 - 5000 <= b.end2 AND b.start2 <= a.end2 + 5000 WHERE a.id % 2 = 1 GROUP BY a.id), t AS (SELECT CASE WHEN n = 0 THEN 'UNIQUE' WHEN n = 1 THEN 'COMMON' ELSE 'MULTI' END AS tag FROM n)
 SELECT coalesce(tag, 'TOTAL') AS tag, count(*) AS n FROM t GROUP BY ROLLUP (tag)""")
def e18_tag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = view(spark, sf_dir, BEDPE)
    return results.tag_counts(compare.compare_calls(every.filter("id % 2 = 0"), every.filter("id % 2 = 1"), slop=5000))


def rearranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments one after another on each chromosome, some of whose ends carry breakpoints."""
    i = F.col("seg_id")
    return view(spark, sf_dir, SEGMENTS).select("seg_id", "chr", "start", (F.col("start") + i % 700).alias("end"), F.when(i % 3 == 0, i % 10).alias("low_rg"), F.when(i % 2 == 0, i % 7).alias("high_rg"), F.when(i % 5 != 0, i % 9).alias("cn"))


RS = f"""(SELECT seg_id, chr, "start", "start" + seg_id % 700 AS "end", CASE WHEN seg_id % 3 = 0 THEN seg_id % 10 END AS low_rg, CASE WHEN seg_id % 2 = 0 THEN seg_id % 7 END AS high_rg, CASE WHEN seg_id % 5 <> 0 THEN seg_id % 9 END AS cn FROM {S})"""


@query(f"""WITH r AS (SELECT *, "end" - "start" + 1 AS len, lag(high_rg) OVER w AS before, lead(low_rg) OVER w AS after FROM {RS} WINDOW w AS (PARTITION BY chr ORDER BY "start", "end", seg_id))
 SELECT seg_id, CASE WHEN len <= 300 AND low_rg <> high_rg THEN 'shard' WHEN low_rg IS NULL AND high_rg IS NULL AND len <= 500 AND before <> after THEN 'gap' END AS kind FROM r""")
def g03_segment_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.segment_shards(rearranged(spark, sf_dir), most=300)


def vcf_rows(calls: DataFrame) -> DataFrame:
    """Two records a call: INFO with or without a distance, read counts of both samples."""
    i, far = F.col("id"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("BKDIST="), (F.col("id") % 1000).cast("string"), F.lit(";"))).otherwise(F.lit(""))
    ends = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col(f"chr{k}").alias("chrom"), (F.col(f"start{k}") + 1).alias("pos")) for k in (1, 2))))
    rows = calls.select("id", "tumour_count", "normal_count", far.alias("far"), ends.alias("e"))
    info = F.concat(F.lit("SVTYPE=BND;"), "far", F.when(i % 2 == 0, F.concat(F.lit("TSRDS=r"), i.cast("string"), F.lit(","), "e.k")).otherwise(F.lit("IMPRECISE")))
    name = F.concat_ws("_", i.cast("string"), F.col("e.k").cast("string"))
    return rows.select(F.col("e.chrom").alias("chrom"), F.col("e.pos").alias("pos"), name.alias("id"), F.lit("N").alias("ref"), F.lit("<BND>").alias("alt"), F.lit("100").alias("qual"), F.lit(".").alias("filter"), info.alias("info"), F.lit("RC").alias("format"), F.col("normal_count").cast("string").alias("normal"), F.col("tumour_count").cast("string").alias("tumour"))


@query(f"""WITH c AS {C}, r AS (SELECT id AS call, id || '_' || k AS id, CASE k WHEN 1 THEN chr1 ELSE chr2 END AS chrom, CASE k WHEN 1 THEN start1 ELSE start2 END + 1 AS pos, normal_count, tumour_count, k, id % 5 = 2 AS a,
 'SVTYPE=BND;' || CASE WHEN id % 3 = 0 THEN 'BKDIST=' || (id % 1000) || ';' ELSE '' END || CASE WHEN id % 2 = 0 THEN 'TSRDS=r' || id || ',' || k ELSE 'IMPRECISE' END AS info,
 CASE WHEN chr1 <> chr2 THEN 'translocation' WHEN strand1 = strand2 THEN 'inversion' WHEN strand1 = '+' THEN 'deletion' ELSE 'tandem-duplication' END AS svclass, CASE WHEN chr1 <> chr2 THEN -1 ELSE abs(start2 - end1) END AS far FROM c, (SELECT unnest([1, 2]) AS k)),
 n AS (SELECT *, CASE WHEN a THEN 'ASSEMBLED=1;' || CASE WHEN call % 2 = 0 THEN 'TSRDS=r' || call || ',' || k || ';' ELSE '' END || 'BAS=' || (call % 101) ELSE info END AS i FROM r)
 SELECT chrom, pos + CASE WHEN a THEN 7 ELSE 0 END AS pos, id, CASE WHEN a THEN 'A' ELSE 'N' END AS ref, CASE WHEN a THEN 'A[' || call || '[' ELSE '<BND>' END AS alt, CASE WHEN a THEN '.' ELSE '100' END AS qual, '.' AS filter,
 replace(regexp_replace(i, 'BKDIST=[0-9]+', '') || ';BKDIST=' || far || ';SVCLASS=' || svclass, ';;', ';') AS info, 'RC:PS' AS format, '0:' || normal_count AS normal, CASE WHEN a THEN (call % 9)::VARCHAR ELSE '0' END || ':' || tumour_count AS tumour FROM n""")
def c17_combine_vcf(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = view(spark, sf_dir, BEDPE)
    call = F.substring_index("id", "_", 1)
    some = vcf_rows(every.filter("id % 5 = 2"))
    assembled = some.withColumns({"pos": F.col("pos") + 7, "ref": F.lit("A"), "alt": F.concat(F.lit("A["), call, F.lit("[")), "qual": (call.cast("long") % 101).cast("string"), "info": F.lit("ASSEMBLED=1"), "tumour": (call.cast("long") % 9).cast("string")})
    classes = annotate(every).select("id", F.col("bkdist").alias("bkptdist"), "svclass")
    return combine_vcf(vcf_rows(every), assembled, classes)
