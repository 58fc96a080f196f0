"""Registered queries of the structural-variant operators, and the SQL for their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr
from ..operators import calls, coverage, grouping
from ..operators.interval import interval_islands
from .views import BEDPE, PANEL, READ_PAIRS, REF_LEN, SEGMENTS, duck, view

QUERIES, SQL = {}, {}
P, C, S = (f"({duck(x)})" for x in (READ_PAIRS, BEDPE, SEGMENTS))
CALL = "id, chr1, start1, end1, chr2, start2, end2, strand1, strand2, tumour_count"
CALL_COLUMNS = CALL.split(", ")


def query(name: str, text: str, sql: str | None = None):
    """Register a query over one view."""

    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(view(spark, sf_dir, text))
        if sql:
            SQL[name] = sql
        return f

    return add


@query("b01_flag_filter", READ_PAIRS, f"SELECT qname, flag::INTEGER AS flag, mapq FROM {P} WHERE flag & 2 = 0 AND flag & 1 = 1 AND mapq >= 6")
def flag_filter(df: DataFrame) -> DataFrame:
    return df.filter(expr.flags_fit(F.col("flag"), expr.PAIRED, expr.PROPER) & (F.col("mapq") >= 6)).select("qname", "flag", "mapq")


REASON = """CASE WHEN flag & 2 > 0 THEN 'proper' WHEN mapq < 1 THEN 'mapq' WHEN abs(pos_l - pos_h) < 10 THEN 'near_mate'
 WHEN chr_l = chr_h AND strand_l = '+' AND strand_h = '-' AND pos_h + read_len - pos_l <= max_insert THEN 'insertion' END"""


@query("b08_filter_discordant", READ_PAIRS, f"SELECT qname, chr_l, pos_l, strand_l, chr_h, pos_h, strand_h FROM {P} WHERE ({REASON}) IS NULL")
def filter_discordant(df: DataFrame) -> DataFrame:
    return grouping.filter_discordant(df).select("qname", "chr_l", "pos_l", "strand_l", "chr_h", "pos_h", "strand_h")


@query("e03_grouping_metrics", READ_PAIRS, f"SELECT coalesce({REASON}, 'kept') AS reason, count(*) AS n_pairs FROM {P} GROUP BY 1")
def grouping_metrics(df: DataFrame) -> DataFrame:
    return grouping.grouping_metrics(df)


END = "CASE WHEN strand_{e} = '+' THEN pos_{e} ELSE greatest(pos_{e} + read_len - max_insert, 1) END AS {e}5, least(CASE WHEN strand_{e} = '+' THEN pos_{e} + max_insert ELSE pos_{e} + read_len END, 1001000) AS {e}3"
WINDOWS = f"(SELECT *, {END.format(e='l')}, {END.format(e='h')} FROM {P} WHERE ({REASON}) IS NULL)"


@query("b12_end_windows", READ_PAIRS, f"SELECT qname, l5, l3, h5, h3 FROM {WINDOWS}")
def end_windows(df: DataFrame) -> DataFrame:
    return grouping.with_windows(grouping.filter_discordant(df), REF_LEN).select("qname", "l5", "l3", "h5", "h3")


@query("b13_sanitise_sample", READ_PAIRS, f"SELECT qname, regexp_replace(qname, '[^a-zA-Z0-9_\\-.]', '_', 'g') AS clean FROM {P}")
def sanitise(df: DataFrame) -> DataFrame:
    return df.select("qname", expr.sanitise_sample(F.col("qname")).alias("clean"))


ISLANDS = f"""
WITH r AS (SELECT *, max(l3) OVER (PARTITION BY chr_l, strand_l, chr_h ORDER BY pos_l, flag, qname ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {WINDOWS})
SELECT qname, sum(CASE WHEN reach IS NULL OR l5 >= reach THEN 1 ELSE 0 END) OVER (PARTITION BY chr_l, strand_l, chr_h ORDER BY pos_l, flag, qname ROWS UNBOUNDED PRECEDING)::BIGINT AS island FROM r
"""


@query("e01_island_ids", READ_PAIRS, ISLANDS)
def island_ids(df: DataFrame) -> DataFrame:
    return grouping.islands(grouping.with_windows(grouping.filter_discordant(df), REF_LEN)).select("qname", "island")


KEYS = "chr_l, strand_l, chr_h, island"
BOUNDS = {"l5": "greatest", "l3": "least", "h5": "greatest", "h3": "least"}
MEETS = "(g.s = r.strand_h AND g.l5 <= r.l3 AND r.l5 <= g.l3 AND g.h5 <= r.h3 AND r.h5 <= g.h3)"
#: The sweep as a recursion: step n takes the n-th pair of every island and carries the groups that are open there.
GROUPS = f"""
w AS (SELECT *, {END.format(e='l')}, {END.format(e='h')} FROM {P} WHERE ({REASON.replace('mapq < 1', 'mapq < 6')}) IS NULL),
i AS (SELECT *, max(l3) OVER (PARTITION BY chr_l, strand_l, chr_h ORDER BY pos_l, flag, qname ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM w),
n AS (SELECT *, sum(CASE WHEN reach IS NULL OR l5 >= reach THEN 1 ELSE 0 END) OVER (PARTITION BY chr_l, strand_l, chr_h ORDER BY pos_l, flag, qname ROWS UNBOUNDED PRECEDING)::BIGINT AS island FROM i),
rows_ AS (SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY pos_l, flag, qname, strand_h, l5, l3, h5, h3, sample) AS step FROM n),
swept AS (SELECT DISTINCT {KEYS}, 0::BIGINT AS step, []::STRUCT(n BIGINT, s VARCHAR, l5 BIGINT, l3 BIGINT, h5 BIGINT, h3 BIGINT)[] AS open, 0::BIGINT AS opened, []::BIGINT[] AS joined FROM rows_
 UNION ALL SELECT chr_l, strand_l, chr_h, island, step, CASE WHEN len(hit) = 0 THEN list_append(live, struct_pack(n := opened, s := strand_h, l5 := l5, l3 := l3, h5 := h5, h3 := h3)) ELSE moved END, opened + CASE WHEN len(hit) = 0 THEN 1 ELSE 0 END, CASE WHEN len(hit) = 0 THEN [opened] ELSE list_transform(hit, lambda g: g.n) END
 FROM (SELECT r.*, opened, list_filter(open, lambda g: g.l3 > r.l5) AS live, list_filter(open, lambda g: g.l3 > r.l5 AND {MEETS}) AS hit,
 list_transform(list_filter(open, lambda g: g.l3 > r.l5), lambda g: CASE WHEN {MEETS} THEN struct_pack(n := g.n, s := g.s, {', '.join(f'{b} := {f}(g.{b}, r.{b})' for b, f in BOUNDS.items())}) ELSE g END) AS moved
 FROM swept t JOIN rows_ r USING (chr_l, strand_l, chr_h, island) WHERE r.step = t.step + 1)),
members AS (SELECT {', '.join('t.' + k for k in KEYS.split(', '))}, t.step, j AS opened, list_filter(t.open, lambda g: g.n = j)[1] AS g, r.qname, r.sample FROM (SELECT *, unnest(joined) AS j FROM swept) t JOIN rows_ r USING (chr_l, strand_l, chr_h, island, step)),
sizes AS (SELECT {KEYS}, opened, max(step) AS last, arg_max(g, step) AS g, count(*) AS total, {', '.join(f"count(DISTINCT CASE WHEN sample {s} THEN {c} END) AS {n}" for s, c, n in (("= 'T1'", "qname", "tumour_count"), ("= 'N1'", "qname", "normal_count"), ("LIKE 'NP%'", "qname", "np_count"), ("LIKE 'NP%'", "sample", "np_sample_count")))} FROM members GROUP BY ALL),
closed AS (SELECT *, coalesce((SELECT min(r.step) FROM rows_ r WHERE r.chr_l = s.chr_l AND r.strand_l = s.strand_l AND r.chr_h = s.chr_h AND r.island = s.island AND r.step > s.last AND r.l5 >= s.g.l3), 1000000000000) AS ends FROM sizes s),
numbered AS (SELECT *, island // {grouping.ISLANDS} AS pack, row_number() OVER (PARTITION BY chr_l, strand_l, chr_h, island // {grouping.ISLANDS} ORDER BY island, ends, opened) - 1 AS number FROM closed),
grouped AS (SELECT chr_l, strand_l, chr_h, g.s AS strand_h, pack AS island, number::INTEGER AS number, g.l5 AS l5, g.l3 AS l3, g.h5 AS h5, g.h3 AS h3, tumour_count, normal_count, np_count, np_sample_count, total FROM numbered WHERE total >= 2)"""


@query("e01_group_pairs", READ_PAIRS, f"WITH RECURSIVE {GROUPS} SELECT * FROM grouped")
def group_pairs(df: DataFrame) -> DataFrame:
    return grouping.group_pairs(grouping.filter_discordant(df, min_mapq=6), REF_LEN, "T1", "N1")


@query("e04_sample_counts", READ_PAIRS, f"""SELECT chr_l, chr_h, strand_l, strand_h, count(DISTINCT CASE WHEN sample = 'T1' THEN qname END) AS tumour_count, count(DISTINCT CASE WHEN sample = 'N1' THEN qname END) AS normal_count,
 count(DISTINCT CASE WHEN sample LIKE 'NP%' THEN qname END) AS np_count, count(DISTINCT CASE WHEN sample LIKE 'NP%' THEN sample END) AS np_sample_count, count(*) AS total FROM {P} GROUP BY 1, 2, 3, 4""")
def sample_counts(df: DataFrame) -> DataFrame:
    return grouping.sample_counts(df, ["chr_l", "chr_h", "strand_l", "strand_h"], "T1", "N1")


FAIL = """CASE WHEN chr1 = chr2 AND start1 = start2 AND end1 = end2 THEN 'identical' WHEN tumour_count < 4 THEN 'tumour' WHEN normal_count > 0 THEN 'normal'
 WHEN np_count > x THEN 'panel' WHEN np_sample_count > 0 THEN 'panel_samples' WHEN chr1 = chr2 AND start1 > start2 THEN 'order' WHEN chr1 = chr2 AND (start2 + 1) - (start1 + 1) <= 100 THEN 'distance' END"""
EXTRA = f"(SELECT *, CASE WHEN chr1 = chr2 AND strand1 = strand2 AND (start2 + 1 + end2) / 2 - (start1 + 1 + end1) / 2 <= 5000 THEN 2 ELSE 0 END AS x FROM {C})"


SOMATIC = "chr_l AS chr1, l5 - 1 AS start1, l3 AS end1, chr_h AS chr2, h5 - 1 AS start2, h3 AS end2, strand_l AS strand1, strand_h AS strand2, tumour_count, normal_count, np_count, np_sample_count"


@query("e01_somatic_groups", READ_PAIRS, f"""WITH RECURSIVE {GROUPS}, c AS (SELECT {SOMATIC} FROM grouped), e AS (SELECT *, CASE WHEN chr1 = chr2 AND strand1 = strand2 AND (start2 + 1 + end2) / 2 - (start1 + 1 + end1) / 2 <= 5000 THEN 2 ELSE 0 END AS x FROM c)
 SELECT * EXCLUDE (x) FROM e WHERE ({FAIL}) IS NULL""")
def somatic_groups(df: DataFrame) -> DataFrame:
    """Reads to groups to the somatic filter: groups of four or more tumour pairs and no normal or panel pair."""
    g = group_pairs(df)
    rows = g.select(F.col("chr_l").alias("chr1"), (F.col("l5") - 1).alias("start1"), F.col("l3").alias("end1"), F.col("chr_h").alias("chr2"), (F.col("h5") - 1).alias("start2"), F.col("h3").alias("end2"), F.col("strand_l").alias("strand1"), F.col("strand_h").alias("strand2"), "tumour_count", "normal_count", "np_count", "np_sample_count")
    return calls.filter_marked_groups(rows)


@query("b16_fail_reason", BEDPE, f"SELECT id, {FAIL} AS fail_reason FROM {EXTRA}")
def fail_reason(df: DataFrame) -> DataFrame:
    return calls.fail_reason(df).select("id", "fail_reason")


@query("b16_filter_marked_groups", BEDPE, f"SELECT {CALL} FROM {EXTRA} WHERE ({FAIL}) IS NULL")
def filter_marked_groups(df: DataFrame) -> DataFrame:
    return calls.filter_marked_groups(df).select(*CALL_COLUMNS)


@query("b22_annotate_calls", BEDPE, f"""SELECT id, CASE WHEN chr1 <> chr2 THEN 'translocation' WHEN strand1 = strand2 THEN 'inversion' WHEN strand1 = '+' THEN 'deletion' ELSE 'tandem-duplication' END AS svclass,
 CASE WHEN chr1 <> chr2 THEN -1 ELSE (start2 + 1) - (start1 + 1) END AS bkpt_distance, CASE WHEN chr1 <> chr2 THEN -1 ELSE abs(start2 - end1) END AS bkdist,
 chr1 = chr2 AND strand1 = '+' AND strand2 = '-' AND start2 - end1 <= 1000 AS small_indel FROM {C}""")
def annotate_calls(df: DataFrame) -> DataFrame:
    return calls.annotate(df)


@query("e05_filter_recurrent_ends", BEDPE, f"""WITH c AS {C}, e AS (SELECT chr1 AS c, start1 AS s, end1 AS e, strand1 AS d FROM c UNION ALL SELECT chr2, start2, end2, strand2 FROM c),
 o AS (SELECT c, s, e, d FROM e GROUP BY ALL HAVING count(*) > 3)
 SELECT {CALL} FROM c WHERE (chr1, start1, end1, strand1) NOT IN (SELECT (c, s, e, d) FROM o) AND (chr2, start2, end2, strand2) NOT IN (SELECT (c, s, e, d) FROM o)""")
def filter_recurrent_ends(df: DataFrame) -> DataFrame:
    return calls.filter_recurrent_ends(df, 3).select(*CALL_COLUMNS)


SELF = f"WITH c AS {C}, j AS (SELECT a.id AS id, b.id AS other FROM c a JOIN c b ON"


@query("c08_flag_balanced", BEDPE, f"""{SELF} a.chr1 = b.chr1 AND a.chr2 = b.chr2 AND a.chr1 <> a.chr2 AND a.id <> b.id AND a.strand1 <> b.strand1 AND a.strand2 <> b.strand2
 AND b.start1 > a.start1 - 100000 AND b.end1 < a.end1 + 100000 AND b.start2 > a.start2 - 100000 AND b.end2 < a.end2 + 100000) SELECT id, string_agg(other::VARCHAR, ',' ORDER BY other::VARCHAR) AS bal_trans FROM j GROUP BY id""")
def flag_balanced(df: DataFrame) -> DataFrame:
    return calls.flag_balanced(df)


@query("c09_flag_inversions", BEDPE, f"""{SELF} a.chr1 = a.chr2 AND b.chr1 = b.chr2 AND a.chr1 = b.chr1 AND a.strand1 = a.strand2 AND b.strand1 = b.strand2 AND a.strand1 <> b.strand1
 AND ((abs(a.start1 - b.start1) < 1000 AND abs(a.start2 - b.start2) < 1000) OR (abs(a.start1 - b.start2) < 1000 AND abs(a.start2 - b.start1) < 1000)))
 SELECT id, string_agg(DISTINCT other::VARCHAR, ',' ORDER BY other::VARCHAR) AS inv FROM j GROUP BY id""")
def flag_inversions(df: DataFrame) -> DataFrame:
    return calls.flag_inversions(df)


@query("c10_flag_occurrences", BEDPE, f"""WITH c AS {C}, e AS (SELECT chr1 AS k, start1 AS s, end1 AS e FROM c UNION SELECT chr2, start2, end2 FROM c),
 n AS (SELECT a.k, a.s, a.e, count(*) AS n FROM e a JOIN e b ON a.k = b.k AND a.s < b.e + 500 AND a.e > b.s - 500 GROUP BY ALL)
 SELECT id, l.n AS occ_l, h.n AS occ_h FROM c JOIN n l ON chr1 = l.k AND start1 = l.s AND end1 = l.e JOIN n h ON chr2 = h.k AND start2 = h.s AND end2 = h.e""")
def flag_occurrences(df: DataFrame) -> DataFrame:
    return calls.flag_occurrences(df)


def near_point(position: str, chrom: str) -> str:
    return " || ".join(f"CASE WHEN EXISTS (SELECT 1 FROM p WHERE source = '{s}' AND chr = {chrom} AND abs(pt - {position}) < 200) THEN '{s}' ELSE '' END" for s in "ANB")


@query("c12_merge_double_calls", BEDPE, f"""WITH c AS {C}, j AS (SELECT a.id AS id, (a.tumour_count < b.tumour_count OR (a.tumour_count = b.tumour_count AND a.id::VARCHAR > b.id::VARCHAR)) AS l, b.start1 AS s1, b.end1 AS e1, b.start2 AS s2, b.end2 AS e2
 FROM c a JOIN c b ON a.id <> b.id AND a.chr1 = b.chr1 AND a.chr2 = b.chr2 AND a.strand1 = b.strand1 AND a.strand2 = b.strand2 AND a.start1 - 3000 < b.end1 AND b.start1 < a.end1 + 3000 AND a.start2 - 3000 < b.end2 AND b.start2 < a.end2 + 3000),
 k AS (SELECT id, bool_or(l) AS l, min(s1) AS s1, max(e1) AS e1, min(s2) AS s2, max(e2) AS e2 FROM j GROUP BY id)
 SELECT id, chr1, least(start1, s1) AS start1, greatest(end1, e1) AS end1, chr2, least(start2, s2) AS start2, greatest(end2, e2) AS end2, strand1, strand2, tumour_count FROM c LEFT JOIN k USING (id) WHERE NOT coalesce(l, false)""")
def merge_double_calls(df: DataFrame) -> DataFrame:
    return calls.merge_double_calls(df, slop=3000).select(*CALL_COLUMNS)


SIZES = f"""h AS (SELECT range AS size, coalesce(n, 0) AS n FROM range(3001) LEFT JOIN (SELECT pos_h - pos_l AS size, count(*) AS n FROM {P} WHERE chr_l = 5 AND chr_h = 5 AND pos_h - pos_l BETWEEN 0 AND 3000 GROUP BY 1) ON range = size)"""
Q99 = "q AS (SELECT min(size) AS quantile FROM (SELECT size, sum(n) OVER (ORDER BY size) AS cum, sum(n) OVER () AS al FROM h) WHERE cum >= 0.99 * al)"


@query("e06_insert_size_histogram", READ_PAIRS, f"WITH {SIZES} SELECT size, n FROM h")
def insert_sizes(df: DataFrame) -> DataFrame:
    return coverage.insert_size_histogram(df)


@query("e07_quantile_from_freq", READ_PAIRS, f"WITH {SIZES}, {Q99} SELECT quantile FROM q")
def quantile(df: DataFrame) -> DataFrame:
    return calls.quantile_from_freq(coverage.insert_size_histogram(df), 0.99)


@query("w02_link_segments", SEGMENTS, f"""SELECT seg_id, lag(seg_id) OVER w AS prev_id, lead(seg_id) OVER w AS next_id FROM {S} WINDOW w AS (PARTITION BY chr ORDER BY "start", "end", seg_id)""")
def link_segments(df: DataFrame) -> DataFrame:
    return coverage.link_segments(df).select("seg_id", "prev_id", "next_id")


@query("w04_interval_islands", SEGMENTS, f"""WITH r AS (SELECT *, max("end") OVER (PARTITION BY chr ORDER BY "start", seg_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {S})
 SELECT seg_id, sum(CASE WHEN reach IS NULL OR "start" >= reach THEN 1 ELSE 0 END) OVER (PARTITION BY chr ORDER BY "start", seg_id ROWS UNBOUNDED PRECEDING)::BIGINT AS island FROM r""")
def segment_islands(df: DataFrame) -> DataFrame:
    return interval_islands(df, ["chr"], "start", "end", ["start", "seg_id"]).select("seg_id", "island")


def c06_join_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.join_panel(view(spark, sf_dir, BEDPE), view(spark, sf_dir, PANEL)).select("id", "panel_samples", "panel_reads")


SQL["c06_join_panel"] = f"""WITH c AS {C}, p AS ({duck(PANEL)}), j AS (SELECT c.id, n_samples, n_reads, row_number() OVER (PARTITION BY c.id ORDER BY n_samples DESC, n_reads DESC, p.start1, p.end1, p.start2, p.end2) AS r
 FROM c JOIN p ON c.chr1 = p.chr1 AND c.chr2 = p.chr2 AND c.strand1 = p.strand1 AND c.strand2 = p.strand2 AND c.start1 <= p.end1 AND p.start1 <= c.end1 AND c.start2 <= p.end2 AND p.start2 <= c.end2)
 SELECT c.id, coalesce(n_samples, 0) AS panel_samples, coalesce(n_reads, 0) AS panel_reads FROM c LEFT JOIN (SELECT * FROM j WHERE r = 1) j ON c.id = j.id"""


def c11_flag_cn_changepoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calls.flag_cn_changepoints(view(spark, sf_dir, BEDPE), view(spark, sf_dir, SEGMENTS), 200)


SQL["c11_flag_cn_changepoints"] = f"""WITH c AS {C}, p AS (SELECT DISTINCT source, chr, unnest(["start", "end"]) AS pt FROM {S}),
 f AS (SELECT id, {near_point('start1', 'chr1')} AS l, {near_point('end2', 'chr2')} AS h FROM c) SELECT id, CASE WHEN l <> '' AND h <> '' THEN l || '_' || h ELSE '_' END AS copynumber_flag FROM f"""


def b18_filter_small_deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calls.filter_small_deletions(view(spark, sf_dir, BEDPE), coverage.insert_size_histogram(view(spark, sf_dir, READ_PAIRS))).select(*CALL_COLUMNS)


SQL["b18_filter_small_deletions"] = f"WITH {SIZES}, {Q99}, c AS {C} SELECT {CALL} FROM c, q WHERE NOT coalesce(chr1 = chr2 AND strand1 = '+' AND strand2 = '-' AND start2 - end1 <= quantile, false)"


def depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = view(spark, sf_dir, READ_PAIRS)
    ends = pairs.select("sample", F.explode(F.array(*(F.struct(F.col(f"chr_{e}").alias("chr"), (F.col(f"pos_{e}") - 1).alias("start"), (F.col(f"pos_{e}") - 1 + F.col("read_len")).alias("end")) for e in "lh"))).alias("r")).select("sample", "r.*")
    windows = spark.range(5 * 2002).select((F.floor(F.col("id") / 2002) + 1).alias("chr"), (F.col("id") % 2002).alias("bin"))
    tumour = coverage.coverage(windows, ends.filter("sample = 'T1'"), out="tumour")
    return coverage.coverage(tumour, ends.filter("sample = 'N1'"), out="normal")


ENDS = f"e AS (SELECT sample, chr_l AS chr, pos_l - 1 AS s, pos_l + 99 AS t FROM {P} UNION ALL SELECT sample, chr_h, pos_h - 1, pos_h + 99 FROM {P}), w AS (SELECT chr, bin FROM (SELECT range + 1 AS chr FROM range(5)), (SELECT range AS bin FROM range(2002)))"
DEPTH = "d AS (SELECT w.chr, w.bin, count(*) FILTER (sample = 'T1') AS tumour, count(*) FILTER (sample = 'N1') AS normal FROM w LEFT JOIN e ON e.chr = w.chr AND s < (bin + 1) * 500 AND t > bin * 500 GROUP BY 1, 2)"
SQL["c01_coverage"] = f"WITH {ENDS}, {DEPTH} SELECT * FROM d"
SQL["m01_log_ratios"] = f"""WITH {ENDS}, {DEPTH}, r AS (SELECT *, log2((tumour * (sum(normal) OVER ()) / (sum(tumour) OVER ())::DOUBLE + 0.1) / (normal + 0.1)) AS lr FROM d),
 m AS (SELECT *, lr - (SELECT median(lr) FROM r) AS c FROM r) SELECT chr, bin, round(c, 6) AS logratio, round((pow(2, 1 + c) - 0.5) / 0.75, 6) AS abs_cn FROM m"""


def m01_log_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.log_ratios(depths(spark, sf_dir)).select("chr", "bin", F.round("logratio", 6).alias("logratio"), F.round("abs_cn", 6).alias("abs_cn"))


QUERIES |= {"c06_join_panel": c06_join_panel, "c11_flag_cn_changepoints": c11_flag_cn_changepoints, "b18_filter_small_deletions": b18_filter_small_deletions, "c01_coverage": depths, "m01_log_ratios": m01_log_ratios}
