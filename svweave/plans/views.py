"""Input views derived from the driver's tables; the SQL text runs unchanged in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REF_LEN = 1_001_000

READ_PAIRS = """
WITH b AS (
 SELECT CAST(l_orderkey AS BIGINT) ok, CAST(l_linenumber AS BIGINT) ln, CAST(l_partkey AS BIGINT) pk,
        CAST(l_suppkey AS BIGINT) sk, CAST(l_quantity AS BIGINT) q, l_returnflag rf FROM {lineitem}),
c AS (SELECT *, 1 + sk % 5 ca, 1 + (pk % 200) * 5000 + (ok % 97) * 3 + q pa,
        CASE WHEN pk % 3 = 0 THEN 1 + (sk + 1) % 5 ELSE 1 + sk % 5 END cb,
        1 + ((pk * 7 + 3) % 200) * 5000 + (ok % 89) * 3 + q pb,
        CASE WHEN ln % 2 = 0 THEN '+' ELSE '-' END sa, CASE WHEN rf = 'R' THEN '+' ELSE '-' END sb FROM b),
d AS (SELECT *, (ca < cb OR (ca = cb AND pa <= pb)) lo FROM c)
SELECT concat('L', CAST(ok AS STRING), ':', CAST(ln AS STRING)) qname,
  CASE WHEN pk % 4 <> 0 OR ok % 10 < 6 THEN 'T1' WHEN ok % 10 < 8 THEN 'N1' ELSE concat('NP_', CAST(sk % 7 AS STRING)) END sample,
  CASE WHEN lo THEN ca ELSE cb END chr_l, CASE WHEN lo THEN pa ELSE pb END pos_l, CASE WHEN lo THEN sa ELSE sb END strand_l,
  CASE WHEN lo THEN cb ELSE ca END chr_h, CASE WHEN lo THEN pb ELSE pa END pos_h, CASE WHEN lo THEN sb ELSE sa END strand_h,
  ok % 61 mapq, CASE WHEN ok % 11 = 0 THEN 3 ELSE 1 END flag, CAST(CASE WHEN ln % 2 = 0 THEN 345 ELSE 420 END AS BIGINT) max_insert, CAST(100 AS BIGINT) read_len
FROM d
"""

GROUPED = """
 FROM s GROUP BY chr_l, chr_h, strand_l, strand_h, bl, bh
"""

BEDPE = f"""
WITH rp AS ({READ_PAIRS}), s AS (SELECT *, floor((pos_l-1)/5000) bl, floor((pos_h-1)/5000) bh FROM rp WHERE mapq >= 6 AND flag % 4 < 2),
g AS (SELECT chr_l chr1, min(pos_l) - 1 start1, max(pos_l) end1, chr_h chr2, min(pos_h) - 1 start2, max(pos_h) end2, strand_l strand1, strand_h strand2, bl, bh,
 count(DISTINCT CASE WHEN sample = 'T1' THEN qname END) tumour_count, count(DISTINCT CASE WHEN sample = 'N1' THEN qname END) normal_count,
 count(DISTINCT CASE WHEN sample LIKE 'NP%' THEN qname END) np_count, count(DISTINCT CASE WHEN sample LIKE 'NP%' THEN sample END) np_sample_count {GROUPED})
SELECT ((((chr1 * 8 + chr2) * 2 + CASE strand1 WHEN '+' THEN 1 ELSE 0 END) * 2 + CASE strand2 WHEN '+' THEN 1 ELSE 0 END) * 1024 + CAST(bl AS BIGINT)) * 1024 + CAST(bh AS BIGINT) id,
 chr1, start1, end1, chr2, start2, end2, strand1, strand2, tumour_count, normal_count, np_count, np_sample_count FROM g
"""

PANEL = f"""
WITH rp AS ({READ_PAIRS}), s AS (SELECT *, floor((pos_l-1)/5000) bl, floor((pos_h-1)/5000) bh FROM rp WHERE sample LIKE 'NP%')
SELECT chr_l chr1, min(pos_l) - 1 start1, max(pos_l) end1, chr_h chr2, min(pos_h) - 1 start2, max(pos_h) end2, strand_l strand1, strand_h strand2,
 count(DISTINCT sample) n_samples, count(DISTINCT qname) n_reads {GROUPED}
"""

SEGMENTS = """
SELECT CAST(o_orderkey AS BIGINT) seg_id, 1 + CAST(o_custkey AS BIGINT) % 5 chr, (CAST(o_orderkey AS BIGINT) % 2000) * 500 "start", (CAST(o_orderkey AS BIGINT) % 2000) * 500 + 5000 "end",
  CASE o_orderkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'B' END source FROM {orders}
"""


def view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders") if "{" + t + "}" in text}
    if text != READ_PAIRS and READ_PAIRS in text:
        tables, text = {"pairs": view(spark, sf_dir, READ_PAIRS)}, text.replace(READ_PAIRS, "SELECT * FROM {pairs}")
    out = spark.sql(text.replace('"', "`"), **tables)
    # filters aren't substituted through a generator, so that each nested column is computed once for a row
    return out.select(F.inline(F.array(F.struct(*out.columns)))) if text == READ_PAIRS else out


def duck(text: str) -> str:
    return text.replace("{lineitem}", "lineitem").replace("{orders}", "orders")
