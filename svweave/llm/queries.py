"""Registered queries of the subpackage and, where SQL can express them, the SQL for their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, hard_negatives, jaccard_join, line_dedup, mixing, sentence_pieces, spelling, substring_dedup, suffix_dedup, token_files, top_k, toxicity, url_filter
from .common import new_folder, text_table

URL_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_quality(spark: SparkSession, measured: DataFrame, sf_dir: str) -> DataFrame:
    """``measured`` with ``quality_weight``: 2 for documents labelled good, 0.5 for bad ones, 1 for the rest."""
    labels = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("label_id")).agg(F.max("quality").alias("label_quality"))
    weight = F.when(F.col("label_quality") == 1, 2.0).when(F.col("label_quality") == 0, 0.5).otherwise(1.0)
    return measured.join(labels, measured["id"] == labels["label_id"], "left").withColumn("quality_weight", weight).drop("label_id", "label_quality")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.substring_dedup(text_table(table(spark, sf_dir, "documents")))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    token_files.write_tokens(text_table(table(spark, sf_dir, "documents")), path, tokenizer_path("word_bpe_49k.json"))
    return token_files.summary(spark, path)


def op5_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.encode_digests(text_table(table(spark, sf_dir, "documents")), tokenizer_path("piece_bpe_32k.model"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_quality(spark, mixing.measure(table(spark, sf_dir, "documents")), sf_dir)
    return mixing.mix(rows, quality_col="quality_weight").select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, url_filter.RULE_SCHEMA)
    return url_filter.url_filter(table(spark, sf_dir, "pages"), rules).withColumnRenamed("id", "page_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text_table(table(spark, sf_dir, "documents"))
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.search(table(spark, sf_dir, "embeddings"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_join.jaccard_join(text_table(table(spark, sf_dir, "documents")), shingle=3, percent=90)
    return out.select("doc_id", "n_shingles", "component_id")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), keep="largest").withColumnRenamed("id", "doc_id")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.suffix_dedup(text_table(table(spark, sf_dir, "documents")))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(text_table(table(spark, sf_dir, "documents")), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.expr("IF(vec_id % 7 = 0, (label + 1) % 10, label)").alias("label"))
    return hard_negatives.mine(rows)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(text_table(table(spark, sf_dir, "documents")), typo_modulus=97)


SQL_3 = r"""
WITH q AS (SELECT doc_id AS qid, max(quality) AS quality FROM labels GROUP BY doc_id),
d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
  -ln((CAST(('0x' || substr(md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))), 1, 13)) AS BIGINT) + 1.0::DOUBLE) / 4503599627370497.0::DOUBLE)
  / CASE quality WHEN 1 THEN 2.0::DOUBLE WHEN 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS k FROM documents LEFT JOIN q ON doc_id = qid),
s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM d GROUP BY source),
r AS (SELECT *, 3 * source_size AS cap, 3 * source_size / w::DOUBLE AS ratio FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::DOUBLE AS level FROM r
  WINDOW b AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT source, source_size, cap, ratio, w, (SELECT min_by(level, ratio) FROM l WHERE ratio > level) AS final FROM l),
t AS (SELECT source, source_size, CASE WHEN final IS NULL OR ratio <= final THEN cap::DOUBLE ELSE w * final END AS target FROM f),
g AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
u AS (SELECT doc_id, size, source_size, target, whole, target - whole * source_size AS rest, sum(size) OVER (PARTITION BY d.source ORDER BY k, size, doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size::BIGINT AS size, source_size, target, (size * least(3, whole + CASE WHEN upto - size / 2.0::DOUBLE <= rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM u
"""

SQL_6 = r"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
c AS (SELECT page_id, split_part(split_part(rest, '?', 1), '#', 1) AS rest FROM u),
p AS (SELECT page_id, translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path FROM c),
r(rh, rp, v) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
m AS (SELECT *, (SELECT max_by(rh || rp, length(rh || rp)) FROM r WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)) AS rule FROM p)
SELECT page_id, host, path, rule, coalesce((SELECT v FROM r WHERE rh || rp = rule), 'allow') AS verdict FROM m
"""

SQL_7 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
c AS (SELECT vec_id, generate_subscripts(e, 1) AS i, unnest(e) AS x FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, sum(q.x * c.x)::BIGINT AS score FROM c AS q JOIN c ON q.i = c.i AND q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id GROUP BY 1, 2),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5
"""

SQL_9 = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

SQL_11 = r"""
WITH l AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
k AS (SELECT doc_id, r, generate_subscripts(lines, 1) AS i, unnest(lines) AS line FROM l),
t AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM k),
f AS (SELECT key AS gone FROM t WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(gone)::BIGINT AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE gone IS NULL), '')) AS kept_sha256
FROM t LEFT JOIN f ON key = gone GROUP BY doc_id, r
"""

SQL_12 = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
c AS (SELECT vec_id, label, generate_subscripts(e, 1) AS i, unnest(e) AS x FROM v),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS id, any_value(a.label = c.label) AS same, sum(a.x * c.x)::BIGINT AS score FROM c AS a JOIN c ON a.i = c.i AND a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id GROUP BY 1, 2),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS k FROM s WHERE same) WHERE k <= 5),
r AS (SELECT p.anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INTEGER AS rank, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
  FROM p JOIN s AS n ON p.anchor_id = n.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
SELECT * FROM r WHERE rank <= 5
"""

QUERIES = {"op8_jaccard_join": op8_jaccard_join, "op10_suffix_dedup": op10_suffix_dedup, "op1_substring_dedup": op1_substring_dedup, "op4_toxicity": op4_toxicity, "op7_top_k": op7_top_k, "op2_token_files": op2_token_files, "op5_sentence_pieces": op5_sentence_pieces, "op3_mix_sources": op3_mix_sources, "op6_url_filter": op6_url_filter, "op9_exact_dedup": op9_exact_dedup, "op11_line_dedup": op11_line_dedup, "op12_hard_negatives": op12_hard_negatives, "op13_spelling_variants": op13_spelling_variants}
SQL = {"op7_top_k": SQL_7, "op3_mix_sources": SQL_3, "op6_url_filter": SQL_6, "op9_exact_dedup": SQL_9, "op11_line_dedup": SQL_11, "op12_hard_negatives": SQL_12}
