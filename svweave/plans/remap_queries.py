"""Registered queries of remapping. Alignments have no SQL; tests compare them with a plain dynamic program."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import calls, remap, results
from ..sources.shared import freed, stored
from .queries import CALL_COLUMNS
from .segment_queries import NAMES
from .sequence_queries import sequence_table
from .views import BEDPE, READ_PAIRS, REF_LEN, view

QUERIES, SQL = {}, {}
CLASSES = 200


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of five chromosomes, each the longest text of a class of documents, begun at another letter in each tile."""
    # lengths alone are compared; only the longest texts move
    longest = F.max(F.struct(F.length(F.regexp_replace(F.coalesce("text", F.lit("")), "[^a-zA-Z]", "")).alias("n"), (-F.col("doc_id")).alias("doc"))).alias("best")
    best = spark.read.parquet(f"{sf_dir}/documents.parquet").groupBy((F.col("doc_id") % CLASSES).alias("class")).agg(longest).select("class", (-F.col("best.doc")).alias("doc_id"), F.col("best.n").alias("n"))
    texts = sequence_table(spark, sf_dir, "documents", "doc_id").join(F.broadcast(best), "doc_id").filter(F.length("seq") == F.col("n")).dropDuplicates(["class"]).select("class", F.col("seq").alias("text"))
    per, n = -(-REF_LEN // remap.TILE), F.length("text")
    at = spark.range(5 * per).select((1 + F.floor(F.col("id") / per)).alias("chr"), (F.col("id") % per).alias("tile"), (F.col("id") % CLASSES).alias("class"), "id")
    whole = F.when(n == 0, F.repeat(F.lit("N"), F.lit(remap.TILE))).otherwise(F.repeat("text", F.ceil(F.lit(2 * remap.TILE) / n).cast("int")))
    start = F.when(n == 0, 1).otherwise(F.col("id") * 37 % F.least(n, F.lit(remap.TILE)) + 1).cast("int")
    return stored(at.join(texts, "class").select("chr", "tile", F.substring(whole, start, F.lit(remap.TILE)).alias("seq")), "tiles")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls that pass the somatic filter, at the middles of their ends, with the pairs that they count as their score."""
    some = calls.filter_marked_groups(view(spark, sf_dir, BEDPE))
    middle = {f"pos{k}": F.floor((F.col(f"start{k}") + F.col(f"end{k}")) / 2).cast("long") for k in (1, 2)}
    return some.withColumns(middle).withColumn("score", F.col("tumour_count") + F.col("normal_count"))


def alignments(pairs: DataFrame) -> DataFrame:
    """Both reads of each pair, as the view of alignments has them, with the places that their bases are taken from."""
    ways = []
    for mate, own, other, quality in ((1, "l", "h", F.col("mapq") % 61), (2, "h", "l", (F.col("mapq") + F.col("pos_h")) % 61)):
        here = {c: F.col(f"{c}_{own}") for c in ("chr", "pos", "strand")} | {f"mate_{c}": F.col(f"{c}_{other}") for c in ("chr", "pos", "strand")}
        astray = quality % 7 == 0
        at = F.when(astray, here["mate_pos"]).otherwise(here["pos"])
        body = {"body_chr": F.when(astray, here["mate_chr"]).otherwise(here["chr"]), "body_lo": at, "body_hi": at + F.col("read_len") - 1}
        ways.append(F.struct(F.lit(mate).alias("mate"), *(x.alias(c) for c, x in (here | body).items())))
    return pairs.select("id", "qname", "read_len", F.inline(F.array(*ways)))


def remapped(spark: SparkSession, sf_dir: str, some: DataFrame) -> DataFrame:
    """Scores of the :func:`candidates`' tumour reads against 150 bases around each end. Reads whose mapping quality 7 divides were taken at their mates' places."""
    tiles = reference(spark, sf_dir)
    # names repeat in the table: with both places they don't
    unique = lambda low, high: F.concat_ws("@", "qname", F.col(low).cast("string"), F.col(high).cast("string"))
    pairs = view(spark, sf_dir, READ_PAIRS).withColumn("qname", unique("pos_l", "pos_h"))
    names = spark.sql(NAMES, pairs=pairs).filter("sample = 'T1'").join(some.select("id"), "id", "left_semi").select("id", "qname")
    tumour = pairs.filter("sample = 'T1'").select("qname", *(f"{c}_{e}" for c in ("chr", "pos", "strand") for e in "lh"), "mapq", "read_len")
    freed(spark)
    return remap.remap_calls(some, tumour, names, tiles, slop=150, unfold=alignments)


def f02_remap_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remapped(spark, sf_dir, stored(candidates(spark, sf_dir), "candidates"))


def b20_filter_remapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = stored(candidates(spark, sf_dir), "candidates")
    scores = remapped(spark, sf_dir, some).withColumn("microbes", F.lit(0))
    return results.filter_remap(some, scores).select(*CALL_COLUMNS)


QUERIES |= {"f02_remap_scores": f02_remap_scores, "b20_filter_remapped": b20_filter_remapped}
