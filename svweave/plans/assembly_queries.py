"""Registered queries of local assembly. Walks over graphs have no SQL; tests compare them with plain ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assembly
from .sequence_queries import sequence_table

K, BY = 21, ["collection"]


def graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Unitigs of each source's texts."""
    return assembly.unitigs(sequence_table(spark, sf_dir, "documents", "source").withColumnRenamed("source", "collection"), K, BY)


def h02_unitigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph(spark, sf_dir)[0].select(*BY, "vertex", "twin", F.md5("seq").alias("seq_md5"), "n_kmers", "coverage")


def h03_smoothed_bubbles(spark: SparkSession, sf_dir: str) -> DataFrame:
    vertices, _ = assembly.smooth_bubbles(*graph(spark, sf_dir), K, BY)
    return vertices.select(*BY, "vertex", "twin", F.md5("seq").alias("seq_md5"), "n_kmers", "coverage", "bubble")


def h04_quintets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Breakpoint patterns with what stands at their junctions."""
    vertices, edges = assembly.smooth_bubbles(*graph(spark, sf_dir), K, BY)
    out = assembly.quintets(vertices, edges, K, BY)
    for v, name in (("v1", "left"), ("v2", "middle"), ("v3", "right")):
        out = out.join(vertices.select(*BY, F.col("vertex").alias(v), F.col("seq").alias(name)), [*BY, v])
    return assembly.junction(out, K).select(*BY, "v0", "v1", "v2", "v3", "v4", "gap", "kind", "bases")


def h05_quintet_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    vertices, edges = assembly.smooth_bubbles(*graph(spark, sf_dir), K, BY)
    return assembly.quintet_scores(vertices, edges, K, BY)


QUERIES = {f.__name__: f for f in (h02_unitigs, h03_smoothed_bubbles, h04_quintets, h05_quintet_scores)}
SQL = {}
