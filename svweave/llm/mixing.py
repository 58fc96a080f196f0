"""Operator 3, mixing sources to target weights by Efraimidis-Spirakis sampling.

Each row's key is an exponential variate (from a hash of seed, id and text) divided by its quality weight; the smallest
keys of a source come first. A source's target is first filled with complete epochs; the rest goes to the rows at the head
of the order until their running size meets it. Running sizes are two-level: a source is cut into bins of its keys, about
``bin_rows`` rows each, so that a hot source is many small windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD

HEX53 = 13  # hex digits of a digest that fit a double exactly


def text_size(text: F.Column) -> F.Column:
    """Words of the text; null: 0."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def water_level(sources: DataFrame, max_epochs: int = 3) -> DataFrame:
    """``target`` for rows ``source, source_size, weight``: shares by weight, at most ``max_epochs`` times the size.

    In ascending order of cap / weight, a source is capped if its cap is at most its share of what the ones before leave.
    """
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    caps = sources.withColumn("cap", F.lit(max_epochs) * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    left = caps.withColumn(
        "level",
        (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))),
    )
    final = F.min_by(F.when(F.col("ratio") > F.col("level"), F.col("level")), F.when(F.col("ratio") > F.col("level"), F.col("ratio"))).over(every)
    return left.withColumn("final", final).withColumn(
        "target", F.when(F.col("final").isNull() | (F.col("ratio") <= F.col("final")), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("final"))
    ).select("source", "source_size", "n_rows", "target")


def measure(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``id, source, size, text_md5``: what the mix needs of each row, without its text."""
    text = F.col(text_col).cast("string")
    return df.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), text_size(text).alias("size"), F.md5(F.coalesce(text, F.lit(""))).alias("text_md5"))


def sampling_key(seed: int, quality: F.Column) -> F.Column:
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("text_md5")))
    u = (F.conv(F.substring(digest, 1, HEX53), 16, 10).cast("double") + F.lit(1.0)) / F.lit(float(16**HEX53) + 1.0)
    return -F.ln(u) / quality


def mix(rows: DataFrame, quality_col: str | None = None, max_epochs: int = 3, seed: int = 17, bin_rows: int = 4096) -> DataFrame:
    """``id, source, size, source_size, target, epochs, taken, text_md5``: a row for each of :func:`measure`'s;
    ``taken = epochs * size``.

    ``quality_col``: positive weights, null or not positive counts as 1. Sources come by code point, a null source last, and
    weigh 1, 2, 3, repeating. Null and empty texts have size 0 and are taken with 0 words. Equal keys (repeated rows) come in
    order of size; a row counts towards the rest while at least half of it fits. An empty input gives no row.
    """
    quality = F.lit(1.0) if quality_col is None else F.when(F.col(quality_col) > 0, F.col(quality_col).cast("double")).otherwise(F.lit(1.0))
    rows = rows.select("id", "source", "size", "text_md5", sampling_key(seed, quality).alias("key"))
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    ranked = totals.withColumn("weight", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1)
    goals = water_level(ranked, max_epochs).withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    goals = goals.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")).withColumnRenamed("source", "goal_source")
    keyed = rows.join(F.broadcast(goals) if _few(goals) else goals, F.col("source").eqNullSafe(F.col("goal_source"))).drop("goal_source")
    keyed = keyed.withColumn("bin", F.floor(F.ceil(F.col("n_rows") / bin_rows) * (1 - F.exp(-F.col("key")))).cast("long"))
    sums = keyed.groupBy("source", "bin").agg(F.sum("size").alias("in_bin"))
    sums = sums.withColumn("before_bin", F.coalesce(F.sum("in_bin").over(Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    sums = sums.select(F.col("source").alias("s"), F.col("bin").alias("b"), "before_bin")
    within = Window.partitionBy("source", "bin").orderBy("key", "size", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = keyed.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b"))).withColumn("upto", F.col("before_bin") + F.sum("size").over(within))
    epochs = F.col("whole") + F.when(F.col("upto") - F.col("size") / 2.0 <= F.col("rest"), F.lit(1)).otherwise(F.lit(0))
    return run.withColumn("epochs", F.least(epochs, F.lit(max_epochs)).cast("int")).select("id", "source", "size", "source_size", "target", "epochs", (F.col("epochs") * F.col("size")).alias("taken"), "text_md5")


def _few(goals: DataFrame, most: int = 10_000) -> bool:
    """Whether the table of sources is small enough to broadcast."""
    return goals.limit(most + 1).count() <= most
