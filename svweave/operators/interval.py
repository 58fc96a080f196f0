"""Interval joins by bins, and islands of overlapping intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.shared import stored, tasks_for


def met(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which null keys are equal."""
    right = right.select(*(F.col(c).alias("_" + c if c in keys else c) for c in right.columns))
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col("_" + c))
    return left.join(right, same).drop(*("_" + c for c in keys))


def interval_islands(df: DataFrame, keys: list[str], lo: str, hi: str, order: list[str], name: str = "island", size: int = 2000) -> DataFrame:
    """Number the runs of rows (in ``order``, a number first, within ``keys``) no row of which starts at or after all earlier ends.

    Rows are ordered within blocks of ``size`` of the first of ``order``; of earlier blocks only the largest end and the number of
    islands are known there. So no task orders all rows of a key.
    """
    rows = df.withColumn("_block", F.floor(F.col(order[0]) / size))
    ends = stored(rows.groupBy(*keys, "_block").agg(F.max(hi).alias("_most"), F.count("*").alias("_rows")), "ends")
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # a block's first row tells the largest end before it
    marks = ends.select(*keys, "_block", F.max("_most").over(before).alias("_end")).withColumn("_mark", F.lit(0))
    n = tasks_for(df.sparkSession, ends.agg(F.sum("_rows")).first()[0] or 0)
    dealt = rows.withColumn("_end", F.col(hi)).withColumn("_mark", F.lit(1)).unionByName(marks, allowMissingColumns=True).repartition(n, *keys, "_block")
    w = Window.partitionBy(*keys, "_block").orderBy("_mark", *order)
    reach = F.max("_end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = dealt.withColumn("_new", F.when(F.col("_mark") == 0, 0).when(reach.isNull() | (F.col(lo) >= reach), 1).otherwise(0))
    own = stored(new.withColumn("_own", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).filter("_mark = 1").drop("_new", "_end", "_mark"), "islands")
    counts = own.groupBy(*keys, "_block").agg(F.max("_own").alias("_n"))
    counts = counts.select(*keys, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return met(own, counts, [*keys, "_block"]).withColumn(name, F.col("_own") + F.col("_before")).drop("_own", "_before", "_block")


def bins(lo: Column, hi: Column, size: int) -> Column:
    return F.explode(F.sequence(F.floor(lo / size), F.floor(hi / size)))


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], lo1: str, hi1: str, lo2: str, hi2: str, size: int = 5000) -> DataFrame:
    """Pairs whose closed intervals meet: an equi-join on bins; a pair counts in the bin of the larger start alone."""
    a = left.withColumn("_bin", bins(F.col(lo1), F.col(hi1), size))
    b = right.withColumn("_bin", bins(F.col(lo2), F.col(hi2), size))
    meets = (F.col(lo1) <= F.col(hi2)) & (F.col(lo2) <= F.col(hi1)) & (F.col("_bin") == F.floor(F.greatest(lo1, lo2) / size))
    return a.join(b, [*keys, "_bin"]).filter(meets).drop("_bin")


def renamed(df: DataFrame, prefix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*(F.col(c).alias(c if c in keep else prefix + c) for c in df.columns))


def band_pairs(calls: DataFrame, keys: dict[str, str], at: str, other: str, within: int) -> DataFrame:
    """Pairs ``a_*``, ``b_*`` of calls that agree on ``keys`` (a's column to b's) with ``|a.at - b.other| < within``."""
    a = renamed(calls, "a_").withColumn("_bin", F.floor(F.col("a_" + at) / within))
    b = renamed(calls, "b_").withColumn("_bin", F.explode(F.array(*(F.floor(F.col("b_" + other) / within) + k for k in (-1, 0, 1)))))
    b = b.withColumnRenamed("_bin", "_near")
    on = F.col("_bin") == F.col("_near")
    for x, y in keys.items():
        on = on & (F.col("a_" + x) == F.col("b_" + y))
    return a.join(b, on).filter(F.abs(F.col("a_" + at) - F.col("b_" + other)) < within).drop("_bin", "_near")
