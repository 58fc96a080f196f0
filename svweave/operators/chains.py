"""Chains of linked rows: the head of each and every row's place, by drawing links together and pointer jumping, through joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import deleted, folder, freed

#: Open rows that pointer jumping starts with at most; of more, links are drawn together first.
JUMPED = 1 << 20


def _there(table: DataFrame, by: list[str], columns: list[str]) -> tuple[DataFrame, Column]:
    """``table`` with ``_`` before its names, and the condition that a row's ``ptr`` is there."""
    there = table.select(*(F.col(c).alias("_" + c) for c in [*by, "node", *columns]))
    on = F.col("ptr") == F.col("_node")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col("_" + c))
    return there, on


def _jumped(ptr: DataFrame, table: DataFrame, by: list[str]) -> DataFrame:
    """One round: rows that point at a row of ``table`` which points on take over its pointer; ``least`` covers what lies between.

    Heads are not in ``table``: what points at none of its rows has met its head.
    """
    there, on = _there(table, by, ["ptr", "steps", "least"])
    moved = F.col("_ptr").isNotNull()
    return ptr.join(there, on, "left").select(
        *by, "node", F.when(moved, F.col("_ptr")).otherwise(F.col("ptr")).alias("ptr"), (F.col("steps") + F.when(moved, F.col("_steps")).otherwise(0)).alias("steps"), F.least("least", "_least").alias("least"), moved.alias("open"),
    )


def _drawn(rows: DataFrame, gone_path: str, by: list[str], salt: int) -> DataFrame:
    """``rows`` without those that one drawing takes away (written to ``gone_path``): rows with 1 before which one with 0 stands, by a hash.

    What pointed at one of them takes over its pointer. No two of them are neighbours; a quarter of the open rows goes.
    """
    coin = lambda c: F.xxhash64(c, F.lit(salt)).bitwiseAND(1) == 1
    takes = F.coalesce(F.col("open") & coin("node") & ~coin("ptr"), F.lit(False))
    rows.filter(takes).select(*by, "node", "ptr", "steps", "least").write.parquet(gone_path)
    gone = rows.sparkSession.read.schema(rows.select(*by, "node", "ptr", "steps", "least").schema).parquet(gone_path)
    asks = F.col("open") & coin("ptr")
    there, on = _there(gone, by, ["ptr", "steps", "least"])
    met = F.col("_node").isNotNull()
    ptr = F.coalesce("_ptr", "ptr")
    asked = rows.filter(~takes & asks).join(there, on, "left").select(
        *by, "node", ptr.alias("ptr"), (F.col("steps") + F.when(met, F.col("_steps")).otherwise(0)).alias("steps"), F.least("least", "_least").alias("least"), (ptr != F.col("node")).alias("open"),
    )
    return rows.filter(~takes & ~F.coalesce(asks, F.lit(False))).select(asked.columns).unionByName(asked)


def chain_places(nodes: DataFrame, by: list[str], rank: str | None = None) -> DataFrame:
    """``*by, node, head, place, cyclic`` of ``nodes`` (``*by, node, prev``): where a chain begins and a row's distance from there.

    ``prev`` is the row before, one of ``nodes`` (null at a chain's head); no two rows share one. Rows on a circle are marked and have no
    place: their ``head`` is the least ``rank`` (default ``node``) on it. While more than ``JUMPED`` rows don't know their head, a quarter of
    them is taken out of their chains in each round, so that all rounds together move a few times the rows; then pointers jump, in rounds
    that grow with the logarithm of the longest chain, each of which writes the rows alone whose chain's head isn't met yet; then what was
    taken out is put back, the last first.
    """
    spark = nodes.sparkSession
    least = F.col(rank) if rank else F.col("node")
    linked = F.col("prev").isNotNull()
    met = nodes.select(*by, "node", F.col("prev").alias("ptr"), F.when(linked, 1).otherwise(0).cast("long").alias("steps"), least.alias("least"), (linked & (F.col("prev") != F.col("node"))).alias("open"))
    path = folder(spark, "jumps")
    read = spark.read.schema(T.StructType([*met.schema, T.StructField("round", T.IntegerType())]))
    met.withColumn("round", F.lit(0)).write.parquet(f"{path}.all")
    # heads stay where they are
    heads = read.parquet(f"{path}.all").filter("ptr IS NULL").select(*by, "node", F.col("node").alias("head"), F.lit(0).cast("long").alias("place"), F.lit(False).alias("cyclic"))
    paths, drawn = [f"{path}.all"], 0
    linked = lambda: read.parquet(*paths).filter("ptr IS NOT NULL")
    left = linked().filter("open").count()
    while left > JUMPED:
        level = _drawn(linked(), f"{path}.gone/{drawn}", by, drawn).withColumn("round", F.lit(0))
        drawn += 1
        level.write.parquet(f"{path}.level/{drawn}")
        if drawn > 1:
            deleted(spark, f"{path}.level/{drawn - 1}")
        paths = [f"{path}.level/{drawn}"]
        left = linked().filter("open").count()
    if drawn:
        freed(spark)
    before = None
    while True:
        # rows that met their head stay as they are, the others are those of the last round
        last = len(paths) - 1
        every = linked().filter((F.col("round") == last) | ~F.col("open"))
        # each round some rows of an open chain meet its head: if none did, all that are left run in circles
        circling = left == before
        if not left or (circling and 1 << last > left):
            break
        ptr = read.parquet(paths[-1]).filter("open")
        _jumped(ptr, ptr if circling else every, by).withColumn("round", F.lit(last + 1)).write.parquet(f"{path}/{last + 1}")
        paths.append(f"{path}/{last + 1}")
        before, left = left, read.parquet(paths[-1]).filter("open").count()
    circle = F.col("open") | (F.col("ptr") == F.col("node"))
    known = every.select(*by, "node", F.when(circle, F.col("least")).otherwise(F.col("ptr")).alias("head"), F.when(~circle, F.col("steps")).alias("place"), circle.alias("cyclic"))
    if not drawn:
        return heads.unionByName(known)
    types = known.schema
    heads.write.parquet(f"{path}.known/heads")
    known.write.parquet(f"{path}.known/{drawn}")
    deleted(spark, path, f"{path}.all", f"{path}.level")
    freed(spark)
    for r in range(drawn - 1, -1, -1):
        known = spark.read.schema(types).parquet(*(f"{path}.known/{x}" for x in range(r + 1, drawn + 1)))
        gone = spark.read.schema(met.select(*by, "node", "ptr", "steps").schema).parquet(f"{path}.gone/{r}")
        there, on = _there(known, by, ["head", "place", "cyclic"])
        place = F.when(F.col("_node").isNull(), F.col("steps")).otherwise(F.col("steps") + F.col("_place"))
        back = gone.join(there, on, "left").select(*by, "node", F.coalesce("_head", "ptr").alias("head"), place.alias("place"), F.coalesce("_cyclic", F.lit(False)).alias("cyclic"))
        back.write.parquet(f"{path}.known/{r}")
        deleted(spark, f"{path}.gone/{r}")
    freed(spark)
    return spark.read.schema(types).parquet(f"{path}.known/heads", *(f"{path}.known/{r}" for r in range(drawn + 1)))
