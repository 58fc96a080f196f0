"""Operator 9, exact dedup: a tree of merges of sorted digest runs.

Digests are cut into ranges, and the rows of a range are dealt over runs. A run is sorted by digest; equal digests stand
together and become one row with the identifier that stays and the number of copies, if their lengths and second digests
agree as well. In each round a run takes the runs of its next ``fan_in - 1`` neighbours (at distances that grow by
``fan_in``, a binomial tree for two) and the sorted merge keeps one row a digest again, until a range has one run. A row
finds its group through the first runs, in which a text of any number of copies has at most one row each: no key is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KEY = ["digest", "n_bytes", "second"]


def normalised(text: F.Column, lower: bool = False) -> F.Column:
    """The compared text: null counts as empty; unchanged unless ``lower``."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    return F.lower(out) if lower else out


def merged_runs(rows: DataFrame, largest: bool) -> DataFrame:
    """One row for each digest of each run: sorted rows next to each other are equal if length and second digest are too."""
    best = F.col("keep_id").desc_nulls_last() if largest else F.col("keep_id").asc_nulls_last()
    run = rows.repartition("range", "run").sortWithinPartitions("range", "run", *KEY, best)
    equal = Window.partitionBy("range", "run", *KEY).orderBy(best)
    size = F.sum("group_size").over(equal.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return run.select("range", "run", *KEY, "keep_id", F.row_number().over(equal).alias("place"), size.alias("group_size")).filter("place = 1").drop("place")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", runs: int = 64, fan_in: int = 4, ranges: int = 256, lower: bool = False) -> DataFrame:
    """``id, keep_id, group_size, kept, text_sha256``: a row for each row of ``df``.

    Null and empty texts are one group. A null id takes part and stays only if its whole group has null ids. Rows that
    repeat an id with the same text are all kept or all dropped with that id. An empty input gives no row.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep}")
    text = normalised(F.col(text_col), lower)
    rows = df.select(F.col(id_col).alias("id"), text.alias("t")).select(
        "id", F.unhex(F.sha2("t", 256)).alias("digest"), F.octet_length("t").alias("n_bytes"), F.xxhash64("t").alias("second"),
        F.pmod(F.xxhash64("id"), F.lit(runs)).cast("int").alias("run"),
    )
    rows = rows.withColumn("range", F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), F.lit(ranges)).cast("int"))
    first = merged_runs(rows.select("range", "run", *KEY, F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size")), keep == "largest")
    level, left = first, runs
    while left > 1:
        left = -(-left // fan_in)
        level = merged_runs(level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int")), keep == "largest")
    by_run = first.select("range", "run", *KEY).join(level.drop("run"), ["range", *KEY])
    return rows.join(by_run, ["range", "run", *KEY]).select(
        "id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )
