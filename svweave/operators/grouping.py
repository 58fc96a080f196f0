"""Discordant pairs to groups: filters, windows, islands and the ordered sweep."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import expr
from ..sources.shared import stored, tasks_for
from .interval import interval_islands, met

ORDER = ["pos_l", "flag", "qname"]
#: Neighbouring islands whose groups are numbered together.
ISLANDS = 256


def discard_reason(pairs: DataFrame, min_mapq: int = 1, near: int = 10, drop_insertions: bool = True) -> DataFrame:
    """``reason`` of the first test a pair fails, null if none: proper, low mapq, mate near by, small apparent insertion."""
    same = F.col("chr_l") == F.col("chr_h")
    reason = F.when(F.col("flag").bitwiseAND(expr.PROPER) > 0, "proper").when(F.col("mapq") < min_mapq, "mapq").when(F.abs(F.col("pos_l") - F.col("pos_h")) < near, "near_mate")
    if drop_insertions:
        size = F.col("pos_h") + F.col("read_len") - F.col("pos_l")
        reason = reason.when(same & (F.col("strand_l") == "+") & (F.col("strand_h") == "-") & (size <= F.col("max_insert")), "insertion")
    return pairs.withColumn("reason", reason)


def filter_discordant(pairs: DataFrame, **options) -> DataFrame:
    return discard_reason(pairs, **options).filter("reason IS NULL").drop("reason")


def grouping_metrics(pairs: DataFrame, **options) -> DataFrame:
    return discard_reason(pairs, **options).groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n_pairs"))


def with_windows(pairs: DataFrame, ref_len: int) -> DataFrame:
    """Insert windows of both ends: ``l5, l3, h5, h3``; the read's own length counts for its mate too."""
    length, most = F.col("read_len"), F.col("max_insert")
    out = pairs
    for end in "lh":
        pos, strand = F.col(f"pos_{end}"), F.col(f"strand_{end}")
        out = out.withColumn(f"{end}5", expr.window_low(pos, strand, length, most)).withColumn(f"{end}3", expr.window_high(pos, strand, length, most, F.lit(ref_len)))
    return out


def islands(windows: DataFrame) -> DataFrame:
    """A read at or past all earlier windows' ends meets none of the older groups of its key: an island of its own."""
    return interval_islands(windows, ["chr_l", "strand_l", "chr_h"], "l5", "l3", ORDER)


GROUP_SCHEMA = "chr_l long, strand_l string, chr_h long, strand_h string, island long, number int, l5 long, l3 long, h5 long, h3 long, qname string, sample string"
ISLAND_KEY = ["chr_l", "strand_l", "chr_h", "island"]
#: Makes the order total, so that a task that runs again opens the same groups.
TIES = ["strand_h", "l5", "l3", "h5", "h3", "sample"]
#: A member has ``opened`` (its group's place among the island's groups as they open); a group's last row its ``number`` (as they close) and bounds.
SWEPT_SCHEMA = "chr_l long, strand_l string, chr_h long, strand_h string, island long, opened long, number int, l5 long, l3 long, h5 long, h3 long, qname string, sample string"
#: Rows that the sweep holds before it hands them on.
SWEPT_ROWS = 10_000


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members and groups of islands that come one after another in order: each pair joins every open group it meets, which shrinks, or opens one.

    Members are handed on at once; only open groups' bounds are kept. An unknown bound (as NaN) meets nothing.
    """
    ends = ("l5", "l3", "h5", "h3")
    schema = pa.schema([(n, {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}[k]) for n, k in (c.split() for c in SWEPT_SCHEMA.split(", "))])
    key, active, opened, closed, out = None, [], 0, 0, []

    def close(groups: list[list]) -> None:
        nonlocal closed
        for n, s, l5, l3, h5, h3 in groups:
            out.append((*key[:3], s, key[3], n, closed, *(None if x != x else x for x in (l5, l3, h5, h3)), None, None))
            closed += 1

    def flushed() -> pa.RecordBatch:
        columns = zip(*out) if out else [[] for _ in schema]
        rows = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
        out.clear()
        return rows

    for b in batches:
        for chr_l, strand_l, chr_h, island, strand_h, l5, l3, h5, h3, qname, sample in zip(*([math.nan if x is None and c in ends else x for x in b.column(b.schema.get_field_index(c)).to_pylist()] for c in [*ISLAND_KEY, "strand_h", *ends, "qname", "sample"])):
            if key != (chr_l, strand_l, chr_h, island):
                close(active)
                key, active, opened, closed = (chr_l, strand_l, chr_h, island), [], 0, 0
            if any(g[3] <= l5 for g in active):
                close([g for g in active if g[3] <= l5])
                active = [g for g in active if not g[3] <= l5]
            joined = False
            for g in active:
                if g[1] == strand_h and g[2] <= l3 and l5 <= g[3] and g[4] <= h3 and h5 <= g[5]:
                    g[2], g[3], g[4], g[5] = max(g[2], l5), min(g[3], l3), max(g[4], h5), min(g[5], h3)
                    out.append((*key[:3], strand_h, key[3], g[0], None, None, None, None, None, qname, sample))
                    joined = True
            if not joined:
                active.append([opened, strand_h, l5, l3, h5, h3])
                out.append((*key[:3], strand_h, key[3], opened, None, None, None, None, None, qname, sample))
                opened += 1
            if len(out) >= SWEPT_ROWS:
                yield flushed()
    close(active)
    yield flushed()


def group_members(pairs: DataFrame, ref_len: int) -> DataFrame:
    """Long form of the groups: a row for each member. The step that depends on order is a stream in order of islands.

    Groups are numbered as they close, in ``ISLANDS`` neighbouring islands together.
    """
    some = islands(with_windows(pairs, ref_len).select(*ISLAND_KEY[:-1], *ORDER, *TIES))
    swept = stored(some.repartition(*ISLAND_KEY).sortWithinPartitions(*ISLAND_KEY, *ORDER, *TIES).mapInArrow(sweep, SWEPT_SCHEMA), "swept")
    pack = F.floor(F.col("island") / ISLANDS)
    ended = swept.filter("number IS NOT NULL").select(*ISLAND_KEY, "opened", "number", "l5", "l3", "h5", "h3")
    sizes = ended.groupBy(*ISLAND_KEY).agg(F.count("*").alias("n")).withColumn("pack", pack)
    before = Window.partitionBy("chr_l", "strand_l", "chr_h", "pack").orderBy("island").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n", "pack")
    ended = met(ended, sizes, ISLAND_KEY).withColumn("number", (F.col("number") + F.col("before")).cast("int")).drop("before")
    members = met(swept.filter("number IS NULL").drop("number", "l5", "l3", "h5", "h3"), ended, [*ISLAND_KEY, "opened"])
    return members.withColumn("island", pack).select(*(c.split()[0] for c in GROUP_SCHEMA.split(", ")))


GROUP_KEY = ["chr_l", "strand_l", "chr_h", "strand_h", "island", "number", "l5", "l3", "h5", "h3"]


def sample_counts(members: DataFrame, by: list[str], tumour: str, normal: str, panel_prefix: str = "NP", rows: int | None = None) -> DataFrame:
    """Distinct read names of the tumour, the normal and the panel, and the panel's samples, for each group.

    Members move once, by group and name, to as many tasks as ``rows`` (about their number; default: counted) ask for.
    """
    n = tasks_for(members.sparkSession, members.count() if rows is None else rows)
    pairs = members.repartition(n, *by, "qname").groupBy(*by, "qname", "sample").agg(F.count("*").alias("total"))
    named, s, zero = F.col("qname").isNotNull(), F.col("sample"), F.lit(0).cast("long")
    some = lambda test: F.max(F.when(named & test, 1).otherwise(0)).cast("long")
    names = pairs.groupBy(*by, "qname").agg(some(s == tumour).alias("tumour_count"), some(s == normal).alias("normal_count"), some(s.startswith(panel_prefix)).alias("np_count"), zero.alias("np_sample_count"), F.sum("total").alias("total")).drop("qname")
    panel = pairs.filter(s.startswith(panel_prefix)).select(*by, "sample").distinct().select(*by, *(zero.alias(c) for c in ("tumour_count", "normal_count", "np_count")), F.lit(1).cast("long").alias("np_sample_count"), zero.alias("total"))
    return names.unionByName(panel).groupBy(*by).agg(*(F.sum(c).alias(c) for c in ("tumour_count", "normal_count", "np_count", "np_sample_count", "total")))


def group_pairs(pairs: DataFrame, ref_len: int, tumour: str, normal: str, min_count: int = 2) -> DataFrame:
    """Groups of at least ``min_count`` pairs with their counts."""
    return sample_counts(group_members(pairs, ref_len), GROUP_KEY, tumour, normal, rows=pairs.count()).filter(F.col("total") >= min_count)


def join_panel(groups: DataFrame, panel: DataFrame) -> DataFrame:
    """The panel's best overlapping group for each ``id``: most samples, most reads, smallest location; zeros when none."""
    key = ["chr1", "strand1", "chr2", "strand2"]
    p = panel.select(*key, F.col("start1").alias("p_start1"), F.col("end1").alias("p_end1"), F.col("start2").alias("p_start2"), F.col("end2").alias("p_end2"), F.col("n_samples").alias("p_samples"), F.col("n_reads").alias("p_reads"))
    low = groups.select("id", *key, "start1", "end1", "start2", "end2").withColumn("_bin", F.explode(F.sequence(F.floor(F.col("start1") / 5000), F.floor(F.col("end1") / 5000))))
    p = p.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("p_start1") / 5000), F.floor(F.col("p_end1") / 5000))))
    meets = (F.col("start1") <= F.col("p_end1")) & (F.col("p_start1") <= F.col("end1")) & (F.col("start2") <= F.col("p_end2")) & (F.col("p_start2") <= F.col("end2"))
    best = Window.partitionBy("id").orderBy(F.col("p_samples").desc(), F.col("p_reads").desc(), "p_start1", "p_end1", "p_start2", "p_end2")
    hit = low.join(p, [*key, "_bin"]).filter(meets).withColumn("_rank", F.row_number().over(best)).filter("_rank = 1").select("id", "p_samples", "p_reads")
    return groups.join(hit, "id", "left").withColumn("panel_samples", F.coalesce("p_samples", F.lit(0))).withColumn("panel_reads", F.coalesce("p_reads", F.lit(0))).drop("p_samples", "p_reads")
