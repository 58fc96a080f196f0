"""Operator 6, URL filters: a sort-merge range join between rule intervals and reversed-host keys.

A rule ``(host, path)`` becomes the interval of keys that start with ``reversed host + 0xFE + path``. Keys are bytes: UTF-8
has neither 0xFE, which parts host and path, nor 0xFF, which ends an interval past all its texts. A page has one key for
each of its host's suffixes, so a subdomain meets the rules of all its parents. Rules' edges and page keys are sorted
together over range partitions; the state after an edge is the stack of rules that are open there, and a key takes the
state of the last edge at or before it, carried over partition bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import stored

RULE_SCHEMA = T.StructType([T.StructField("host", T.StringType()), T.StructField("path", T.StringType()), T.StructField("verdict", T.StringType())])
#: Rules on all carried stacks that are broadcast at most.
BROADCAST_CELLS = 100_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: F.Column) -> F.Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def url_host(url: F.Column) -> F.Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), F.lit("")), _UPPER, _LOWER)


def url_path(url: F.Column) -> F.Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty. A host that ``?`` or ``#`` ends has no path."""
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*(/[^?#]*)?", 1), F.lit(""))


def reversed_host(host: F.Column) -> F.Column:
    return F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")


def key_of(rev: str, path: str) -> F.Column:
    return F.concat(F.encode(rev, "UTF-8"), F.lit(bytearray(b"\xfe")), F.encode(path, "UTF-8"))


def rule_edges(rules: DataFrame) -> DataFrame:
    """Where the set of open rules changes: ``key, stack``; the stack's last entry is the innermost open rule.

    Intervals of prefixes nest or are disjoint. An edge is any interval's start or end; the rules open at it are those
    whose own key is a prefix of the edge, found by an equi-join on the prefixes of the edge's key.
    """
    r = (
        rules.groupBy(F.translate(F.col("host"), _UPPER, _LOWER).alias("host"), F.col("path")).agg(F.max("verdict").alias("verdict"))
        .withColumn("rev", reversed_host(F.col("host"))).withColumn("lo", key_of("rev", "path"))
    )
    top = bytearray(b"\xff")
    edges = r.select(F.col("lo").alias("key"), F.lit(False).alias("closes")).union(r.select(F.concat("lo", F.lit(top)).alias("key"), F.lit(True)))
    body = F.when(F.col("closes"), F.expr("substring(key, 1, length(key) - 1)")).otherwise(F.col("key"))
    inner = F.when(F.col("closes"), F.length(body) - 1).otherwise(F.length(body))
    prefixes = edges.distinct().withColumn("body", body).withColumn("most", inner).select("key", F.explode_outer(F.when(F.col("most") > 0, F.expr("transform(sequence(1, most), n -> substring(body, 1, n))"))).alias("lo"))
    opened = F.struct(F.length("lo").alias("n"), F.concat("host", "path").alias("rule"), "verdict", (F.length("host") + F.length("path")).alias("size"))
    return (
        prefixes.join(r, "lo", "left").groupBy("key")
        .agg(F.array_sort(F.collect_list(F.when(F.col("host").isNotNull(), opened))).alias("stack"))
    )


def url_filter(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", salts: int = 64) -> DataFrame:
    """``id, host, path, rule, verdict`` for each row of ``pages``; ``rules`` has ``host, path, verdict``.

    The longest rule that fits wins (host and path together; ties: larger rule string). Rules that repeat a host and path
    take the larger verdict. No rule, a null url or one without ``://``: ``rule`` null and ``default``. Rows that repeat an
    id are judged by their own urls.
    """
    judged = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url")).select(
        F.xxhash64("id", "url").alias("part"), F.monotonically_increasing_id().alias("row"), "id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")
    )
    judged = stored(judged, "pages")
    labels = F.split("host", r"\.", -1)
    suffixes = judged.withColumn("labels", F.reverse(labels)).select(
        "row", "path", F.pmod("part", F.lit(salts)).cast("int").alias("salt"), F.explode(F.expr("transform(sequence(1, size(labels)), n -> array_join(slice(labels, 1, n), '.'))")).alias("rev")
    )
    keys = suffixes.select(key_of("rev", "path").alias("key"), F.lit(1).alias("kind"), "salt", "row", F.lit(None).cast("array<struct<n:int,rule:string,verdict:string,size:int>>").alias("stack"))
    edges = rule_edges(rules).select("key", F.lit(0).alias("kind"), F.lit(0).alias("salt"), F.lit(None).cast("long").alias("row"), "stack")
    # equal keys may be many: the salt lets a range bound fall among them
    swept = stored(edges.unionByName(keys).repartitionByRange("key", "kind", "salt").withColumn("part", F.spark_partition_id()), "sweep")
    order = Window.partitionBy("part").orderBy("key", "kind", "salt")
    last = swept.filter("kind = 0").groupBy("part").agg(F.max_by("stack", "key").alias("stack"))
    parts = swept.select("part").distinct().join(last, "part", "left")
    carried = parts.select("part", F.last("stack", True).over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    # a row a partition, with the stack that is open there: broadcast while the stacks are few
    cells = carried.agg(F.sum(F.greatest(F.size("before"), F.lit(0)) + 1)).first()[0] or 0
    carried = F.broadcast(carried) if cells <= BROADCAST_CELLS else carried
    held = swept.withColumn("open", F.last("stack", True).over(order)).filter("kind = 1").join(carried, "part", "left").withColumn("open", F.coalesce("open", "before"))
    best = held.withColumn("top", F.try_element_at(F.filter("open", lambda s: s["rule"].isNotNull()), F.lit(-1))).filter(F.col("top").isNotNull()).groupBy("row").agg(F.max(F.struct("top.size", "top.rule", "top.verdict")).alias("best"))
    return judged.join(best, "row", "left").select("id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
