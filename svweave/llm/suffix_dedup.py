"""Operator 10, suffix-array dedup: Burrows-Wheeler transforms of shards, merged by interleave refinement.

Windows of ``length`` bytes are compared through the paths of :mod:`.paths`. A path at which no document branches is judged
whole. The distinct strings of branching paths go, by minimizer, to groups; in a group each shard of strings is suffix
sorted once, and the shards' transforms are merged: an interleave of their rows is refined symbol by symbol (the method of
Holt and McMillan), so that after ``d`` rounds rows stand in order of their first ``d`` bytes without sorting suffixes again.
Where a round first parts two neighbours is their common prefix, and a row parted from both takes no further part; rows that
no round of ``length`` parts form a repeated interval, and the smallest document id in an interval decides its windows.
Strings of a minimizer with more than ``HOT_STRINGS`` of them are not merged: their windows meet by digest in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import NO_ID, byte_values, discard, mixed, range_hashes, stored
from .paths import PACK, Row, Spec, batch, partitioned_packs, path_rows, per_pack, recurring, signed

GRAM = 24
#: Strings of one merge (all strings of a minimizer stay together) and of one shard.
MERGE_STRINGS, SHARD_STRINGS, BUCKET_STRINGS = 2048, 512, 16384
#: Strings of one minimizer that are merged at most, and parts into which the rows of one window's digest are dealt.
HOT_STRINGS, SALTS = 32768, 64
WINDOW_SCHEMA = "value long, digest long, low long, place int, one long, two long"
STRING_SCHEMA = "value long, digest long, low long, string binary"
OUT_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<bigint>"


def shard_transform(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order and transform of strings that end with 0; a terminator is smaller the earlier its string stands."""
    n = len(text)
    ends = np.flatnonzero(text == 0)
    left = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)  # symbols before the suffix's terminator
    key = np.zeros(n, np.uint64)
    for k in range(8):
        symbol = np.zeros(n, np.uint64)
        symbol[: n - k] = text[k:]
        symbol[left < k] = 0
        key = (key << np.uint64(8)) | symbol
    ended, order = left < 8, np.argsort(key, kind="stable")
    rank, span = np.empty(n, np.int64), 8
    fresh = np.concatenate([[True], (key[order][1:] != key[order][:-1]) | ended[order][1:] | ended[order][:-1]])
    rank[order] = np.cumsum(fresh) - 1
    while not fresh.all():
        after = np.full(n, 0, np.int64)
        after[: n - span] = rank[span:] + 1
        key = rank * np.int64(n + 2) + after
        order = np.argsort(key, kind="stable")
        fresh = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        rank[order] = np.cumsum(fresh) - 1
        span *= 2
    return order, text[order - 1]


def merged_intervals(text: np.ndarray, cuts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes whose first ``depth`` symbols recur, in order of these, and the interval of equal ones of each.

    ``text`` holds strings that end with 0; ``cuts`` bounds the shards. A suffix that a round parts from both neighbours, or
    that ends there, shares no longer prefix with another, nor does any suffix that it ends: its row leaves the interleave.
    """
    suffix, symbol, target = [], [], []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        order, bwt = shard_transform(text[a:b])
        step = np.empty(b - a, np.int32)
        step[np.argsort(bwt, kind="stable")] = np.arange(b - a)  # the row of the suffix one symbol longer
        suffix.append((order + a).astype(np.int32))
        symbol.append(bwt)
        target.append(step + np.int32(a))
    suffix, symbol, target = (np.concatenate(x) for x in (suffix, symbol, target))
    row, group = np.arange(len(text), dtype=np.int32), np.zeros(len(text), np.int32)
    for _ in range(depth):
        s = symbol[row]
        at = np.argsort(s, kind="stable")[np.count_nonzero(s == 0) :]
        s, g = s[at], group[at]
        parted = np.ones(len(at) + 1, bool)
        np.not_equal(s[1:], s[:-1], out=parted[1:-1])
        parted[1:-1] |= g[1:] != g[:-1]
        shared = np.flatnonzero(~(parted[:-1] & parted[1:]))
        row = target[row[at[shared]]]
        group = np.cumsum(parted[shared], dtype=np.int32)
        if not len(row):
            break
    return suffix[row], group


def window_minima(strings: list[bytes], low: np.ndarray, length: int) -> list[np.ndarray]:
    """For each window of each string the smallest of ``low`` among the strings that hold it."""
    lens = np.array([len(s) + 1 for s in strings])
    text = np.frombuffer(b"\x00".join(strings) + b"\x00", np.uint8).astype(np.uint8)
    start = np.cumsum(lens) - lens
    inside = np.ones(len(text), bool)
    inside[start + lens - 1] = False
    text = np.where(inside, text + 1, 0).astype(np.uint8)  # UTF-8 has no byte 255
    cuts = np.append(start[::SHARD_STRINGS], len(text))
    suffix, group = merged_intervals(text, cuts, length)
    owner = np.repeat(np.arange(len(strings)), lens)
    out = low[owner]
    if len(suffix):
        first = np.flatnonzero(np.diff(group, prepend=group[0] - 1))
        least = np.minimum.reduceat(low[owner[suffix]], first)
        out[suffix] = np.repeat(least, np.diff(np.append(first, len(group))))
    return [out[a : a + n - length] for a, n in zip(start.tolist(), lens.tolist())]


def repeated(strings: DataFrame, length: int) -> DataFrame:
    """``value, digest, news``: runs (from, to, smallest id) of the windows that a smaller id than the path's own holds."""
    hot = F.broadcast(stored(strings.groupBy("value").count().filter(F.col("count") > HOT_STRINGS).select("value"), "hot"))
    return merged(strings.join(hot, "value", "left_anti"), length).unionByName(dealt(strings.join(hot, "value", "left_semi"), length))


def dealt(strings: DataFrame, length: int) -> DataFrame:
    """:func:`repeated` by the windows' digests (128 bits), however many strings share a minimizer or a window."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(k, SHARD_STRINGS) for k in range(0, len(whole), SHARD_STRINGS)):
                texts = b.column(b.schema.get_field_index("string")).to_pylist()
                lens = np.array([len(x) for x in texts])
                n, start = lens - length + 1, np.cumsum(lens) - lens
                owner = np.repeat(np.arange(len(texts)), n)
                place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
                lo, values = start[owner] + place, byte_values(b"".join(texts))
                own = [b.column(b.schema.get_field_index(c)).to_numpy()[owner] for c in ("value", "digest", "low")]
                yield batch(WINDOW_SCHEMA, [*own, place.astype(np.int32), *(signed(range_hashes(v, lo, lo + length)) for v in (values, mixed(values)))])

    key = ["one", "two"]
    rows = strings.mapInArrow(windows, WINDOW_SCHEMA).withColumn("salt", F.pmod("digest", F.lit(SALTS)).cast("int"))
    first = rows.groupBy(*key, "salt").agg(F.min("low").alias("least"), F.count("*").alias("n"))
    least = first.groupBy(*key).agg(F.min("least").alias("least"), F.sum("n").alias("n")).filter("n > 1").drop("n")
    late = rows.join(first.select(*key, "salt").join(least, key), [*key, "salt"]).filter("least < low")
    run = F.flatten(F.collect_list(F.array(F.col("place").cast("long"), F.col("place") + F.lit(1).cast("long"), F.col("least"))))
    return late.groupBy("value", "digest").agg(run.alias("news"))


def merged(strings: DataFrame, length: int) -> DataFrame:
    """:func:`repeated` by interleave merges; all strings of a minimizer go into one."""

    def group(t: pa.Table) -> pa.Table:
        t = t.sort_by([("value", "ascending"), ("digest", "ascending")])
        value, low = t.column("value").to_numpy(), t.column("low").to_numpy()
        edges = np.append(np.flatnonzero(np.diff(value, prepend=value[0] - 1)), len(value))
        out, a = [], 0
        while a < len(edges) - 1:
            b = a + 1
            while b < len(edges) - 1 and edges[b + 1] - edges[a] <= MERGE_STRINGS:
                b += 1
            part = slice(int(edges[a]), int(edges[b]))
            minima = window_minima(t.column("string")[part].to_pylist(), low[part], length)
            for k, m in enumerate(minima, part.start):
                if (m < low[k]).any():
                    cut = np.append(np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]])), len(m))
                    runs = [x for f, e in zip(cut[:-1].tolist(), cut[1:].tolist()) if m[f] < low[k] for x in (f, e, int(m[f]))]
                    out.append((k, runs))
            a = b
        at = [k for k, _ in out]
        return pa.table({"value": pa.array(value[at]), "digest": pa.array(t.column("digest").to_numpy()[at]), "news": pa.array([r for _, r in out], pa.list_(pa.int64()))})

    buckets = max(1, -(-strings.count() // BUCKET_STRINGS))
    named = strings.withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)))
    return named.groupBy("bucket").applyInArrow(group, "value long, digest long, news array<bigint>")


def suffix_dedup(docs: DataFrame, length: int = 50) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept, spans`` for each row of ``doc_id, text``.

    A byte is removed if a ``length``-byte string covers it that also starts in a document with a smaller id; strings are
    judged on the input and lie within one document. ``kept`` holds the other bytes, ``spans`` first and past-the-last byte
    of each removed run. Null and empty texts have no bytes; texts shorter than ``length`` lose nothing. A null id comes
    after all others; rows that share an id remove nothing from each other. An empty input gives no row.
    """
    spec = Spec(length, min(GRAM, length), False)
    table = partitioned_packs(docs, "byte-packs", spec)
    found = recurring(table, spec, across=True)
    at, same = Window.partitionBy("value"), Window.partitionBy("value", "digest")
    here = F.struct("id", "pack", "entry")
    paths = stored(
        path_rows(table, found, spec).drop("place").withColumn("branches", F.min("digest").over(at) != F.max("digest").over(at))
        .withColumn("total", F.sum("n").over(at)).withColumn("low", F.min("id").over(at)).withColumn("owner", F.min(here).over(same))
        .filter("total > 1").select("value", "digest", "id", "pack", "entry", "n", "branches", "low", F.col("owner.id").alias("own"), (F.col("owner") == here).alias("leads")),
        "paths",
    )
    joined = table.join(found, "pack").select(*PACK, "found")
    leads = paths.filter("branches AND leads").groupBy("pack").agg(F.collect_list(F.struct("entry", "own")).alias("leads"))

    def strings(row: Row) -> Iterator[list[np.ndarray]]:
        u = spec.units(row["ids"], row["ends"], row["body"], row["extra"])
        p = spec.paths(u, np.sort(row["found"].astype(np.uint64)))
        leads = row["leads"]
        _, where = np.unique(p.entry, return_index=True)
        k = where[leads["entry"]]
        text = [u.body[a:b] for a, b in zip(p.lo[k].tolist(), (p.hi[k] + length - 1).tolist())]
        yield [signed(p.prints[k]), signed(p.digest[k]), leads["own"], text]

    rows = stored(per_pack(joined.join(leads, "pack"), STRING_SCHEMA, strings), "strings")
    intervals = stored(repeated(rows, length), "intervals")
    discard(rows)
    # a path that its pack has once, in the first document of all, loses nothing as a whole
    branching = paths.filter("branches").select("value", "digest", "pack", "entry", "own", ((F.col("own") < F.col("id")) | (F.col("n") > 1)).alias("late"))
    branching = branching.join(intervals, ["value", "digest"], "left").filter("late OR news IS NOT NULL")
    plain = paths.filter("NOT branches AND (low < id OR n > 1)").select("pack", "entry", F.col("low").alias("own"), F.lit(None).cast("array<bigint>").alias("news"))
    every = plain.unionByName(branching.select("pack", "entry", "own", "news"))
    news = every.groupBy("pack").agg(F.collect_list(F.struct("entry", "own", "news")).alias("told"))

    def cut(row: Row) -> Iterator[list[np.ndarray]]:
        u = spec.units(row["ids"], row["ends"], row["body"], row["extra"])
        base = np.concatenate([[0], u.ends])
        edge = np.zeros(len(u.values) + 1, np.int32)
        if (told := row["told"]) is not None:
            p = spec.paths(u, np.sort(row["found"].astype(np.uint64)))
            own = np.full(int(p.entry.max()) + 1, NO_ID)
            own[told["entry"]] = told["own"]
            ids = u.ids[p.doc]
            late = own[p.entry] < ids
            np.add.at(edge, p.lo[late], 1)
            np.add.at(edge, p.hi[late] + length - 1, -1)
            # runs of single windows: (from, to, smallest id) of each path that has some
            news = told["news"]
            many = np.zeros(len(own), np.int64)
            many[told["entry"]] = np.diff(news.offsets.to_numpy()) // 3
            first = np.zeros(len(own), np.int64)
            first[told["entry"]] = news.offsets.to_numpy()[:-1] - news.offsets[0].as_py()
            k = np.flatnonzero((many[p.entry] > 0) & ~late)
            n = many[p.entry[k]]
            flat, of = news.flatten().to_numpy(), np.repeat(k, n)
            at = np.repeat(first[p.entry[k]] - 3 * (np.cumsum(n) - n), n) + 3 * np.arange(n.sum())
            some = flat[at + 2] < ids[of]
            of, at = of[some], at[some]
            np.add.at(edge, p.lo[of] + flat[at], 1)
            np.add.at(edge, p.lo[of] + flat[at + 1] + length - 1, -1)
        gone = np.zeros(len(u.values) + 2, bool)
        gone[1:-1] = np.cumsum(edge[:-1], dtype=np.int32) > 0
        # a run is also cut where a document ends
        turn = np.flatnonzero(gone[1:] != gone[:-1])
        inner = base[1:-1][(gone[1:-1][base[1:-1] - 1] & gone[1:-1][np.minimum(base[1:-1], max(len(u.values) - 1, 0))])] if len(u.values) else base[:0]
        starts, stops = np.sort(np.concatenate([turn[::2], inner])), np.sort(np.concatenate([turn[1::2], inner]))
        lead = np.searchsorted(starts, base)
        out = [[], [], [], [], [], []]
        for k, i in enumerate(u.ids.tolist()):
            a, b = int(base[k]), int(base[k + 1])
            s, e = (starts[lead[k] : lead[k + 1]] - a).tolist(), (stops[lead[k] : lead[k + 1]] - a).tolist()
            kept = u.body[a:b] if not s else b"".join(u.body[a + x : a + y] for x, y in zip([0, *e], [*s, b - a]))
            for column, x in zip(out, (None if i == NO_ID else i, b - a, b - a - len(kept), len(s), kept, [x for span in zip(s, e) for x in span])):
                column.append(x)
        yield out

    return per_pack(table.join(found, "pack", "left").join(news, "pack", "left").select(*PACK, "found", "told"), OUT_SCHEMA, cut)
