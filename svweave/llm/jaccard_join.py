"""Operator 8, n-gram Jaccard join with set-relation skipping.

Sets of shingles are ordered by one global order, rare shingles first (a count sketch of fixed size tells the frequent ones, so
that passages which many texts share leave the prefixes), and index lists hold each set's prefix with the place in it. Equal sets are one class from the start. Lists are read
in blocks of set sizes, and blocks or entries whose sizes or places rule out the wanted overlap are skipped. A first round
verifies neighbours in the lists; sets that become connected need no further answer. In the second round pairs of sets in
different components remain. A component's hub answers first, from whole texts; the answers of a set ``x`` at the hub ``h``
are derived from them: ``|x & y| = |h & y| + |(x - h) & y| - |(h - x) & y|``, where only the two small differences are looked
up, and not even these where ``|h & y| + |x - h|`` is too little.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import NO_ID, PACK_BYTES, discard, doc_batches, hand_back_memory, mixed, range_hashes, stored, stored_by, word_values, words_of

SKETCH_BITS, SLICES = 22, 16
#: Bits of a shingle's value that are its hash; the ones above are its level.
HASH_BITS = 54
SET_SCHEMA = "doc_id long, n int, block int, d1 long, d2 long, s0 long, s1 long, s2 long, s3 long, wide binary, prefix array<bigint>, text_md5 binary, body binary"


def shingle_sets(texts: list[bytes], shingle: int, level: np.ndarray | None = None) -> list[np.ndarray]:
    """Sorted values of each text's distinct shingles; a shorter text is one, one without words none.

    A value is a hash; with ``level``, the shingle's own level stands above it, so that low levels come first.
    """
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    body = b"".join(texts).lower()
    starts, stops, counts = words_of(body, ends)
    values = word_values(body, starts, stops)
    first = np.concatenate([[0], counts[:-1]])
    n = counts - first
    number = np.where(n == 0, 0, np.maximum(n - shingle + 1, 1))
    owner = np.repeat(np.arange(len(texts)), number)
    lo = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number) + first[owner]
    hi = np.minimum(lo + shingle, counts[owner])
    h = range_hashes(values, lo, hi) >> np.uint64(64 - HASH_BITS)
    if level is not None:
        h |= level[counters(h)].astype(np.uint64) << np.uint64(HASH_BITS)
    return [np.unique(x) for x in np.split(h, np.cumsum(number)[:-1])]


def counters(h: np.ndarray) -> np.ndarray:
    """The counter of each shingle's hash in the sketch."""
    return (h >> np.uint64(HASH_BITS - SKETCH_BITS)).astype(np.int64)


def needed(a: Column, b: Column, percent: int) -> Column:
    """Smallest overlap of sets of sizes ``a`` and ``b`` that links them."""
    return F.ceil(percent * (a + b) / F.lit(100 + percent)).cast("long")


def size_blocks(percent: int) -> np.ndarray:
    """First sizes of the blocks: a set links with none outside its own block and the next ones on either side."""
    bounds = [1]
    while bounds[-1] < 1 << 31:
        bounds.append(bounds[-1] * 100 // percent + 1)
        if len(bounds) > 1 << 16:  # near 100 percent: blocks of single sizes at the start are enough for most
            break
    return np.array(bounds, np.int64)


def shingle_levels(docs: DataFrame, shingle: int) -> np.ndarray:
    """A level for each of ``2^SKETCH_BITS`` counters of shingles: 32 more for each doubling of the number of sets.

    Counts come from every document; the table has the same size for any corpus.
    """
    size = 1 << SKETCH_BITS
    width = size // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        total = np.zeros(size, np.int32)
        for _, texts in doc_batches(batches):
            at, many = np.unique(counters(np.concatenate(shingle_sets(texts, shingle))), return_counts=True)
            total[at] += many.astype(np.int32)
        press = zstandard.ZstdCompressor(level=1)
        for k in range(SLICES):
            if (part := total[k * width : (k + 1) * width]).any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([press.compress(part.astype("<i4").tobytes())])], ["slice", "counts"])
        del total, part
        hand_back_memory()

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        total = np.zeros(width, np.int64)
        for b in batches:
            for raw in b.column(b.schema.get_field_index("counts")).to_pylist():
                total += np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), "<i4")
        level = np.minimum(32 * np.log2(total + 1.0), 1023).astype("<u2")
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([level.tobytes()])], ["slice", "level"])

    sums = docs.mapInArrow(count, "slice int, counts binary").groupBy("slice").applyInArrow(add, "slice int, level binary")
    level = np.zeros(size, np.uint16)
    for k, raw in sums.collect():  # 2 * 2^SKETCH_BITS bytes
        level[k * width : (k + 1) * width] = np.frombuffer(raw, "<u2")
    return level


def set_table(docs: DataFrame, level: np.ndarray, shingle: int, percent: int) -> DataFrame:
    """Each row's set: size and its block, two digests, parity signatures, prefix in the global order; and its text, compressed.

    ``wide`` is a parity signature of as many bits as the set has shingles (the next power of two). Stored in buckets of rows.
    """
    levels, bounds = docs.sparkSession.sparkContext.broadcast(level), size_blocks(percent)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        import zstandard

        press, level = zstandard.ZstdCompressor(level=3), levels.value
        for ids, texts in doc_batches(batches):
            sets = shingle_sets(texts, shingle, level)
            n = np.array([len(s) for s in sets])
            flat, ends = np.concatenate(sets), np.cumsum(n)
            starts = ends - n
            digest = [range_hashes(v, starts, ends).view(np.int64) for v in (flat, mixed(flat))]
            owner = np.repeat(np.arange(len(sets)), n)
            odd = np.bincount(owner * 256 + (mixed(flat) & np.uint64(255)).astype(np.int64), minlength=256 * len(sets)).reshape(-1, 256)
            bits = np.packbits((odd & 1).astype(np.uint8), axis=1, bitorder="little").view("<i8")
            widths = 1 << np.maximum(6, np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
            base = np.cumsum(widths) - widths
            odd = np.bincount(base[owner] + (mixed(flat) & (widths[owner] - 1).astype(np.uint64)).astype(np.int64), minlength=int(widths.sum()))
            raw = np.packbits((odd & 1).astype(np.uint8), bitorder="little").tobytes()
            wide = [raw[a // 8 : (a + w) // 8] for a, w in zip(base.tolist(), widths.tolist())]
            length = n - (percent * n + 99) // 100 + 1
            prefix = [flat[a : a + k].view(np.int64) if m else flat[:0].view(np.int64) for a, k, m in zip(starts.tolist(), length.tolist(), n.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(n, pa.int32()), pa.array(np.searchsorted(bounds, n, "right"), pa.int32()), *(pa.array(d) for d in digest), *(pa.array(np.ascontiguousarray(bits[:, k])) for k in range(4)), pa.array(wide, pa.binary()), pa.array(prefix, pa.list_(pa.int64())), pa.array([hashlib.md5(t).digest() for t in texts]), pa.array([press.compress(t) for t in texts])],
                [f.split()[0] for f in SET_SCHEMA.split(", ")],
            )

    return stored_by(docs.mapInArrow(build, SET_SCHEMA).withColumn("row", F.monotonically_increasing_id()), "sets", "row", "none")


def alike(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of sizes ``na, nb`` that their wide signatures don't rule out: sets differ by as many shingles at least
    as their signatures do in bits, when the wider one is folded to the other's width."""
    names = pairs.columns
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("row").alias(side), F.col("wide").alias("w" + side)), side)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = b.column(b.schema.get_field_index("na")).to_numpy().astype(np.int64) + b.column(b.schema.get_field_index("nb")).to_numpy()
            most = both - 2 * -(-percent * both // (100 + percent))
            keep = np.zeros(len(b), bool)
            for k, (x, y) in enumerate(zip(b.column(len(names)), b.column(len(names) + 1))):
                x, y = sorted((np.frombuffer(v.as_py(), np.uint64) for v in (x, y)), key=len)
                keep[k] = np.bitwise_count(x ^ np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)).sum() <= most[k]
            yield b.select(names).filter(pa.array(keep))

    return pairs.select(*names, "wa", "wb").mapInArrow(check, pairs.select(*names).schema)


def sets_of(bodies: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """The set of each compressed text, about ``PACK_BYTES`` of texts at a time."""
    import zstandard

    texts, size = [], 0
    for raw in bodies:
        t = zstandard.ZstdDecompressor().decompress(raw.as_py())
        if texts and size + len(t) > PACK_BYTES:
            yield from shingle_sets(texts, shingle)
            texts, size = [], 0
        texts.append(t)
        size += len(t)
    if texts:
        yield from shingle_sets(texts, shingle)


def compared(pairs: DataFrame, texts: DataFrame, shingle: int, differences: bool = False) -> DataFrame:
    """``a, b, na, nb, overlap`` of each pair of rows ``a, b``, from their whole texts; the set of one ``a`` is built once.

    With ``differences``, ``more`` and ``less`` too: the values that ``b`` has and ``a`` hasn't, and the other way round.
    """
    pairs = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(64)).alias("part"))  # a hub's pairs go to many tasks
    right = pairs.join(texts.select(F.col("row").alias("b"), "body"), "b").select("a", "part", "b", "body")
    firsts = pairs.select("a", "part").distinct().join(texts.select(F.col("row").alias("a"), "body"), "a").select("a", "part", F.lit(None).cast("long").alias("b"), "body")
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "a long, b long, na long, nb long, overlap long" + (", more array<bigint>, less array<bigint>" if differences else "")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            out = []
            for a, b, s in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), sets_of(batch.column(3), shingle)):
                if b is None:
                    of, own = a, s
                    continue
                assert of == a, "the text of a pair's first row is missing"
                both = len(np.intersect1d(own, s, assume_unique=True))
                row = (a, b, len(own), len(s), both)
                out.append((*row, *(np.setdiff1d(x, y, assume_unique=True).view(np.int64) for x, y in ((s, own), (own, s)))) if differences else row)
            if out:
                kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 2
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], [f.split()[0] for f in schema.split(", ")])

    rows = firsts.unionByName(right).repartition(n, "a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return stored(rows.mapInArrow(count, schema), "overlaps")


def derived(pairs: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """``a, b, na, nb, overlap`` from a hub's answer ``known`` for ``b`` and ``more`` and ``less``, by which ``a`` differs from the hub."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for s, more, less in zip(sets_of(batch.column(7), shingle), batch.column(5), batch.column(6)):
                more, less = (x.values.to_numpy().view(np.uint64) for x in (more, less))
                found.append(len(np.intersect1d(s, more, assume_unique=True)) - len(np.intersect1d(s, less, assume_unique=True)))
            overlap = batch.column(4).to_numpy() + np.array(found, np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(4)), pa.array(overlap)], ["a", "b", "na", "nb", "overlap"])

    rows = pairs.join(texts.select(F.col("row").alias("b"), "body"), "b").select("a", "b", F.col("na").cast("long"), F.col("nb").cast("long"), "known", "more", "less", "body")
    return stored(rows.mapInArrow(count, "a long, b long, na long, nb long, overlap long"), "derived")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` (the smallest of each connected component) of edges ``a, b``: nodes hook to their smallest neighbour,
    the graph is contracted, and so on until no edge is left; each level is a stored table."""
    levels = []
    edges = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("up"))
        up = hook.select(F.col("node").alias("up"), F.col("up").alias("top"))
        level = stored(hook.join(up, "up").select("node", F.col("top").alias("root")), "level")
        levels.append(level)
        a, b = level.select(F.col("node").alias("a"), F.col("root").alias("ra")), level.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = edges.join(a, "a").join(b, "b").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).filter("a < b").distinct()
        edges = stored(edges, "edges")
    spark = edges.sparkSession
    out = levels[0] if levels else spark.createDataFrame([], "node long, root long")
    for level in levels[1:]:
        out = out.join(level.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return stored(out, "components")


def partnered(entries: DataFrame, percent: int) -> DataFrame:
    """``row, place, token`` of the entries ``row, n, place, token`` that may meet another one of their token's list.

    Sets that link are of like sizes, and what follows an entry's place must suffice for the larger one: the neighbours by size tell
    whether any set of the list is of such a size. Most lists of two or three sets hold none, and nothing else of a set moves here.
    """
    n, by_size = F.col("n").cast("long"), Window.partitionBy("token").orderBy("n")
    smaller = F.lag(n).over(by_size) * 100 >= n * percent
    larger = (n + F.lead(n).over(by_size)) * percent <= (n - F.col("place")) * (100 + percent)
    return entries.withColumn("_met", F.coalesce(smaller, F.lit(False)) | F.coalesce(larger, F.lit(False))).filter("_met").select("row", "place", "token")


def jaccard_join(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, text_md5`` for each row of ``doc_id, text``: links are sets with
    ``100 * |x & y| >= percent * |x | y|``, components the rows that links reach, named by their smallest id.

    A-Z is lower-cased; fewer words than a shingle are one shingle; null and empty texts have no shingles and no links. A null
    id counts as the largest and comes back as null. Rows that share an id are nodes of their own. ``kept`` marks one row of
    each component: the smallest id's, any one of those that share it. An empty input gives no row.
    """
    sets = set_table(docs, shingle_levels(docs, shingle), shingle, percent)
    key = ["d1", "d2", "n"]
    classes = stored(sets.filter("n > 0").groupBy(*key).agg(F.min("row").alias("rep")), "classes")
    marks = ["n", "block", "s0", "s1", "s2", "s3"]
    reps = sets.join(classes.select(F.col("rep").alias("row")), "row", "left_semi")
    lists = stored(partnered(reps.select("row", "n", F.posexplode("prefix").alias("place", "token")), percent).join(sets.select("row", *marks), "row"), "lists")

    def fits(a: str, b: str) -> Column:
        """Neither sizes nor places rule the pair out; a skipped pair's first common token says the same elsewhere."""
        na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
        return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (F.least(na - F.col(f"{a}.place"), nb - F.col(f"{b}.place")) >= needed(na, nb, percent))

    def apart(a: str, b: str) -> Column:
        """Shingles that one set has and the other hasn't are at least the bits in which their parity signatures differ."""
        bits = [F.bit_count(F.col(f"{a}.s{k}").bitwiseXOR(F.col(f"{b}.s{k}"))) for k in range(4)]
        na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
        return bits[0] + bits[1] + bits[2] + bits[3] <= na + nb - 2 * needed(na, nb, percent)

    # round 1: neighbours in each list by size, and by signature, where near copies stand together
    entry = F.struct("row", "place", *marks)
    before = [F.lag(entry).over(Window.partitionBy("token", "block").orderBy(*by, "row")) for by in (["n"], ["s0", "s1"], ["s2", "s3"])]
    near = lists.select("token", "block", entry.alias("y"), *(w.alias(f"x{k}") for k, w in enumerate(before)))
    near = near.select(F.explode(F.array("x0", "x1", "x2")).alias("x"), "y").filter(F.col("x").isNotNull())
    a_first = F.col("x.row") < F.col("y.row")
    near = near.filter(fits("x", "y") & apart("x", "y")).select(*(F.when(a_first, F.col(f"{p}.{c}")).otherwise(F.col(f"{q}.{c}")).alias(n) for p, q, c, n in (("x", "y", "row", "a"), ("y", "x", "row", "b"), ("x", "y", "n", "na"), ("y", "x", "n", "nb"))))
    first = linked(compared(alike(near.distinct(), sets, percent), sets, shingle), percent)
    found = components(first)

    # round 2: pairs whose components differ; all pairs of a list but those within its commonest component
    label = found.select(F.col("node").alias("row"), F.col("root").alias("hub"))
    known = stored(lists.join(label, "row", "left").withColumn("hub", F.coalesce("hub", "row")), "known")
    discard(lists)
    hubs = known.groupBy("token", "hub").agg(F.count("*").alias("many"))
    main = hubs.groupBy("token").agg(F.max(F.struct("many", "hub")).alias("most"), F.count("*").alias("hubs")).filter("hubs > 1").select("token", F.col("most.hub").alias("main"))
    mixed_lists = stored(known.join(main, "token"), "mixed")
    discard(known)
    one = F.struct("row", "place", "hub", *marks)
    x = mixed_lists.filter("hub <> main").select("token", F.explode(F.array(*(F.col("block") + k for k in (-1, 0, 1)))).alias("block"), one.alias("x"))
    y = mixed_lists.select("token", "block", one.alias("y"), (F.col("hub") == F.col("main")).alias("common"))
    once = F.col("common") | (F.col("x.row") < F.col("y.row"))
    cross = x.join(y, ["token", "block"]).filter(once & (F.col("x.hub") != F.col("y.hub")) & fits("x", "y") & apart("x", "y"))
    cross = cross.select(F.col("x.row").alias("a"), F.col("y.row").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb"), F.col("x.hub").alias("h")).distinct()
    cross = stored(alike(cross, sets, percent), "cross")
    discard(mixed_lists)
    told = compared(cross.select(F.col("h").alias("a"), "b").distinct(), sets, shingle)
    told = told.select(F.col("a").alias("h"), "b", F.col("overlap").alias("known"))
    unlike = compared(cross.filter("a <> h").select(F.col("h").alias("a"), F.col("a").alias("b")).distinct(), sets, shingle, differences=True)
    unlike = unlike.select(F.col("a").alias("h"), F.col("b").alias("a"), "more", "less")
    answered = cross.join(told, ["h", "b"])
    direct = answered.filter("a = h").select("a", "b", "na", "nb", F.col("known").alias("overlap"))
    open_ = answered.filter("a <> h").join(unlike, ["h", "a"]).filter(F.col("known") + F.size("more") >= needed(F.col("na"), F.col("nb"), percent))
    second = linked(direct.unionByName(derived(open_, sets, shingle)), percent)
    discard(cross)
    final = components(first.unionByName(second)) if not second.isEmpty() else found

    # back to every row
    named = sets.select("row", "doc_id", "n", "d1", "d2", "text_md5").join(classes, key, "left").withColumn("rep", F.coalesce("rep", "row"))
    named = named.join(final.select(F.col("node").alias("rep"), "root"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    named = named.select("row", "doc_id", "n", "text_md5", "root", F.pmod(F.xxhash64("row"), F.lit(64)).alias("salt"))
    part = named.groupBy("root", "salt").agg(F.min(F.struct("doc_id", "row")).alias("low"))
    names = part.join(part.groupBy("root").agg(F.min("low").alias("first")), "root").select("root", "salt", "first")
    no_id = F.lit(NO_ID)
    return named.join(names, ["root", "salt"]).select(
        F.nullif("doc_id", no_id).alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.nullif("first.doc_id", no_id).alias("component_id"), (F.col("row") == F.col("first.row")).alias("kept"), "text_md5"
    )


def linked(pairs: DataFrame, percent: int) -> DataFrame:
    return stored(pairs.filter(F.col("overlap") * (100 + percent) >= percent * (F.col("na") + F.col("nb"))).select("a", "b"), "links")
