"""Operator 7, exact top-k search over a pivot-distance index.

Largest inner product becomes smallest distance by one more coordinate, ``sqrt(M^2 - |x|^2)`` with ``M`` the longest
vector's length. Each vector is keyed by its nearest pivot and its distance to it; a pivot's vectors, sorted by distance,
are cut into annuli, stored as blocks. A query first searches the annulus it lies in, which bounds its k-th distance; then
it visits only annuli that meet its ball (triangle inequality on the pivot's distances), nearest first, and stops when
none left can improve on what it holds. Pivots alone are fitted on a bounded sample; every vector is indexed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

SAMPLE_ROWS, CELL_ROWS, RING_ROWS, QUERY_CHUNK = 4096, 2048, 256, 1024
#: Pivots at least and at most: about a quarter of the square root of the number of vectors.
PIVOTS = (32, 512)
#: Neighbouring cells of a pivot that are looked at together before single ones.
SPAN_CELLS = 256
EXACT = float(1 << 53)
#: Share by which a bound is eased, above the rounding of distances in double precision.
EASE = 1e-9


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``id, vec`` with ``floor(scale * component)``; rows without an id or with a null or non-finite component are left out."""
    fine = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    vec = F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias(vec_col)).filter(F.col("id").isNotNull() & fine).select("id", vec.alias("vec"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows padded with zeros to ``dim`` components."""
    lens = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy().astype(np.int64)
    if dim and (lens == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(lens), dim), np.int64)
    out[np.repeat(np.arange(len(lens)), lens), np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)] = flat
    return out


def _lifted(x: np.ndarray, top: float) -> np.ndarray:
    x = x.astype(np.float64)
    return np.concatenate([x, np.sqrt(np.maximum(top - (x * x).sum(1), 0.0))[:, None]], 1)


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (p * p).sum(1)[None] - 2 * x @ p.T, 0.0))


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles while none can exceed 2^53."""
    if q.size and x.size and float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < EXACT:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest scores, ties to smaller ids."""
    at = np.lexsort((ids, -scores))[:k]
    return scores[at], ids[at]


def fit_pivots(vectors: DataFrame, dim: int, top: float, most: int) -> np.ndarray:
    """Farthest-first pivots of at most ``SAMPLE_ROWS`` rows with the smallest hashes of their ids."""
    rows = vectors.select("id", "vec").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("vec").toArrow()
    x = _lifted(_matrix(rows.column(0).combine_chunks(), dim), top)
    chosen = [0]
    far = _distances(x, x[:1])[:, 0]
    while len(chosen) < min(most, len(x)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, _distances(x, x[chosen[-1:]])[:, 0])
    return x[chosen]


CELL_SCHEMA = "cell long, pivot int, lo double, hi double, n int, ids binary, dist binary, vecs binary"


def build_index(vectors: DataFrame, pivots: np.ndarray, dim: int, top: float) -> DataFrame:
    """Stored cells: neighbouring vectors of a pivot by distance, at most ``CELL_ROWS`` each."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1), dim)
            if len(x):
                d = _distances(_lifted(x, top), pivots)
                near = d.argmin(1)
                yield pa.RecordBatch.from_arrays([pa.array(near, pa.int32()), pa.array(d[np.arange(len(x)), near]), b.column(0), pa.array([v.tobytes() for v in x], pa.binary())], ["pivot", "dist", "id", "vec"])

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held = TaskContext.get().partitionId() << 32, []

        def cut(rows: list[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal number, held
            t = pa.Table.from_batches(rows).combine_chunks()
            pivot = t.column("pivot").to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(np.diff(pivot)) + 1, [len(pivot)]])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                while a < b:
                    c = min(b, a + CELL_ROWS)
                    if c == len(pivot) and not last and c - a < CELL_ROWS:
                        break
                    d, ids = t.column("dist").to_numpy()[a:c], t.column("id").to_numpy()[a:c]
                    raw = b"".join(t.column("vec").slice(a, c - a).to_pylist())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number]), pa.array([int(pivot[a])], pa.int32()), pa.array([d.min()]), pa.array([d.max()]), pa.array([c - a], pa.int32()), pa.array([ids.tobytes()]), pa.array([d.tobytes()]), pa.array([raw])],
                        ["cell", "pivot", "lo", "hi", "n", "ids", "dist", "vecs"],
                    )
                    number, a = number + 1, c
                if a < b:
                    held = t.slice(a).to_batches()

        size = 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= 4 * CELL_ROWS:
                rows, held = held, []
                yield from cut(rows, False)
                size = sum(map(len, held))
        if held:
            yield from cut(held, True)

    keyed = vectors.mapInArrow(key, "pivot int, dist double, id long, vec binary")
    return stored(keyed.repartitionByRange("pivot", "dist", "id").sortWithinPartitions("pivot", "dist", "id").mapInArrow(cells, CELL_SCHEMA), "cells")


def search(df: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest integer inner products of each row whose id divides by ``every``.

    A query's own id is no candidate; all others are, ties go to smaller ids, and equal vectors are all candidates. Vectors
    that are null or hold null or non-finite components, and rows without an id, take no part; shorter vectors count as
    padded with zeros. Rows that repeat a query's id ask once, with the smallest of their vectors; as candidates each counts.
    An empty table gives no rows; empty vectors are vectors of zeros.
    """
    vectors = integer_vectors(df, id_col, vec_col, scale)
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    dim, top, n = vectors.agg(F.max(F.size("vec")), F.max(square), F.count("*")).first()
    if dim is None:
        return vectors.select(F.col("id").alias("query_id"), F.lit(0).cast("int").alias("rank"), F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("score"))
    k_best, dim = k, max(dim, 1)  # empty vectors are vectors of zeros
    pivots = fit_pivots(vectors, dim, top, min(PIVOTS[1], max(PIVOTS[0], int(n**0.5 / 4))))
    index = build_index(vectors, pivots, dim, top)

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query with its distances to the pivots and the radius that its own annulus proves."""
        for b in batches:
            for ids, vecs in zip(b.column("ids").to_pylist(), b.column("vecs").to_pylist()):
                ids, x = np.frombuffer(ids, np.int64), np.frombuffer(vecs, np.int64).reshape(-1, dim)
                at = np.flatnonzero(ids % every == 0)
                if not len(at):
                    continue
                q, s = x[at], _scores(x[at], x)
                d, out = _distances(_lifted(q, top) * ([1.0] * dim + [0.0]), pivots), []
                for row, i in enumerate(ids[at].tolist()):
                    others = np.sort(s[row][ids != i])
                    length = float((q[row].astype(np.float64) ** 2).sum())
                    r = np.sqrt(max(length + top - 2.0 * others[-k], 0.0)) if len(others) >= k else np.inf
                    out.append((i, q[row].tobytes(), r * (1 + EASE) + EASE, d[row].tolist()))
                c = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.int64()), pa.array(c[1], pa.binary()), pa.array(c[2], pa.float64()), pa.array(c[3], pa.list_(pa.float64()))], ["query", "q", "r", "d"])

    asked = index.select("ids", "vecs").mapInArrow(seed, "query long, q binary, r double, d array<double>")
    asked = stored(asked.groupBy("query").agg(F.min(F.struct("q", "r", "d")).alias("s")).select("query", "s.*"), "asked")
    chunks = max(1, -(-asked.count() // QUERY_CHUNK))
    # a pivot's cells in order of distance, some together as one row: a query meets few of these and then only their cells in reach
    nth = F.floor((F.row_number().over(Window.partitionBy("p").orderBy("lo", "cell")) - 1) / SPAN_CELLS)
    spans = index.select(F.col("pivot").alias("p"), "cell", "lo", "hi").withColumn("span", nth)
    spans = spans.groupBy("p", "span").agg(F.min("lo").alias("low"), F.max("hi").alias("high"), F.collect_list(F.struct("cell", "lo", "hi")).alias("cells"))
    reach = (F.col("low") <= F.col("dist") + F.col("r")) & (F.col("high") >= F.col("dist") - F.col("r"))
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64("query"), F.lit(chunks)))
    visits = asked.select("query", "r", "chunk", F.posexplode("d").alias("p", "dist")).join(spans, "p").filter(reach)
    near = F.filter("cells", lambda c: (c["lo"] <= F.col("dist") + F.col("r")) & (c["hi"] >= F.col("dist") - F.col("r")))
    visits = stored(visits.select("query", "chunk", "dist", F.explode(F.transform(near, lambda c: c["cell"])).alias("cell")), "visits")
    # only cells that some query of a chunk visits move, once for the chunk
    held = index.select("cell", "ids", F.col("dist").alias("rings"), "vecs").join(visits.select("cell", "chunk").distinct(), "cell").select(F.col("cell").alias("at"), F.col("chunk").alias("part"), "ids", "rings", "vecs")
    visits = visits.join(asked.select("query", "q", "r"), "query").select("cell", "chunk", "query", "q", "r", "dist")

    def expand(_key, left: pa.Table, right: pa.Table) -> pa.Table:
        """Queries of one chunk on one cell. Each looks at annuli of ``RING_ROWS`` vectors, nearest first, and ends where none can
        hold a better one; scores are computed for the queries that have come to an annulus, together."""
        none = np.zeros(0, np.int64)
        out = [(none, none, none)]
        if len(left) and len(right):
            ids, dist = (np.frombuffer(right.column(c)[0].as_py(), t) for c, t in (("ids", np.int64), ("rings", np.float64)))
            x = np.frombuffer(right.column("vecs")[0].as_py(), np.int64).reshape(-1, dim)
            cuts = np.append(np.arange(0, len(ids), RING_ROWS), len(ids))
            lo, hi = np.minimum.reduceat(dist, cuts[:-1]), np.maximum.reduceat(dist, cuts[:-1])
            q = np.stack([np.frombuffer(v, np.int64) for v in left.column("q").to_pylist()])
            query, r, d = (left.column(c).to_numpy().copy() for c in ("query", "r", "dist"))
            length = (q.astype(np.float64) ** 2).sum(1)
            gap = np.maximum(np.maximum(lo - d[:, None], d[:, None] - hi), 0.0)
            order = np.argsort(gap, axis=1, kind="stable")
            best_s, best_i = [none] * len(q), [none] * len(q)
            for step in range(len(lo)):
                ring = order[:, step]
                live = np.flatnonzero(gap[np.arange(len(q)), ring] <= r)
                if not len(live):
                    break
                for k in np.unique(ring[live]).tolist():
                    rows, part = live[ring[live] == k], slice(int(cuts[k]), int(cuts[k + 1]))
                    for row, s in zip(rows.tolist(), _scores(q[rows], x[part])):
                        own = ids[part] != query[row]
                        best_s[row], best_i[row] = _best(np.concatenate([best_s[row], s[own]]), np.concatenate([best_i[row], ids[part][own]]), k_best)
                        if len(best_s[row]) == k_best:
                            r[row] = min(r[row], np.sqrt(max(length[row] + top - 2.0 * best_s[row][-1], 0.0)) * (1 + EASE) + EASE)
            out += [(np.full(len(s), query[row]), best_i[row], s) for row, s in enumerate(best_s)]
        return pa.table({n: pa.array(np.concatenate(c), pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), zip(*out))})

    found = visits.groupBy("cell", "chunk").cogroup(held.groupBy("at", "part")).applyInArrow(expand, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
