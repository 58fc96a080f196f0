"""Operator 12, hard-negative mining by coordinate pruning over length buckets.

Rows, sorted by label and length, are cut into buckets that hold their normalised vectors and, for each coordinate, the rows in
order of it. An anchor with a score to reach asks a bucket only if the bucket's longest vector could reach it; there, the angle
that the score allows gives a range of values for each of the anchor's largest coordinates (its focus), the ranges are cut
from the sorted lists, and rows in all of them are verified exactly. The first pass finds each anchor's positives, with its
own bucket giving the score to reach; the second finds negatives inside each positive's window of scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored
from .top_k import EASE, _best, _matrix, _scores

#: Rows of a bucket, buckets that a task reads together, coordinates of an anchor's focus.
BUCKET_ROWS, SPAN_BUCKETS, FOCUS = 2048, 8, 4
#: Anchors that ask together: a sixteenth of them within these bounds.
CHUNK_ANCHORS = (64, 4096)

BUCKET_SCHEMA = "bucket long, span long, longest double, labels array<long>, ids binary, tags binary, vecs binary, lists binary"
CHUNK_SCHEMA = "chunk long, least double, labels array<long>, anchors array<struct<anchor:long,label:long,q:binary,reach:double,aims:array<long>>>"


def labelled_vectors(df: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """``id, label, vec, length`` of the rows that take part."""
    plain = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).alias("raw"))
    fine = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    vec = F.transform("raw", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = plain.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & fine).select("id", "label", vec.alias("vec"))
    return rows.withColumn("length", F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x)))


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length 1 (zero rows stay zero), and their lengths."""
    x = x.astype(np.float64)
    length = np.sqrt((x * x).sum(1))
    return x / np.where(length > 0, length, 1.0)[:, None], length


def build_buckets(rows: DataFrame, dim: int) -> DataFrame:
    """Stored buckets of ``rows`` (``id, label, vec``): neighbours by label and length, at most ``BUCKET_ROWS`` each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held = TaskContext.get().partitionId() << 32, []

        def bucket(t: pa.Table) -> pa.RecordBatch:
            nonlocal number
            x = _matrix(t.column("vec").combine_chunks(), dim)
            unit, length = _unit(x)
            ids, labels = (t.column(c).to_numpy() for c in ("id", "label"))
            lists = np.argsort(unit, axis=0, kind="stable").T.astype(np.uint16)
            values = [number, number // SPAN_BUCKETS, float(length.max()), np.unique(labels), ids.tobytes(), labels.tobytes(), x.tobytes(), lists.tobytes()]
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int64()), *[pa.binary()] * 4]
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], BUCKET_SCHEMA.replace(",", "").split()[::2])

        for b in batches:
            held.append(b)
            while sum(map(len, held)) >= BUCKET_ROWS:
                t = pa.Table.from_batches(held)
                yield bucket(t.slice(0, BUCKET_ROWS))
                held = t.slice(BUCKET_ROWS).to_batches()
        if sum(map(len, held)):
            yield bucket(pa.Table.from_batches(held))

    ordered = rows.repartitionByRange("label", "length", "id").sortWithinPartitions("label", "length", "id")
    return stored(ordered.select("id", "label", "vec").mapInArrow(cut, BUCKET_SCHEMA), "buckets")


class Bucket:
    """A bucket's rows as arrays, with the candidates that an anchor's score to reach leaves."""

    def __init__(self, row: dict, dim: int) -> None:
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["tags"], np.int64)
        self.x, self.longest = np.frombuffer(row["vecs"], np.int64).reshape(-1, dim), row["longest"]
        self.lists = np.frombuffer(row["lists"], np.uint16).reshape(dim, -1)
        self.unit = _unit(self.x)[0]
        self.sorted: dict[int, np.ndarray] = {}

    def candidates(self, q: np.ndarray, reach: float) -> np.ndarray:
        """Rows whose inner product with ``q`` may be ``reach`` or more."""
        length = float(np.sqrt((q * q).sum()))
        if reach <= 0 or not length or not self.longest:
            return np.arange(len(self.ids)) if reach <= 0 else np.zeros(0, np.int64)
        cosine = reach / (length * self.longest) * (1 - EASE) - EASE
        if cosine > 1:
            return np.zeros(0, np.int64)
        angle, unit = np.arccos(np.clip(cosine, -1, 1)), q / length
        times = np.zeros(len(self.ids), np.uint8)
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS].tolist()
        for f in focus:
            if f not in self.sorted:
                self.sorted[f] = self.unit[self.lists[f], f]
            own = np.arccos(np.clip(unit[f], -1, 1))
            lo, hi = np.cos(min(np.pi, own + angle)) - EASE, np.cos(max(0.0, own - angle)) + EASE
            times[self.lists[f][np.searchsorted(self.sorted[f], lo, "left") : np.searchsorted(self.sorted[f], hi, "right")]] += 1
        return np.flatnonzero(times == len(focus))

    def verified(self, q: np.ndarray, reach: float, fits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the rows among ``fits`` that reach ``reach``."""
        at = self.candidates(q.astype(np.float64), reach)
        at = at[fits[at]]
        scores = _scores(q[None], self.x[at])[0] if len(at) else np.zeros(0, np.int64)
        good = scores >= reach
        return scores[good], self.ids[at][good]


def _found(rows: list[tuple[int, int, np.ndarray, np.ndarray]]) -> pa.Table:
    """``anchor, aim, id, score`` of each anchor's best ones for each of its aims."""
    none = np.zeros(0, np.int64)
    rows = [(none, none, none, none), *((np.full(len(s), a), np.full(len(s), k), i, s) for a, k, i, s in rows)]
    return pa.table({n: pa.array(np.concatenate(c), pa.int64()) for n, c in zip(("anchor", "aim", "id", "score"), zip(*rows))})


FOUND_SCHEMA = "anchor long, aim long, id long, score long"


def _chunks(asked: DataFrame, n: int) -> DataFrame:
    """Stored chunks of anchors, neighbours by label and by the length of a vector that reaches their score.

    ``asked`` has ``anchor, label, q, reach, aims``; ``least`` is a vector's length below which it reaches no score of the chunk.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held = TaskContext.get().partitionId() << 32, []

        def chunk(rows: list[dict]) -> pa.RecordBatch:
            nonlocal number
            values = [number, min(r.pop("least") for r in rows), sorted({r["label"] for r in rows}), rows]
            number += 1
            anchors = pa.list_(pa.struct([("anchor", pa.int64()), ("label", pa.int64()), ("q", pa.binary()), ("reach", pa.float64()), ("aims", pa.list_(pa.int64()))]))
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, (pa.int64(), pa.float64(), pa.list_(pa.int64()), anchors))], ["chunk", "least", "labels", "anchors"])

        for b in batches:
            held += b.to_pylist()
            while len(held) >= n:
                yield chunk(held[:n])
                held = held[n:]
        if held:
            yield chunk(held)

    ordered = asked.repartitionByRange("label", "least", "anchor").sortWithinPartitions("label", "least", "anchor")
    return stored(ordered.select("anchor", "label", "q", "reach", "aims", "least").mapInArrow(cut, CHUNK_SCHEMA), "chunks")


def _search(asked: DataFrame, n: int, buckets: DataFrame, same: bool, low: int, high: int, most: int, dim: int) -> DataFrame:
    """``anchor, aim, id, score``: the ``most`` best rows of an anchor's own label, or of other labels for each aim.

    An aim is a positive's score, whose negatives lie between ``low`` and ``high`` percent of it; among rows of the own label
    there is one aim without bounds.
    """
    chunks = _chunks(asked.withColumn("least", F.when((F.col("reach") > 0) & (F.col("qlength") > 0), F.col("reach") / F.col("qlength") * (1 - EASE)).otherwise(0.0)), n)
    spans = buckets.select("span", "longest", F.explode("labels").alias("label")).groupBy("span").agg(F.max("longest").alias("longest"), F.collect_set("label").alias("held"))
    heads = chunks.select("chunk", "least", "labels")
    if same:
        sides = heads.select("chunk", "least", F.explode("labels").alias("label")).join(spans.select("span", "longest", F.explode("held").alias("label")), "label")
        visits = sides.filter("longest >= least").select("chunk", "span").distinct()
    else:
        other = (F.size("labels") > 1) | (F.size("held") > 1) | (F.col("labels")[0] != F.col("held")[0])
        visits = heads.join(spans, (F.col("longest") >= F.col("least")) & other).select("chunk", "span")
    visits = stored(visits, "visits")
    left = chunks.select("chunk", "anchors").join(visits, "chunk")
    right = buckets.join(visits, "span").select(F.col("chunk").alias("part"), F.col("span").alias("at"), "longest", "ids", "tags", "vecs", "lists")

    def expand(_key, left: pa.Table, right: pa.Table) -> pa.Table:
        """Anchors of one chunk on the buckets of one span, longest first; what an anchor has found raises the score to reach."""
        if not len(left) or not len(right):
            return _found([])
        there = sorted((Bucket(r, dim) for r in right.to_pylist()), key=lambda b: -b.longest)
        out = []
        for a in left.column("anchors")[0].as_py():
            q, aims = np.frombuffer(a["q"], np.int64), a["aims"]
            bounds = [(None, None)] if same else [(low * s, high * s) for s in aims]
            best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(bounds)
            reach = a["reach"]
            for b in there:
                fits = (b.labels == a["label"]) == same
                scores, ids = b.verified(q, reach, fits & (b.ids != a["anchor"]))
                if not len(scores):
                    continue
                for k, (lo, hi) in enumerate(bounds):
                    ok = slice(None) if same else (100 * scores >= lo) & (100 * scores <= hi)
                    best[k] = _best(np.concatenate([best[k][0], scores[ok]]), np.concatenate([best[k][1], ids[ok]]), most)
                held = [float(s[-1]) if len(s) == most else -np.inf for s, _ in best]
                reach = max(reach, min(max(h, -np.inf if same else lo / 100) for h, (lo, _) in zip(held, bounds)))
            out += [(a["anchor"], k, ids, scores) for k, (scores, ids) in enumerate(best) if len(ids)]
        return _found(out)

    found = left.groupBy("chunk", "span").cogroup(right.groupBy("part", "at")).applyInArrow(expand, FOUND_SCHEMA)
    rank = F.row_number().over(Window.partitionBy("anchor", "aim").orderBy(F.col("score").desc(), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= most)


def mine(df: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", scale: int = 256) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for anchors, rows whose id divides by ``every``.

    Components become ``floor(scale * component)`` and scores are integer inner products; higher ones come first, ties go to
    smaller ids. An anchor's positives are its first ``positives`` other rows of its label; a positive's negatives are the
    first ``negatives`` rows of other labels whose score times 100 lies between ``low`` and ``high`` times the positive's score.
    Rows without an id, a label or a vector, or with a null or non-finite component, take no part; shorter vectors count as
    padded with zeros, empty ones are zeros. Of rows that repeat an anchor's id one asks (smallest label, then vector) and none
    is its candidate; elsewhere repeated rows count each. An empty table gives no rows.
    """
    rows = labelled_vectors(df, id_col, vec_col, label_col, scale)
    dim = max(rows.agg(F.max(F.size("vec"))).first()[0] or 0, 1)
    buckets = build_buckets(rows, dim)

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Anchors of a bucket, each with the score that its own bucket's rows of its label prove."""
        for b in batches:
            for row in b.to_pylist():
                ids, labels, x = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["tags"], np.int64), np.frombuffer(row["vecs"], np.int64).reshape(-1, dim)
                out = []
                for k in np.flatnonzero(ids % every == 0).tolist():
                    own = np.sort(_scores(x[k : k + 1], x[(labels == labels[k]) & (ids != ids[k])])[0])
                    out.append((int(ids[k]), int(labels[k]), x[k].tobytes(), float(own[-positives]) if len(own) >= positives else -np.inf, float(_unit(x[k : k + 1])[1][0])))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary(), pa.float64(), pa.float64()))], ["anchor", "label", "q", "reach", "qlength"])

    seeds = buckets.select("ids", "tags", "vecs").mapInArrow(seed, "anchor long, label long, q binary, reach double, qlength double")
    asked = stored(seeds.groupBy("anchor").agg(F.min(F.struct("label", "q", "reach", "qlength")).alias("s")).select("anchor", "s.*"), "asked")
    n = min(max(asked.count() // 16, CHUNK_ANCHORS[0]), CHUNK_ANCHORS[1])
    none = F.array().cast("array<long>")
    near = stored(_search(asked.withColumn("aims", none), n, buckets, True, low, high, positives, dim), "positives")
    # a positive whose window is empty (a negative score) aims at nothing
    aims = near.filter(F.col("score") * low <= F.col("score") * high).groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("found"))
    aimed = asked.drop("reach").join(aims, "anchor").withColumn("aims", F.transform("found", lambda s: s["score"])).withColumn("reach", F.array_min("aims") * low / 100)
    far = _search(aimed, n, buckets, False, low, high, negatives, dim)
    pairs = far.select("anchor", "aim", "rank", "id", F.col("score").alias("negative_score")).join(aims, "anchor").withColumn("p", F.col("found")[F.col("aim").cast("int")])
    return pairs.select(F.col("anchor").alias("anchor_id"), F.col("p")["id"].alias("positive_id"), "rank", F.col("id").alias("negative_id"), F.col("p")["score"].alias("positive_score"), "negative_score")
