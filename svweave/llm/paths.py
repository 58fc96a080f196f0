"""Paths of windows that share a minimizer: what operators 1 and 10 compare instead of single windows.

Each window of ``length`` units (words or bytes) chooses the smallest hash among its ``gram``-unit parts. Neighbouring
windows that choose the same place form a path. Equal windows choose equal parts, so a window can recur only where its
choice's fingerprint recurs: a first pass finds those fingerprints, a second compares the paths at them. A fingerprint at
which all paths of the corpus are equal doesn't branch, and its path is judged whole; at the others windows are compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import FORTY_EIGHT, byte_values, hashes_at, minimizers, mixed, packs, range_hashes, stored, stored_by, unpack, window_hashes, windows_inside, word_values, words_of


@dataclass
class Units:
    """A pack's words or bytes: hash of each, end of each document, ids; ``starts``/``stops``: a word's bytes.

    ``lo``, ``hi`` and ``at``: each path's windows and the place that they choose.
    """

    ids: np.ndarray
    body: bytes
    ends: np.ndarray
    values: np.ndarray
    starts: np.ndarray | None = None
    stops: np.ndarray | None = None
    lo: np.ndarray | None = None
    hi: np.ndarray | None = None
    at: np.ndarray | None = None


@dataclass(frozen=True)
class Spec:
    length: int
    gram: int
    words: bool

    def of(self, ids: np.ndarray, ends: np.ndarray, body: bytes) -> Units:
        if not self.words:
            return Units(ids, body, ends, byte_values(body))
        starts, stops, counts = words_of(body, ends)
        return Units(ids, body, counts, word_values(body, starts, stops), starts, stops)

    def bounds(self, ids: np.ndarray, ends: np.ndarray, body: bytes) -> bytes:
        """All paths of a pack, each as three small numbers: windows skipped before it, windows, place chosen after its start."""
        u = self.of(ids, ends, body)
        at = minimizers(window_hashes(u.values, self.gram), self.length - self.gram + 1)
        windows = np.flatnonzero(windows_inside(u.ends, self.length, len(at)))
        if not len(windows):
            return b""
        at = at[windows]
        parted = at[1:] != at[:-1]
        parted |= windows[1:] != windows[:-1] + 1  # documents too: no window reaches over an end
        first = np.flatnonzero(np.concatenate([[True], parted]))
        lo, hi = windows[first], windows[np.append(first[1:], len(windows)) - 1] + 1
        rows = np.stack([np.diff(lo, prepend=0) - np.concatenate([[0], (hi - lo)[:-1]]), hi - lo, at[first] - lo])
        size = 1 if rows.max() < 1 << 8 else 4
        return rows.astype(f"<u{size}").tobytes() + bytes([size])

    def units(self, ids: bytes, ends: bytes, body: bytes, extra: bytes) -> Units:
        ids, ends, body, extra = unpack(ids, ends, body, extra)
        u = self.of(ids, ends, body)
        rows = np.frombuffer(extra[:-1], f"<u{extra[-1] if extra else 1}").astype(np.int64).reshape(3, -1)
        u.hi = np.cumsum(rows[0] + rows[1])
        u.lo = u.hi - rows[1]
        u.at = u.lo + rows[2]
        return u

    def prints(self, u: Units) -> np.ndarray:
        """Fingerprint of the place that each path chooses."""
        return mixed(hashes_at(u.values, u.at, self.gram)) & FORTY_EIGHT

    def paths(self, u: Units, found: np.ndarray) -> Paths:
        """Paths at the fingerprints ``found`` (sorted)."""
        prints = self.prints(u)
        keep = np.isin(prints, found) if len(found) else np.zeros(len(prints), bool)
        lo, hi, prints = u.lo[keep], u.hi[keep], prints[keep]
        digest = range_hashes(u.values, lo, hi + self.length - 1)
        order = np.lexsort((digest, prints))
        entry = np.empty(len(order), np.int64)
        entry[order] = np.cumsum(fresh_rows(prints[order], digest[order])) - 1
        return Paths(lo, hi, prints, digest, np.searchsorted(u.ends, lo, "right"), entry)


@dataclass
class Paths:
    """Windows ``lo`` to ``hi`` of each path, its fingerprint, digest and document; ``entry`` numbers distinct paths."""

    lo: np.ndarray
    hi: np.ndarray
    prints: np.ndarray
    digest: np.ndarray
    doc: np.ndarray
    entry: np.ndarray


def fresh_rows(*columns: np.ndarray) -> np.ndarray:
    """Whether each row of sorted columns differs from the one before."""
    fresh = np.zeros(len(columns[0]), bool)
    fresh[:1] = True
    for c in columns:
        fresh[1:] |= c[1:] != c[:-1]
    return fresh


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64)


def batch(schema: str, columns: list[np.ndarray]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    names = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, names)], [n for n, _ in names])


class Row:
    """A row of an Arrow batch; binary values as bytes, lists as arrays, lists of structs as a dictionary of arrays."""

    def __init__(self, batch: pa.RecordBatch, k: int):
        self.batch, self.k = batch, k

    def __getitem__(self, name: str):
        value = self.batch.column(self.batch.schema.get_field_index(name))[self.k]
        if not value.is_valid:
            return None
        if not pa.types.is_list(value.type):
            return value.as_py()
        if pa.types.is_struct(value.type.value_type):
            kinds = value.type.value_type
            parts = {kinds.field(i).name: value.values.field(i) for i in range(kinds.num_fields)}
            return {n: x if pa.types.is_list(x.type) else x.to_numpy(zero_copy_only=False) for n, x in parts.items()}
        return value.values.to_numpy(zero_copy_only=False)


def per_pack(df: DataFrame, schema: str, f: Callable[[Row], Iterator[list[np.ndarray]] | list]) -> DataFrame:
    """``f`` on each row; it yields lists of columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(len(b)):
                for columns in f(Row(b, k)):
                    yield batch(schema, columns)

    return df.mapInArrow(run, schema)


PACK = ["pack", "ids", "ends", "body", "extra"]


def partitioned_packs(docs: DataFrame, name: str, spec: Spec) -> DataFrame:
    """Packs with their paths, stored by hash of their number, so that what joins them later moves and they don't."""
    return stored_by(packs(docs, spec.bounds), name, "pack", "none")


def recurring(table: DataFrame, spec: Spec, across: bool) -> DataFrame:
    """``pack, found``: the fingerprints of each pack that recur (``across``: in another document) in the whole corpus."""

    def prints(row: Row) -> Iterator[list[np.ndarray]]:
        u = spec.units(row["ids"], row["ends"], row["body"], row["extra"])
        value = spec.prints(u)
        if across:
            owner = u.ids[np.searchsorted(u.ends, u.at, "right")]
            order = np.lexsort((owner, value))
            value = value[order][fresh_rows(value[order], owner[order])]
            fresh = np.flatnonzero(fresh_rows(value))
        else:
            value = np.sort(value[fresh_rows(u.at)])
            fresh = np.flatnonzero(fresh_rows(value))
        count = np.diff(np.append(fresh, len(value)))
        yield [signed(value[fresh] * np.uint64(2) + (count > 1).astype(np.uint64)), np.full(len(fresh), row["pack"], np.int64)]

    rows = per_pack(table.select(*PACK), "print long, pack long", prints)
    rows = rows.select(F.shiftright("print", 1).alias("value"), (F.col("print").bitwiseAND(1) + 1).alias("n"), "pack")
    total = F.sum("n").over(Window.partitionBy("value"))
    often = rows.withColumn("total", total).filter("total > 1")
    return stored(often.groupBy("pack").agg(F.collect_list("value").alias("found")), "found")


PATH_SCHEMA = "value long, digest long, id long, place long, n int, pack long, entry int"


def path_rows(table: DataFrame, found: DataFrame, spec: Spec) -> DataFrame:
    """A row for each distinct path of each pack: where the pack has it first and how often (1 or 2)."""

    def rows(row: Row) -> Iterator[list[np.ndarray]]:
        u = spec.units(row["ids"], row["ends"], row["body"], row["extra"])
        p = spec.paths(u, np.sort(row["found"].astype(np.uint64)))
        if not len(p.lo):
            return
        place = p.lo - np.concatenate([[0], u.ends])[p.doc]
        order = np.lexsort((place, u.ids[p.doc], p.entry))
        lead = order[np.flatnonzero(np.diff(p.entry[order], prepend=-1))]
        count = np.minimum(np.bincount(p.entry), 2)
        yield [signed(p.prints[lead]), signed(p.digest[lead]), u.ids[p.doc[lead]], place[lead], count.astype(np.int32), np.full(len(lead), row["pack"], np.int64), p.entry[lead].astype(np.int32)]

    return per_pack(table.join(found, "pack").select(*PACK, "found"), PATH_SCHEMA, rows)


def judged_paths(rows: DataFrame) -> DataFrame:
    """Path rows that recur, with ``first`` (smallest id and place of the path) and ``branches``."""
    at = Window.partitionBy("value")
    return stored(
        rows.withColumn("low", F.min("digest").over(at)).withColumn("high", F.max("digest").over(at)).withColumn("total", F.sum("n").over(at))
        .withColumn("first", F.min(F.struct("id", "place")).over(at))
        .withColumn("branches", F.col("low") != F.col("high")).filter("total > 1")
        .select("value", "digest", "id", "place", "pack", "entry", "n", "first", "branches"),
        "paths",
    )
