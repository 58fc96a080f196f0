"""Operator 1, substring dedup by De Bruijn compaction of word windows.

The corpus is a graph whose edges are windows of ``length`` words. Edges that share a minimizer form paths; a Spark window
over the minimizer shows where every document follows the same path: such a path doesn't branch and is one compacted edge.
Where paths branch they are split into their edges again, and a second pass over the edges' digests finds each one's first
source coordinate (document, place). Back in the documents, words under edges that start earlier elsewhere are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import NO_ID, mixed, range_hashes, stored
from .paths import PACK, Row, Spec, judged_paths, partitioned_packs, path_rows, per_pack, recurring, signed

GRAM = 8
EDGE_SCHEMA = "edge long, second long, id long, place long, pack long, slot int"
OUT_SCHEMA = "doc_id long, n_words long, n_removed long, kept binary, spans array<bigint>"


def removals(covered: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` units lie under a covered window start."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, covered, 1)
    np.add.at(edge, np.minimum(covered + length, n), -1)
    return np.cumsum(edge[:-1]) > 0


def split_edges(u, p, entries: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of the paths whose entry is among ``entries``: start, digest, second digest; ascending by start."""
    own = np.isin(p.entry, entries)
    lo, n = p.lo[own], (p.hi - p.lo)[own]
    start = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
    start = np.unique(start)
    digest = range_hashes(u.values, start, start + length)
    return start, digest, range_hashes(mixed(u.values), start, start + length)


def substring_dedup(docs: DataFrame, length: int = 20) -> DataFrame:
    """``doc_id, n_words, n_removed, kept, spans`` for each row of ``doc_id, text``.

    A word is removed if a window of ``length`` words covers it whose words also start at a smaller id, or at the same id
    and an earlier place; windows are judged on the input. ``kept`` joins the other words by one space (UTF-8), ``spans``
    lists first and past-the-last word of each removed run. Null and empty texts have no words; a text shorter than a window
    loses nothing. A null id comes after all others. Rows that share an id are compared by place alone, so exact repeats of
    a row lose nothing to each other. An empty input gives no row.
    """
    spec = Spec(length, min(GRAM, length), True)
    table = partitioned_packs(docs, "word-packs", spec)
    found = recurring(table, spec, across=False)
    paths = judged_paths(path_rows(table, found, spec))
    branching = paths.filter("branches").groupBy("pack").agg(F.collect_list("entry").alias("entries"))
    joined = table.join(found, "pack").select(*PACK, "found")

    def edges(row: Row) -> Iterator[list[np.ndarray]]:
        u = spec.units(row["ids"], row["ends"], row["body"], row["extra"])
        p = spec.paths(u, np.sort(row["found"].astype(np.uint64)))
        start, digest, second = split_edges(u, p, row["entries"], length)
        doc = np.searchsorted(u.ends, start, "right")
        place = start - np.concatenate([[0], u.ends])[doc]
        # the pack's own repeats of an edge stay rows only where they come first: the others hang on that one
        order = np.lexsort((place, u.ids[doc], digest))
        lead = np.flatnonzero(np.concatenate([[True], digest[order][1:] != digest[order][:-1]]))
        own = order[lead]
        yield [signed(digest[own]), signed(second[own]), u.ids[doc[own]], place[own], np.full(len(own), row["pack"], np.int64), np.arange(len(own), dtype=np.int32)]

    rows = per_pack(joined.join(branching, "pack"), EDGE_SCHEMA, edges)
    # each distinct edge of a pack learns the first coordinate of the edge in the corpus
    first = rows.withColumn("first", F.min(F.struct("id", "place")).over(Window.partitionBy("edge", "second")))
    moved = first.filter((F.col("first.id") != F.col("id")) | (F.col("first.place") != F.col("place")))
    edge_news = moved.groupBy("pack").agg(F.collect_list(F.struct("slot", F.col("first.id").alias("id"), F.col("first.place").alias("place"))).alias("edge_news"))
    alone = (F.col("first.id") == F.col("id")) & (F.col("first.place") == F.col("place")) & (F.col("n") == 1)
    plain = paths.filter("NOT branches").filter(~alone).groupBy("pack").agg(F.collect_list(F.struct("entry", F.col("first.id").alias("id"), F.col("first.place").alias("place"))).alias("path_news"))
    news = stored(plain.join(branching, "pack", "full").join(edge_news, "pack", "left").join(found, "pack", "left"), "news")

    def cut(row: Row) -> Iterator[list[np.ndarray]]:
        u = spec.units(row["ids"], row["ends"], row["body"], row["extra"])
        base = np.concatenate([[0], u.ends])
        gone = np.zeros(len(u.values), bool)
        if (found := row["found"]) is not None:
            p = spec.paths(u, np.sort(found.astype(np.uint64)))
            covered = []
            if (news := row["path_news"]) is not None:
                first_id, first_place = np.full(p.entry.max() + 1, NO_ID), np.full(p.entry.max() + 1, NO_ID)
                first_id[news["entry"]], first_place[news["entry"]] = news["id"], news["place"]
                own_id, own_place = u.ids[p.doc], p.lo - base[p.doc]
                late = (first_id[p.entry] < own_id) | ((first_id[p.entry] == own_id) & (first_place[p.entry] < own_place))
                lo, n = p.lo[late], (p.hi - p.lo)[late]
                covered.append(np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum()))
            if (entries := row["entries"]) is not None:
                start, digest, _ = split_edges(u, p, entries, length)
                doc = np.searchsorted(u.ends, start, "right")
                place = start - base[doc]
                order = np.lexsort((place, u.ids[doc], digest))
                fresh = np.concatenate([[True], digest[order][1:] != digest[order][:-1]])
                lead, slot = order[np.flatnonzero(fresh)], np.cumsum(fresh) - 1
                first_id, first_place = u.ids[doc[lead]], place[lead]
                if (moves := row["edge_news"]) is not None:
                    first_id[moves["slot"]], first_place[moves["slot"]] = moves["id"], moves["place"]
                own_id, own_place = u.ids[doc[order]], place[order]
                covered.append(start[order[(first_id[slot] < own_id) | ((first_id[slot] == own_id) & (first_place[slot] < own_place))]])
            if covered:
                gone = removals(np.concatenate(covered), length, len(u.values))
        ids, n_words, n_removed, kept, spans = [], [], [], [], []
        for k, i in enumerate(u.ids.tolist()):
            a, b = int(base[k]), int(base[k + 1])
            g = gone[a:b]
            stay = np.flatnonzero(~g) + a
            kept.append(b" ".join([u.body[s:e] for s, e in zip(u.starts[stay].tolist(), u.stops[stay].tolist())]))
            turn = np.flatnonzero(np.diff(np.concatenate([[False], g, [False]]).astype(np.int8)))
            ids.append(None if i == NO_ID else i)
            n_words.append(b - a)
            n_removed.append(int(g.sum()))
            spans.append(turn.tolist())
        yield [ids, n_words, n_removed, kept, spans]

    return per_pack(table.join(news, "pack", "left").select(*PACK, "found", "path_news", "entries", "edge_news"), OUT_SCHEMA, cut)
