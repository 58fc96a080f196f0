"""Parts of unitigs: k-mers of one minimizer and their neighbours meet in one bucket, which compacts what it holds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .kmer_counts import M, PACK, canonical, codes_at, dealt_pieces, letters_of, merged, turned

#: Longest k-mers whose numbers leave four bits for a neighbour.
LONGEST_K = 29
CUTS = "array<struct<at: int, node: bigint, before: bigint, weight: bigint>>"
#: ``node`` first k-mer, ``next`` the one after the part if that is the only way out, ``single`` if one arc leads in, ``least`` the smallest
#: canonical k-mer, ``cuts`` where a circle with that one would be cut, ``outs`` arcs out of the last k-mer.
PART = f"node bigint, next bigint, single boolean, seq string, n_kmers bigint, coverage bigint, least bigint, cuts {CUTS}, outs array<struct<letter: string, weight: bigint>>"
NO_KEYS = np.zeros(0, np.int64)


def sided(rows: list[bytes], k: int) -> np.ndarray:
    """Two numbers for each k-mer's place: the canonical k-mer and four bits, 0 to 3 for the letter after it, 8 for none; 4 to 7 for the letter before it."""
    letters, at, count, sides = letters_of(rows, k, around=True)
    codes = codes_at(letters, k)[at]
    turn = turned(codes, k)
    fine = [np.ones(len(at), bool), np.ones(len(at), bool)]
    last = np.cumsum(count) - 1
    fine[0][last - count + 1], fine[1][last] = sides & 1, sides >> 1
    before, after = letters[at - 1].astype(np.int64), letters[at + k].astype(np.int64)
    ahead = codes < turn
    own = np.where(ahead, codes, turn) << 4
    out, into = np.where(ahead, after, 3 - before), 4 + np.where(ahead, before, 3 - after)
    has_out, has_in = np.where(ahead, fine[1], fine[0]), np.where(ahead, fine[0], fine[1])
    return np.concatenate([own | np.where(has_out, out, 8), (own | into)[has_in]])


def judged(keys: np.ndarray, n: np.ndarray, k: int, cutoff: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Canonical k-mers above ``cutoff``, their counts, and the weights above it of arcs to the four letters after and before each."""
    codes, slot = keys >> 4, keys & 15
    new = np.flatnonzero(np.diff(codes, prepend=-1))
    total = np.add.reduceat(np.where((slot < 4) | (slot == 8), n, 0), new) if len(new) else n[:0]
    index = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(keys))))
    weights = np.zeros((len(new), 8), np.int64)
    weights[index[slot < 8], slot[slot < 8]] = n[slot < 8]
    codes = codes[new]
    keep = total > cutoff
    codes, total, weights = codes[keep], total[keep], weights[keep]
    mask, turn = np.int64((1 << (2 * k)) - 1), turned(codes, k)
    for x in range(4):  # a (k+1)-mer that is its own reverse complement was met from both of its k-mers
        weights[((codes << 2) & mask | x) == turn, x] //= 2
        weights[(codes >> 2 | np.int64(x) << np.int64(2 * k - 2)) == turn, 4 + x] //= 2
    weights[weights <= cutoff] = 0
    return codes, total, weights


def walked(prev: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Head and place of each row, and the least ``rank`` between it and its head, or on its circle, whose rows have head -1."""
    ptr, least, steps = prev.copy(), rank.copy(), (prev >= 0).astype(np.int64)
    active, rounds = np.flatnonzero(prev >= 0), 0
    while len(active) and (1 << rounds) <= 2 * len(prev):
        there = ptr[active]
        far = ptr[there]
        least[active] = np.minimum(least[active], least[there])
        active, there, far = active[far >= 0], there[far >= 0], far[far >= 0]
        steps[active], ptr[active] = steps[active] + steps[there], far
        rounds += 1
    head = np.where(ptr >= 0, ptr, np.arange(len(prev)))
    head[active] = -1
    return head, steps, least


def parts_of(codes: np.ndarray, n: np.ndarray, weights: np.ndarray, k: int) -> dict[str, pa.Array]:
    """Columns of ``PART``: chains of the k-mers' links, both directions; circles are cut as :func:`assembly.unitigs` says."""
    size = len(codes)
    mask = np.int64((1 << (2 * k)) - 1)
    both, rank = np.concatenate([codes, turned(codes, k)]), np.concatenate([codes, codes])
    twin = np.concatenate([np.arange(size, 2 * size), np.arange(size)])
    outs = np.concatenate([weights[:, :4], weights[:, :3:-1]])
    n_out = (outs > 0).sum(1)
    single = n_out == 1
    letter = outs.argmax(1)
    after = ((both << 2) & mask) | letter
    small = canonical(after, k)
    place = np.minimum(np.searchsorted(codes, small), size - 1)
    here = codes[place] == small
    to = np.where(small == after, place, place + size)
    link = np.flatnonzero(single & here & (n_out[twin[to]] == 1) & (to != np.arange(2 * size)) & (to != twin))
    prev = np.full(2 * size, -1, np.int64)
    prev[to[link]] = link
    head, steps, least = walked(prev, rank)
    if (head < 0).any():
        cut = (head < 0) & ((both == least) | ((prev >= 0) & (both[prev] == turned(least, k))))
        prev[cut] = -1
        head, steps, least = walked(prev, rank)
    order = np.lexsort((steps, head))
    first = np.flatnonzero(steps[order] == 0)
    count = np.diff(np.append(first, 2 * size))
    last = order[first + count - 1]
    # letters: the first k-mer, then the last letter of each other one
    text = count + k - 1
    begin = np.cumsum(text) - text
    letters = np.zeros(int(text.sum()), np.uint8)
    for i in range(k):
        letters[begin + i] = (both[order[first]] >> (2 * (k - 1 - i))) & 3
    row = np.repeat(np.arange(len(first)), count)
    letters[begin[row] + steps[order] + k - 1] = both[order] & 3
    if text.sum() >= 1 << 31:
        raise ValueError("a bucket's parts are too long")
    seq = pa.StringArray.from_buffers(len(first), pa.py_buffer(np.append(begin, text.sum()).astype(np.int32)), pa.py_buffer(np.frombuffer(b"ACGT", np.uint8)[letters]))
    amount = np.concatenate([n, n])[order]
    upto = np.concatenate([[0], np.cumsum(amount)])
    low = np.minimum.reduceat(rank[order], first)
    # a circle through this part is cut before its smallest k-mer, and behind that one's reverse complement
    found = np.flatnonzero(rank[order] == low[row])
    found_row = row[found]
    at = steps[order[found]] + (both[order[found]] != low[found_row])
    behind = first[found_row] + at  # in the order of parts
    inner = (at > 0) & (at < count[found_row])
    node = np.where(inner | (at == 0), both[order[np.minimum(behind, 2 * size - 1)]], 0)
    weight = np.where(inner, outs[order[behind - 1], letter[order[behind - 1]]], 0)
    cuts = pa.StructArray.from_arrays([pa.array(at, pa.int32()), pa.array(node), pa.array(upto[behind] - upto[first[found_row]]), pa.array(weight)], ["at", "node", "before", "weight"])
    ends = outs[last]
    part, way = np.nonzero(ends)
    ways = pa.StructArray.from_arrays([pa.array(np.array(list("ACGT"))[way], pa.string()), pa.array(ends[part, way])], ["letter", "weight"])
    lists = lambda owner, values: pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(first) + 1)), pa.int32()), values)
    return {
        "node": pa.array(both[order[first]]), "next": pa.array(after[last], mask=~(single & ~here)[last]), "single": pa.array(n_out[twin[order[first]]] == 1), "seq": seq, "n_kmers": pa.array(count),
        "coverage": pa.array(upto[first + count] - upto[first]), "least": pa.array(low), "cuts": lists(found_row, cuts), "outs": lists(part, ways),
    }


def unitig_parts(seqs: DataFrame, k: int, by: list[str], cutoff: float) -> DataFrame:
    """``*by`` and ``PART``: k-mers' chains as far as one bucket of minimizers holds them; ``k`` is odd and 29 at most.

    All places of a k-mer are in its bucket with the letters around it, which tell the (k+1)-mers' counts too.
    """
    dealt, types = dealt_pieces(seqs, k, by, min(M, (k + 1) // 2), around=True)
    names = [f.name for f in dealt.select(*by).schema]

    def compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, known, waiting, held, kinds = None, None, [], 0, []

        def close() -> Iterator[pa.RecordBatch]:
            every = merged(known, sided(waiting, k) if waiting else NO_KEYS)
            codes, n, weights = judged(*every, k, cutoff)
            if not len(codes):
                return
            columns = parts_of(codes, n, weights, k)
            size = len(columns["node"])
            out = pa.RecordBatch.from_arrays([*(pa.array([v] * size, t) for v, t in zip(at, kinds)), *columns.values()], [*names, *columns])
            for a in range(0, size, 1 << 16):
                yield out.slice(a, 1 << 16)

        for b in batches:
            kinds = [b.column(c).type for c in names]
            keys = list(zip(*(b.column(c).to_pylist() for c in names), b.column("_bucket").to_pylist()))
            for key, packed in zip(keys, b.column("_packed")):
                if key != at:
                    # small buckets of a collection are compacted together
                    if at is not None and (key[:-1] != at[:-1] or 8 * held + (0 if known is None else len(known[0])) > PACK):
                        yield from close()
                        known, waiting, held = None, [], 0
                    at = key
                waiting.append(packed.as_py())
                held += len(waiting[-1])
                if held > PACK:
                    known, waiting, held = merged(known, sided(waiting, k)), [], 0
        if at is not None:
            yield from close()

    return dealt.mapInArrow(compact, types + PART)
