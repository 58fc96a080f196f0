"""Operator 5, SentencePiece encoding and decoding by vectorised merge rounds.

Texts are cut before each run of the space mark, where no piece of the model can span, and each distinct segment is encoded
once: the segments' symbols lie in one flat array, a round takes the smallest rank of the pairs in each segment, merges its
leftmost places at once and compacts, until no pair is left. In a segment of many characters the smallest rank is that of the
pairs near by, no farther than a piece can reach, so that it merges at many places in a round. Decoding gathers the pieces'
bytes by id.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import NO_ID, doc_batches

SPACE = "▁"
CACHED_SEGMENTS = 250_000
#: Characters of new segments that go through one set of rounds (a longer segment goes alone).
ROUND_CHARS = 1 << 17
#: A segment of more characters takes its smallest ranks place by place.
LONG_SEGMENT = 512
#: Piece types of the public model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
NONE = np.iinfo(np.int64).max


class PieceModel:
    """The pieces of a BPE model with byte fallback, and the rank of each pair of pieces that merges to a piece."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, trained = model.normalizer_spec, model.trainer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or not norm.add_dummy_prefix or trained.model_type != 2 or not trained.byte_fallback:
            raise ValueError("only BPE models with byte fallback, identity normalisation and a dummy prefix are read")
        pieces = [(p.piece, p.score, p.type or NORMAL) for p in model.pieces]
        if any(t in (USER_DEFINED, UNUSED) or SPACE in p.lstrip(SPACE) for p, _, t in pieces):
            raise ValueError("pieces that hold the space mark after another character aren't read")
        self.ids = {p: k for k, (p, _, t) in enumerate(pieces) if t == NORMAL}
        self.reach = max(map(len, self.ids), default=1)
        self.bytes = {int(p[3:5], 16): k for k, (p, _, t) in enumerate(pieces) if t == BYTE}
        self.byte_ids = np.array([self.bytes[b] for b in range(256)], np.int64)
        # symbols: pieces by id, then characters that are no piece
        self.n, self.extra = len(pieces), {}
        # higher scores merge first; equal scores tie by place alone, so they share a rank
        order = {s: r for r, s in enumerate(sorted({s for _, s, t in pieces if t == NORMAL}, reverse=True))}
        self.rank_of = np.array([order[s] if t == NORMAL else 0 for _, s, t in pieces], np.int64)
        left, right, merged = [], [], []
        for p, k in self.ids.items():
            for cut in range(1, len(p)):
                a, b = self.ids.get(p[:cut]), self.ids.get(p[cut:])
                # a part of one character that is no piece by itself can't occur: it has an id of its own only if unknown
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(k)
        self.pairs = PairTable(np.array(left, np.int64) * self.n + np.array(right, np.int64), np.array(merged, np.int64))
        #: Symbol of each code point: its piece, else n + code point.
        self.symbol_of = np.arange(0x110000, dtype=np.int64) + self.n
        for p, k in self.ids.items():
            if len(p) == 1:
                self.symbol_of[ord(p)] = k
        missing = {c for p in self.ids for c in p if c not in self.ids}
        if missing:
            raise ValueError("a piece has characters that are no pieces")
        texts = [bytes([int(p[3:5], 16)]) if t == BYTE else b"" if t == CONTROL else " ⁇ ".encode() if t == UNKNOWN else p.replace(SPACE, " ").encode() for p, _, t in pieces]
        self.text_ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        self.text_lens = np.array([len(t) for t in texts], np.int64)
        self.text_bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.seen: dict[str, bytes] = {}

    def pair_ids_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged piece of each pair, -1 for none."""
        return self.pairs.get(np.where((left < self.n) & (right < self.n), left * self.n + right, -1))

    def merge_rounds(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge flat ``symbols`` of segments ``owner`` (ascending) until no pair is left; finished segments leave early."""
        done_s, done_o, done_at = [], [], []
        place = np.arange(len(symbols))
        while len(symbols):
            same = owner[:-1] == owner[1:]
            pair = np.where(same, self.pair_ids_of(symbols[:-1], symbols[1:]), -1)
            rank = np.where(pair >= 0, self.rank_of[pair], NONE)
            first = np.flatnonzero(np.concatenate([[True], ~same]))
            number = np.cumsum(np.concatenate([[0], ~same]))
            least = np.minimum.reduceat(np.append(rank, NONE), first)
            live = (least < NONE)[number]
            if not live.all():
                keep = ~live
                done_s.append(symbols[keep])
                done_o.append(owner[keep])
                done_at.append(place[keep])
                symbols, owner, place = symbols[live], owner[live], place[live]
                continue
            hit = rank == least[number[:-1]]
            # in a run of overlapping hits every second one merges, from the left
            at = np.flatnonzero(hit)
            run = np.cumsum(np.concatenate([[True], np.diff(at) > 1]))
            at = at[(np.arange(len(at)) - np.searchsorted(run, run)) % 2 == 0]
            segment = number[at]
            # a new pair that is as good or better may come before the hits to its right: such segments merge one place
            new = pair[at]
            prev, after = at - 1, at + 2
            has_prev = (prev >= 0) & (number[np.maximum(prev, 0)] == segment)
            has_next = (after < len(symbols)) & (number[np.minimum(after, len(symbols) - 1)] == segment)
            p_left = np.where(has_prev, self.pair_ids_of(symbols[np.maximum(prev, 0)], new), -1)
            p_right = np.where(has_next, self.pair_ids_of(new, symbols[np.minimum(after, len(symbols) - 1)]), -1)
            near = np.concatenate([[False], at[1:] == at[:-1] + 2]) & np.concatenate([[False], segment[1:] == segment[:-1]])
            p_near = np.full(len(at), -1)
            if near.any():
                k = np.flatnonzero(near)
                p_near[k] = self.pair_ids_of(new[k - 1], new[k])
            r = least[segment]
            early = ((p_left >= 0) & (self.rank_of[p_left] <= r)) | ((p_right >= 0) & (self.rank_of[p_right] <= r)) | ((p_near >= 0) & (self.rank_of[p_near] <= r))
            one = np.zeros(len(least), bool)
            one[segment[early]] = True
            lead = np.concatenate([[True], segment[1:] != segment[:-1]])
            take = ~one[segment] | lead
            at, new = at[take], new[take]
            symbols = symbols.copy()
            symbols[at] = new
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, owner, place = symbols[keep], owner[keep], place[keep]
        if not done_s:
            return symbols, owner
        order = np.argsort(np.concatenate(done_at), kind="stable")
        return np.concatenate(done_s)[order], np.concatenate(done_o)[order]

    def merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """One long segment's symbols merged until no pair is left.

        A pair merges before any that it touches does if no pair as near as a piece is long ranks before it: whatever piece took
        one of its symbols first would be made of such pairs. Hits are pairs of the smallest rank within that reach; those in
        reach of each other have one rank and merge from the left, or the first alone if a new pair could come before the rest.
        """
        pair = np.append(self.pair_ids_of(symbols[:-1], symbols[1:]), -1)
        rank = np.where(pair >= 0, self.rank_of[pair], NONE)
        reach = self.reach
        while len(symbols) > 1:
            ahead = np.concatenate([np.full(reach, NONE), rank, np.full(reach, NONE)])
            width = 1
            while width < 2 * reach + 1:
                step = min(width, 2 * reach + 1 - width)
                ahead = np.minimum(ahead[:-step], ahead[step:])
                width += step
            hit = (rank == ahead) & (rank < NONE)
            at = np.flatnonzero(hit)
            if not len(at):
                break
            group = np.cumsum(np.concatenate([[True], np.diff(at) > reach])) - 1
            # a pair of the same rank to the left that waits for another comes first, and so do those after it
            waits = np.concatenate([np.full(reach, NONE), np.where(hit, NONE, rank)])
            width = 1
            while width < reach:
                step = min(width, reach - width)
                waits = np.minimum(waits[:-step], waits[step:])
                width += step
            behind = waits[at] == rank[at]
            if behind.any():
                after_one = np.cumsum(behind)
                start = np.searchsorted(group, np.arange(group[-1] + 1))
                ready = after_one == (after_one - behind)[start][group]
                at, group = at[ready], group[ready]
            run = np.cumsum(np.concatenate([[True], np.diff(at) > 1]))
            odd = (np.arange(len(at)) - np.searchsorted(run, run)) % 2 == 0
            at, group = at[odd], group[odd]
            new, r = pair[at], rank[at]
            p_left = np.where(at > 0, self.pair_ids_of(symbols[np.maximum(at - 1, 0)], new), -1)
            after = at + 2 < len(symbols)
            p_right = np.where(after, self.pair_ids_of(new, symbols[np.minimum(at + 2, len(symbols) - 1)]), -1)
            near = np.concatenate([[False], at[1:] == at[:-1] + 2])
            p_near = np.where(near, self.pair_ids_of(np.concatenate([new[:1], new[:-1]]), new), -1)
            better = lambda p: (p >= 0) & (self.rank_of[p] <= r)
            one = np.zeros(group[-1] + 1 if len(group) else 0, bool)
            one[group[better(p_left) | better(p_right) | better(p_near)]] = True
            take = ~one[group] | np.concatenate([[True], group[1:] != group[:-1]])
            at, new = at[take], new[take]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols[at] = new
            symbols, pair, rank = symbols[keep], pair[keep], rank[keep]
            there = at - np.arange(len(at))
            again = np.unique(np.concatenate([there, np.maximum(there - 1, 0)]))
            inner = again < len(symbols) - 1
            pair[again[~inner]], rank[again[~inner]] = -1, NONE
            again = again[inner]
            pair[again] = self.pair_ids_of(symbols[again], symbols[again + 1])
            rank[again] = np.where(pair[again] >= 0, self.rank_of[pair[again]], NONE)
        return symbols

    def encode_segments(self, segments: list[str]) -> list[bytes]:
        """Ids of each segment as little-endian 32-bit integers, ``ROUND_CHARS`` at a time and long ones alone."""
        lens = np.fromiter(map(len, segments), np.int64, len(segments))
        alone = lens > LONG_SEGMENT
        turn = (np.cumsum(lens) - lens) // ROUND_CHARS
        cut = np.diff(turn, prepend=-1) > 0
        cut |= alone | np.concatenate([[False], alone[:-1]])
        cuts = [*np.flatnonzero(cut).tolist(), len(segments)]
        return [x for a, b in zip(cuts, cuts[1:]) for x in self._encode(segments[a:b])]

    def _encode(self, segments: list[str]) -> list[bytes]:
        lens = np.fromiter(map(len, segments), np.int64, len(segments))
        flat = self.symbol_of[np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), "<u4")]
        if len(segments) == 1 and lens[0] > LONG_SEGMENT:
            flat = self.merge_long(flat)
            owner = np.zeros(len(flat), np.int64)
        else:
            flat, owner = self.merge_rounds(flat, np.repeat(np.arange(len(segments)), lens))
        if (odd := flat >= self.n).any():  # characters without a piece become their bytes
            code = flat[odd] - self.n
            many = np.ones(len(flat), np.int64)
            many[odd] = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
            raw = np.frombuffer("".join(map(chr, code.tolist())).encode("utf-8", "surrogatepass"), np.uint8)
            wide = np.repeat(odd, many)
            flat, owner = np.repeat(flat, many), np.repeat(owner, many)
            flat[wide] = self.byte_ids[raw]
        ends = 4 * np.searchsorted(owner, np.arange(len(segments)), "right")
        ids, starts = flat.astype("<u4").tobytes(), np.concatenate([[0], ends[:-1]])
        return [ids[a:b] for a, b in zip(starts.tolist(), ends.tolist())]

    def segments(self, text: str) -> list[str]:
        """Before each run of space marks, and around line feeds, no piece spans."""
        marked = SPACE + text.replace(" ", SPACE)
        if SPACE + SPACE in marked:
            return re.findall(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+", marked)
        return [SPACE + p for p in marked.split(SPACE)[1:]]

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; the segments that no text had before go through the rounds."""
        parts, seen = [self.segments(t) if t else [] for t in texts], self.seen
        new = list(set().union(*parts).difference(seen))
        if new:
            seen.update(zip(new, self.encode_segments(new)))
        out = [np.frombuffer(b"".join(map(seen.__getitem__, p)), "<u4") for p in parts]
        if len(seen) > CACHED_SEGMENTS:  # those seen first stay, mostly the frequent ones
            for s in new:
                del seen[s]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """Bytes of the pieces, without the space of the dummy prefix; bytes that are no UTF-8 become U+FFFD."""
        if not len(ids):
            return ""
        lens = self.text_lens[ids]
        ends = np.cumsum(lens)
        at = np.repeat(self.text_ends[ids] - ends, lens) + np.arange(ends[-1])
        raw = self.text_bytes[at].tobytes()
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


class PairTable:
    """Vectorised lookup of integer keys: slots by a multiplied hash, and a sorted list for keys whose slot is taken."""

    BITS = 20

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        slot = self._slot(keys)
        _, first = np.unique(slot, return_index=True)
        self.keys, self.values = np.full(1 << self.BITS, -2, np.int64), np.full(1 << self.BITS, -1, np.int64)
        self.keys[slot[first]], self.values[slot[first]] = keys[first], values[first]
        rest = np.setdiff1d(np.arange(len(keys)), first)
        rest = rest[np.argsort(keys[rest])]
        self.more_keys, self.more = np.append(keys[rest], np.iinfo(np.int64).max), np.append(values[rest], -1)
        self.crowded = np.zeros(1 << self.BITS, bool)
        self.crowded[slot[rest]] = True

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        found = np.where(self.keys[slot] == keys, self.values[slot], -1)
        if len(again := np.flatnonzero(self.crowded[slot] & (found < 0))):
            at = np.searchsorted(self.more_keys, keys[again])
            found[again] = np.where(self.more_keys[at] == keys[again], self.more[at], -1)
        return found


@lru_cache(2)
def model(path: str) -> PieceModel:
    return PieceModel(path)


def coded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[pa.Array, list[np.ndarray], list[str]]]:
    """Ids of documents, their piece ids and the texts these decode to, about a megabyte of text at a time."""
    pieces = model(path)
    for some, texts in doc_batches(batches):
        ids = pieces.encode_all([t.decode("utf-8", "replace") for t in texts])
        yield pa.array([None if i == NO_ID else i for i in some.tolist()], pa.int64()), ids, [pieces.decode(x) for x in ids]


def encode_decode(df: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, decoded`` for each row of ``doc_id, text``: ids as little-endian 32-bit integers, and their text.

    Null and empty texts have no ids and decode to the empty text; null ids and repeated rows are kept as they are. A text
    of any length is cut into segments; a long segment without spaces is merged whole.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, ids, text in coded(batches, path):
            yield pa.RecordBatch.from_arrays([doc, pa.array([x.tobytes() for x in ids], pa.binary()), pa.array(text, pa.string())], ["doc_id", "ids", "decoded"])

    return df.select("doc_id", "text").mapInArrow(code, "doc_id long, ids binary, decoded string")


def encode_digests(df: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of :func:`encode_decode`'s rows, of which neither ids nor texts leave the worker."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        for doc, ids, text in coded(batches, path):
            columns = [doc, pa.array([len(x) for x in ids], pa.int64()), pa.array([sha(",".join(map(str, x.tolist()))) for x in ids]), pa.array([sha(t) for t in text])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select("doc_id", "text").mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
