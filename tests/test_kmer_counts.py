import random
from collections import Counter

import numpy as np

from svweave.operators import kmer_counts, sequences


def plain(rows, k):
    out = Counter()
    for by, t in rows:
        for i in range(len(t or "") - k + 1):
            w = t[i : i + k]
            out[by, min(w, w[::-1].translate(str.maketrans("ACGTacgt", "TGCAtgca")))] += 1
    return {x: n for x, n in out.items() if n > 1}


def some_rows():
    rng = random.Random(5)
    base = ["".join(rng.choices("ACGT", k=rng.choice([20, 21, 22, 90, 700]))) for _ in range(12)]
    turned = [t[::-1].translate(str.maketrans("ACGT", "TGCA")) for t in base[:6]]
    odd = ["ACGTN" * 40, "A" * 900, "acgt" * 30 + "ACGT" * 30, "", None, "ACGTé" * 20 + "ACGT" * 20]
    return [(rng.choice(["x", "y", None]), t) for t in (base + turned + odd) * 2]


def test_counts_by_minimizer_equal_plain_counts(spark, monkeypatch):
    rows = some_rows()
    df = spark.createDataFrame(rows, "by string, seq string")
    for pack in (1 << 21, 64):
        monkeypatch.setattr(kmer_counts, "PACK", pack)
        for k in (12, 21, 22, 31):
            every = plain(rows, k)
            got = sequences.kmers(df, k, ["by"]).collect()
            assert len(got) == len(every) and {(r.by, r.kmer): r.n for r in got} == every
            pure = sequences.kmers(df, k, ["by"], pure=True).collect()
            assert {(r.by, r.kmer): r.n for r in pure} == {x: n for x, n in every.items() if set(x[1]) <= set("ACGT")}


def test_pieces_are_far_fewer_bytes_than_their_kmers():
    """A row for each k-mer moved 21 letters and more; a letter of a piece is two bits."""
    text = "".join(random.Random(1).choices("ACGT", k=200_000)).encode()
    assert sum(len(p) for _, p in kmer_counts.pieces(text, 21)) < 2 * len(text)
    codes = np.concatenate([kmer_counts.unpacked([p], 21) for _, p in kmer_counts.pieces(text, 21)])
    assert len(codes) == len(text) - 20
