import random

import numpy as np
from pyspark.sql import functions as F

from svweave.operators import remap, results


def plain(read, window, match=2, mismatch=-2, gap_open=6, gap_extend=1):
    """Local alignment with affine gaps, cell by cell."""
    best, low = 0, -(10**9)
    h = [[0] * (len(window) + 1) for _ in range(len(read) + 1)]
    e = [[low] * (len(window) + 1) for _ in range(len(read) + 1)]
    f = [[low] * (len(window) + 1) for _ in range(len(read) + 1)]
    for i in range(1, len(read) + 1):
        for j in range(1, len(window) + 1):
            e[i][j] = max(e[i][j - 1] - gap_extend, h[i][j - 1] - gap_open - gap_extend)
            f[i][j] = max(f[i - 1][j] - gap_extend, h[i - 1][j] - gap_open - gap_extend)
            h[i][j] = max(0, h[i - 1][j - 1] + (match if read[i - 1] == window[j - 1] else mismatch), e[i][j], f[i][j])
            best = max(best, h[i][j])
    return best


def noisy(rng, text):
    out = []
    for c in text:
        r = rng.random()
        out.append("" if r < 0.04 else c + rng.choice("ACGT") if r < 0.08 else rng.choice("ACGT") if r < 0.14 else c)
    return "".join(out)


def test_batches_equal_the_plain_alignment():
    rng = random.Random(3)
    pairs = [("", "ACGT"), ("ACGT", ""), ("A", "A"), ("ACGT", "ACGT"), ("N", "N"), ("TTT", "AAA")]
    for _ in range(120):
        window = "".join(rng.choice("ACGTN") for _ in range(rng.randint(1, 70)))
        at = rng.randrange(len(window))
        pairs.append((noisy(rng, window[at : at + rng.randint(1, 40)]) or "A", window))
    for scoring in ((2, -2, 6, 1), (1, -3, 2, 2), (5, -1, 0, 1)):
        got = remap.batch_scores([r for r, _ in pairs], [w for _, w in pairs], *scoring)
        assert got.tolist() == [plain(r, w, *scoring) for r, w in pairs]


def test_scores_in_spark_and_nulls(spark, monkeypatch):
    monkeypatch.setattr(remap, "CELLS", 64)
    rows = [(1, "ACGTACGTAC", "TTACGTACGTACTT"), (2, None, "A"), (3, "A", None), (4, "", "A"), (5, "ACGTTACG", "ACGTACG"), (6, "GGG", "CCC")]
    got = remap.local_scores(spark.createDataFrame(rows, "k int, read string, window string"))
    assert {r.k: r.score for r in got.collect()} == {k: None if a is None or b is None else plain(a, b) for k, a, b in rows}


def test_regions_of_tiles(spark):
    text = "".join(random.Random(1).choice("ACGTn") for _ in range(1003))
    reference = remap.tiles(spark.createDataFrame([("1", text), ("2", "acg"), ("3", "")], "chr string, seq string"), 100)
    spots = [("1", 1, 1), ("1", -50, 20), ("1", 95, 305), ("1", 100, 101), ("1", 990, 2000), ("2", 1, 3), ("2", 4, 9), ("4", 1, 2), ("1", 7, 3), (None, 1, 2)]
    got = {(r.chr, r.lo, r.hi): r.seq for r in remap.fetch_regions(spark.createDataFrame(spots + spots[:1], "chr string, lo long, hi long"), reference, 100).collect()}
    want = {"1": text.upper(), "2": "ACG"}
    for c, lo, hi in spots:
        bases = want.get(c, "")[max(lo, 1) - 1 : hi] if hi >= max(lo, 1) else ""
        assert (got[c, lo, hi] or "") == bases, (c, lo, hi)


def test_calls_keep_reads_that_fit_their_own_place(spark):
    rng = random.Random(8)
    one, two = ("".join(rng.choice("ACGT") for _ in range(6000)) for _ in range(2))
    two = two[:4500] + "N" + two[4501:]
    calls = [("good", "1", 1000, "+", "2", 2000, "-"), ("moved", "1", 3000, "+", "2", 1000, "+"), ("few", "1", 5000, "+", "2", 2800, "-"), ("n", "1", 2000, "+", "2", 4400, "-"), ("indel", "1", 4000, "+", "1", 4300, "-")]
    table, reads, names = spark.createDataFrame(calls, "id string, chr1 string, pos1 long, strand1 string, chr2 string, pos2 long, strand2 string"), [], []
    back = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    for id_, c1, p1, s1, c2, p2, s2 in calls:
        for k in range(2 if id_ == "few" else 4):
            name, a, b = f"{id_}{k}", p1 - 60 - 20 * k, p2 + 10 * k
            texts = {"1": one, "2": two}
            low, high = texts[c1][a - 1 : a + 99], texts[c2][b - 1 : b + 99]
            if id_ == "moved":  # the low reads come from the other place, whose strand is turned
                low = back(two[1000 - 1 + 5 * k : 1100 - 1 + 5 * k])
            reads += [(name, 1, c1, a, s1, c2, b, s2, 100, low), (name, 2, c2, b, s2, c1, a, s1, 100, high)]
            names.append((id_, name))
    reads = spark.createDataFrame(reads, "qname string, mate int, chr string, pos long, strand string, mate_chr string, mate_pos long, mate_strand string, read_len long, seq string")
    reference = remap.tiles(spark.createDataFrame([("1", one), ("2", two)], "chr string, seq string"), 512)
    out = remap.remap_calls(table, reads, spark.createDataFrame(names, "id string, qname string"), reference, slop=300, size=512)
    got = {r.id: r for r in out.collect()}
    assert set(got) == {c[0] for c in calls}
    window = lambda text, pos: text[pos - 301 : pos + 300]
    low = [one[1000 - 61 - 20 * k : 1000 + 39 - 20 * k] for k in range(4)]
    assert got["good"].low_score == max(200 - plain(r, window(two, 2000)) for r in low) > 80 and got["good"].low_footprint == 160
    assert got["moved"].low_score <= 0 and got["moved"].high_score > 80
    assert (got["few"].low_score, got["few"].low_footprint, got["few"].has_n) == (None, None, False)
    assert got["n"].has_n and got["indel"].small_indel and got["indel"].low_footprint == 160
    kept = results.filter_remap(table.selectExpr("*", "4 AS score"), out.selectExpr("*", "0 AS microbes"))
    assert {r.id for r in kept.collect()} == {"good", "indel"}
    assert np.all([r.low_footprint is None or r.low_footprint > 0 for r in got.values()])


def test_equal_texts_of_one_end_are_aligned_once(spark, monkeypatch):
    """Many reads of one text are one alignment; they count as many reads."""
    from svweave.operators import remap

    aligned, plain = [], remap.local_scores

    def counted(pairs, **scoring):
        aligned.append(pairs.count())
        return plain(pairs, **scoring)

    monkeypatch.setattr(remap, "local_scores", counted)
    text = "".join("ACGT"[(i * i * 7 + i // 3) % 4] for i in range(2000))
    tiles = remap.tiles(spark.createDataFrame([(1, text)], "chr long, seq string"), 64)
    calls = spark.createDataFrame([(7, 1, 300, "+", 1, 1500, "-")], "id long, chr1 long, pos1 long, strand1 string, chr2 long, pos2 long, strand2 string")
    rows = [(f"r{k}", m, 1, p, s, 1, q, t, 20, text[p - 1 : p + 19]) for k in range(40) for m, p, s, q, t in ((1, 290, "+", 1495, "-"), (2, 1495, "-", 290, "+"))]
    reads = spark.createDataFrame(rows, "qname string, mate int, chr long, pos long, strand string, mate_chr long, mate_pos long, mate_strand string, read_len long, seq string")
    names = spark.createDataFrame([(7, f"r{k}") for k in range(40)], "id long, qname string")
    (out,) = remap.remap_calls(calls, reads, names, tiles, slop=100, size=64).collect()
    assert (out.low_footprint, out.high_footprint) == (20, 20) and aligned == [2, 2]
    own = [text[199:400], text[1399:1600]]
    for k, (score, p) in enumerate(((out.low_score, 290), (out.high_score, 1495))):
        read = text[p - 1 : p + 19]
        assert score == 40 - int(remap.batch_scores([read], [own[1 - k]], 2, -2, 6, 1)[0])


def test_bases_are_fetched_for_places_not_for_reads(spark, monkeypatch):
    """Reads that give their place in the reference score as those that bring its bases; equal places of one end are fetched as one row."""
    fetched, plain_fetch = [], remap.fetch_regions

    def counted(regions, *args):
        fetched.append((regions.count(), "qname" in regions.columns))
        return plain_fetch(regions, *args)

    text = "".join("ACGT"[(i * i * 7 + i // 3) % 4] for i in range(2000))
    tiles = remap.tiles(spark.createDataFrame([(1, text)], "chr long, seq string"), 64)
    calls = spark.createDataFrame([(7, 1, 300, "+", 1, 1500, "-"), (8, 1, 310, "+", 1, 1490, "-")], "id long, chr1 long, pos1 long, strand1 string, chr2 long, pos2 long, strand2 string")
    ends = ((1, 290, "+", 1495, "-"), (2, 1495, "-", 290, "+"))
    rows = [(f"r{k}", m, 1, p + k % 2, s, 1, q + k % 2, t, 20, 1, (q if k % 5 == 0 else p + k % 2)) for k in range(40) for m, p, s, q, t in ends]
    reads = spark.createDataFrame([(*r, r[-1] + 19) for r in rows], "qname string, mate int, chr long, pos long, strand string, mate_chr long, mate_pos long, mate_strand string, read_len long, body_chr long, body_lo long, body_hi long")
    names = spark.createDataFrame([(i, f"r{k}") for i in (7, 8) for k in range(40) for _ in range(2)], "id long, qname string")
    bases = reads.join(spark.createDataFrame([(1, text)], "body_chr long, text string"), "body_chr").selectExpr("* except (body_chr, body_lo, body_hi, text)", "substring(text, int(body_lo), 20) AS seq")
    want = {tuple(r) for r in remap.remap_calls(calls, bases, names, tiles, slop=100, size=64).collect()}
    monkeypatch.setattr(remap, "fetch_regions", counted)
    got = {tuple(r) for r in remap.remap_calls(calls, reads, names, tiles, slop=100, size=64).collect()}
    assert got == want and len(got) == 2
    assert fetched == [(4, False), (2 * 2 * 3, False)]


def test_candidates_are_found_once(spark, monkeypatch):
    from svweave.plans import remap_queries

    asked, plain_candidates = [], remap_queries.candidates
    monkeypatch.setattr(remap_queries, "candidates", lambda *a: asked.append(a) or plain_candidates(*a))
    remap_queries.b20_filter_remapped(spark, "/root/testdata/sf0.001")
    assert len(asked) == 1


def test_pairs_unfold_as_the_view_of_alignments(spark):
    from svweave.plans.read_queries import ALIGNMENTS
    from svweave.plans.remap_queries import alignments
    from svweave.plans.views import READ_PAIRS, view

    d = "/root/testdata/sf0.001"
    want = view(spark, d, ALIGNMENTS).selectExpr("qname", "mate", "chr", "pos", "strand", "mate_chr", "mate_pos", "mate_strand", "read_len", "IF(mapq % 7 = 0, mate_chr, chr) AS body_chr", "IF(mapq % 7 = 0, mate_pos, pos) AS body_lo")
    got = alignments(view(spark, d, READ_PAIRS).withColumn("id", F.lit(1))).filter("body_hi = body_lo + read_len - 1").select(want.columns)
    assert got.count() > 10_000 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
