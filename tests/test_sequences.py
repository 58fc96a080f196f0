"""Sequence and comparison operators against small expected answers."""

from svweave.operators import compare, sequences


def complement(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def test_kmers_are_strandless_and_cross_pieces(spark, monkeypatch):
    monkeypatch.setattr(sequences, "PIECE", 7)
    texts = ["ACGTTGCAACGGTACCATGACGTT", "GATTACA", "", None, "AC"]
    rows = sequences.kmers(spark.createDataFrame([("g", t) for t in texts], "who string, seq string"), 4, ["who"]).collect()
    want = {}
    for t in filter(None, texts):
        for k in range(len(t) - 3):
            low = min(t[k : k + 4], complement(t[k : k + 4]))
            want[low] = want.get(low, 0) + 1
    assert {r["kmer"]: r["n"] for r in rows} == {k: n for k, n in want.items() if n > 1}


def test_gc_bins_skip_other_letters(spark):
    rows = sequences.gc_bins(spark.createDataFrame([(1, "ACGTNNGGAT"), (2, ""), (3, None)], "id int, seq string"), 5).orderBy("bin").collect()
    assert [tuple(r) for r in rows] == [(1, 0, 4, 0.5), (1, 1, 4, 0.5)]


def test_contaminants_take_longest_string_then_smaller_item(spark):
    shared = "ACGTTGCAACGGTACCATGA"
    reads = spark.createDataFrame([(1, "TT" + shared + "C"), (2, "G" * 30), (3, None)], "read_id long, seq string")
    library = spark.createDataFrame([(7, shared), (4, "C" + shared), (9, shared[:12])], "item_id long, seq string")
    assert [tuple(r) for r in sequences.contaminant_hits(reads, library, 10, 8).collect()] == [(1, 4, 20)]


CALLS = "id long, chr1 int, start1 long, end1 long, chr2 int, start2 long, end2 long, strand1 string, strand2 string, tumour_count int"


def test_compare_calls_tags(spark):
    new = spark.createDataFrame([(1, 1, 100, 200, 2, 900, 950, "+", "-", 5), (2, 1, 90000, 90010, 2, 5, 6, "+", "-", 5)], CALLS)
    old = spark.createDataFrame([(8, 1, 700, 710, 2, 900, 950, "+", "-", 5), (9, 1, 701, 710, 2, 900, 950, "+", "-", 5)], CALLS)
    assert {tuple(r) for r in compare.compare_calls(old, new).collect()} == {(1, 1, "COMMON"), (2, 0, "UNIQUE")}


def test_discard_small(spark):
    rows = [(1, 1, 0, 10, 1, 100, 110, "+", "+", 9), (2, 1, 0, 10, 1, 100, 110, "+", "+", 10), (3, 1, 0, 10, 1, 9000, 9010, "-", "-", 3), (4, 1, 0, 10, 1, 400, 410, "+", "-", 99), (5, 1, 0, 10, 2, 100, 110, "+", "+", 1)]
    assert {r["id"] for r in compare.discard_small(spark.createDataFrame(rows, CALLS)).collect()} == {2, 5}


def test_regions_and_segments(spark):
    reads = spark.createDataFrame([("a", 1, 0, 10), ("b", 1, 10, 20), ("c", 2, 0, 10)], "qname string, chr int, start long, end long")
    regions = spark.createDataFrame([(5, 1, 5, 10)], "seg_id long, chr int, start long, end long")
    assert {r["qname"] for r in compare.exclude_overlapping(reads, regions).collect()} == {"b", "c"}
    points = spark.createDataFrame([(1, b, float(b)) for b in range(10)], "chr int, bin long, v double")
    segments = spark.createDataFrame([(1, 1, 0, 5000), (2, 1, 0, 4500), (3, 2, 0, 10)], "seg_id long, chr int, start long, end long")
    got = {r["seg_id"]: (r["n_win"], r["median"]) for r in compare.segment_medians(points, segments, "v").collect()}
    assert got == {1: (10, 4.5), 2: (9, None), 3: (0, None)}


def test_a_string_of_the_least_length_is_found_at_every_place(spark):
    import random

    rng = random.Random(3)
    letters = lambda n: "".join(rng.choices("ACGT", k=n))
    entry = letters(200)
    long, short = entry[60:140], entry[60:139]
    # the letters on either side of the string differ from the entry's
    other = {a: "CGTA"["ACGT".index(a)] for a in "ACGT"}
    rows = [(2 * p, letters(p) + other[entry[59]] + long + other[entry[140]] + letters(300)) for p in range(90)]
    rows += [(2 * p + 1, letters(p) + other[entry[59]] + short + other[entry[139]] + letters(300)) for p in range(90)]
    reads = spark.createDataFrame(rows, "read_id long, seq string")
    found = sequences.contaminant_hits(reads, spark.createDataFrame([(1, entry)], "item_id long, seq string")).collect()
    assert {(r.read_id, r.item_id, r.score) for r in found} == {(2 * p, 1, 80) for p in range(90)}
    every = sequences.kmer_rows(reads, 40, step=41).groupBy("read_id").agg({"pos": "collect_set"}).collect()
    assert all(sorted(r[1]) == list(range(0, len(rows[r.read_id // 2 + 90 * (r.read_id % 2)][1]) - 39, 41)) for r in every)


def test_reads_of_one_name_and_start_are_excluded_by_their_own_ends(spark):
    from svweave.operators import compare

    reads = spark.createDataFrame([("a", 1, 10, 15), ("a", 1, 10, 25), ("b", 1, 10, 20), ("c", 2, 10, 40), (None, 1, 50, 60)], "qname string, chr long, start long, end long")
    regions = spark.createDataFrame([(1, 20, 30), (1, 20, 30)], "chr long, start long, end long")
    left = compare.exclude_overlapping(reads, regions).collect()
    assert sorted(map(repr, map(tuple, left))) == sorted(map(repr, [("a", 1, 10, 15), ("b", 1, 10, 20), ("c", 2, 10, 40), (None, 1, 50, 60)]))
