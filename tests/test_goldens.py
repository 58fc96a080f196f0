"""Published example rows of the call filters with the answers their rules give."""

import pytest
from pyspark.sql import functions as F

from svweave.functions import expr
from svweave.operators import calls, compare, reads

CALLS = "chr1 string, start1 long, end1 long, chr2 string, start2 long, end2 long, id long, strand1 string, strand2 string"
# fixed values
TRANSLOCATIONS = [
    ("1", 1053002, 1053304, "22", 20259436, 20259793, 1, "-", "-"), ("1", 1054809, 1055200, "22", 20290394, 20290702, 2, "+", "+"),
    ("2", 164561027, 164561434, "12", 64127993, 64128406, 93, "-", "+"), ("2", 164568941, 164569503, "12", 64110667, 64111071, 94, "+", "-"),
    ("2", 164588254, 164588755, "12", 64110467, 64111032, 96, "+", "-"), ("6", 34170721, 34171180, "6", 34177731, 34178086, 233, "+", "+"),
    ("6", 34171258, 34171636, "6", 34177604, 34178152, 234, "-", "-"),
]
OCCURRENCES = [("7", 5008576, 5008973, "10", 103127395, 103127872, 296, "+", "-"), ("7", 5828209, 5828789, "10", 103127892, 103128416, 298, "+", "+"), ("X", 153693511, 153693804, "X", 153707925, 153708322, 645, "-", "+"), ("14", 106880517, 106880861, "15", 64013659, 64014017, 531, "-", "+")]
COPY_NUMBER = [
    ("16", 28242180, 28242619, "16", 28248441, 28248833, 557), ("17", 70712499, 70712840, "X", 11320396, 11320828, 578), ("18", 8803641, 8804002, "18", 8819049, 8819398, 583),
    ("20", 13610316, 13610683, "20", 14519541, 14519930, 608), ("20", 60003105, 60003403, "20", 60025648, 60026005, 620), ("X", 132645275, 132645649, "X", 132654551, 132654817, 644),
    ("X", 86724103, 86724612, "X", 86728164, 86728638, 638), ("X", 62668787, 62669197, "X", 62676047, 62676458, 637), ("18", 11568132, 11568592, "18", 51159606, 51159962, 586),
]
SEGMENTS = {
    "A": ["1,16,28242620,28242640,1,2,3,4", "2,17,70712390,70712400,1,2,3,4", "3,20,13610400,13610410,4,3,2,1", "4,X,62676045,62676050,1,2,3,1", "5,18,51159965,51159980,1,1,1,1"],
    "B": ["1,16,28248820,28248830,1,2,1,4", "2,20,60025600,60025645,4,1,2,1", "3,X,62669200,62676050,4,3,2,1", "4,18,51159960,51159970,0,0,0,0", "4,18,11568132,11568133,1,0,1,0"],
    "N": ["start segment,16,28242175,28242176,2,1,3,1", "start segment,20,14519935,14519938,2,1,3,0", "start segment,X,62669190,62669200,4,2,3,1", "start segment,18,51159605,51159610,1,1,1,1"],
}
#: Low and high start, and the distance between them, of calls on one chromosome.
DISTANCES = [(1786279, 1795740, 9461), (2585088, 2602775, 17687), (2585787, 2619481, 33694), (2615023, 2618096, 3073), (2626790, 2627997, 1207)]


def test_translocations_and_inversions(spark):
    df = spark.createDataFrame(TRANSLOCATIONS, CALLS)
    assert {(r.id, r.bal_trans) for r in calls.flag_balanced(df, 100_000).collect()} == {(1, "2"), (2, "1"), (93, "94,96"), (94, "93"), (96, "93")}
    assert {(r.id, r.inv) for r in calls.flag_inversions(df, 1000).collect()} == {(233, "234"), (234, "233")}


def test_occurrences(spark):
    got = {r.id: (r.occ_l, r.occ_h) for r in calls.flag_occurrences(spark.createDataFrame(OCCURRENCES, CALLS), 500).collect()}
    assert got == {296: (1, 2), 298: (1, 2), 645: (1, 1), 531: (1, 1)}


def test_copy_number_flags(spark, tmp_path):
    from svweave.sources import text

    segments = None
    for source, lines in SEGMENTS.items():
        (tmp_path / source).write_text("\n".join(lines))
        own = text.read_cn_segments(spark, str(tmp_path / source), source)
        segments = own if segments is None else segments.unionByName(own)
    df = spark.createDataFrame([(*r, "+", "-") for r in COPY_NUMBER], CALLS)
    both = dict(calls.flag_cn_changepoints(df, segments, 500).collect())
    want = {r[6]: "_" for r in COPY_NUMBER} | {557: "AN_B", 608: "A_N", 637: "NB_AB"}
    assert both == want
    assert dict(calls.flag_cn_changepoints(df, segments, 500, one_end=True).collect()) == want | {578: "A_", 620: "_B"}


def test_distances(spark):
    rows = spark.createDataFrame([(a, a + 400, b) for a, b, _ in DISTANCES], "s1 long, e1 long, s2 long")
    got = rows.select("s1", "s2", expr.breakpoint_distance(F.lit(1), F.lit(1), F.col("s1"), F.col("s2")).alias("d"), expr.sv_distance(F.lit(1), F.lit(1), F.col("e1"), F.col("s2")).alias("far"))
    assert {tuple(r) for r in got.collect()} == {(a, b, d, abs(b - a - 400)) for a, b, d in DISTANCES}


def test_somatic_tests_in_order(spark):
    names = CALLS + ", tumour_count long, normal_count long, np_count long, np_sample_count long, repeats string"
    base = dict(chr1="1", start1=999, end1=1400, chr2="1", start2=1099, end2=1500, id=1, strand1="+", strand2="-", tumour_count=5, normal_count=0, np_count=0, np_sample_count=0, repeats="")
    cases = [
        ({}, "distance"), ({"start2": 1100}, None), ({"chr2": "hs37d5cs"}, "decoy"), ({"start2": 999, "end2": 1400, "tumour_count": 0}, "identical"), ({"repeats": "AluS", "tumour_count": 0}, "repeats"),
        ({"start2": 3000, "end2": 3400, "strand2": "+", "np_count": 2}, None), ({"start2": 3000, "end2": 3400, "strand2": "+", "np_count": 2, "np_sample_count": 1}, "panel_samples"),
        ({"start2": 3000, "np_count": 1}, "panel"), ({"start2": 500}, "order"), ({"tumour_count": 3}, "tumour"), ({"normal_count": 1}, "normal"),
    ]
    rows = [tuple((base | change | {"id": k}).values()) for k, (change, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, names)
    assert [r.fail_reason for r in calls.fail_reason(df, discard_repeats=True).orderBy("id").collect()] == [want for _, want in cases]
    with pytest.raises(Exception, match="low end lies above"):
        calls.fail_reason(df.filter("start2 = 500"), strict=True).collect()
    assert (calls.min_tumour_reads(30), calls.min_tumour_reads(25)) == (4, 2)


def test_small_inversions_by_nearest_bounds(spark):
    df = spark.createDataFrame([("1", 100, 9000, "1", 9100, 20000, 1, "+", "+", 5), ("1", 100, 200, "1", 9100, 20000, 2, "+", "+", 5), ("1", 100, 9000, "1", 9100, 20000, 3, "+", "+", 10)], CALLS + ", tumour_count long")
    assert {r.id for r in compare.discard_small(df).collect()} == {2, 3}


def test_end_reads_overlap_their_windows(spark):
    df = spark.createDataFrame([("1", 1000, 1000, "1", 9000, 9000, 1, "+", "+")], CALLS)
    rows = [("in", 30, 9000), ("edge", 2, 8051), ("out", 0, 9000), ("late", 1101, 9000), ("mate", 900, 7999), ("far", 1000, 9101)]
    aligned = spark.createDataFrame([(q, "1", p, "+", "1", m, "+", 100, 1) for q, p, m in rows], "qname string, chr string, pos long, strand string, mate_chr string, mate_pos long, mate_strand string, read_len long, flag int")
    assert {r.qname for r in reads.collect_end_reads(df, aligned).collect()} == {"in", "edge"}
    assert {r.qname for r in reads.collect_end_reads(df, aligned, ignore_mate=True).collect()} == {"in", "edge", "mate", "far"}
    assert reads.collect_end_reads(df, aligned.withColumn("flag", F.lit(5))).count() == 0
    refs = spark.createDataFrame([("1",)], "chr string")
    marked = spark.createDataFrame([("a", "1", "="), ("b", "1", "*"), ("c", "1", "2"), ("d", "2", "=")], "qname string, chr string, mate_chr string")
    assert {r.qname for r in reads.limit_refs(marked, refs).collect()} == {"a", "b"}
