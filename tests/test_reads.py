"""Read preparation, support and smoothing: known answers."""

import random

from svweave.operators import reads

ALIGNED = "qname string, mate int, chr long, pos long, strand string, mate_chr long, mate_pos long, mate_strand string, mapq int, read_len long, tlen long, cigar string"


def row(qname, mate, pos, mapq=60, cigar="100M", tlen=0, chr=1, mate_chr=1, strand="+", mate_pos=5000, mate_strand="-"):
    return (qname, mate, chr, pos, strand, mate_chr, mate_pos, mate_strand, mapq, 100, tlen, cigar)


def test_pairs(spark):
    df = spark.createDataFrame([row("a", 1, 10, tlen=490), row("a", 2, 400, tlen=-490), row("b", 1, 10), row("c", 1, 10, 3), row("c", 2, 10), row("d", 1, 10, tlen=150), row("d", 2, 60, tlen=-150), row("e", 1, 10, mate_chr=2), row("e", 2, 10, chr=2)], ALIGNED)
    assert {r.qname for r in reads.prep_pairs(df).collect()} == {"a", "e"}
    assert {r.qname for r in reads.exclude_by_qname(df, df.filter("mapq < 6"), df.filter("qname = 'e'")).collect()} == {"a", "b", "d"}
    assert reads.exclude_by_qname(df).count() == 9
    assert {r.qname for r in reads.limit_refs(df, spark.createDataFrame([(1,), (1,)], "chr long")).collect()} == {"a", "b", "c", "d"}


def test_clip_mode_and_footprint(spark):
    df = spark.createDataFrame([row("a", 1, 10, cigar="40S60M"), row("b", 1, 30, cigar="40S60M"), row("c", 1, 5), row("d", 1, 20, cigar="70M30S")], ALIGNED)
    assert tuple(reads.clip_mode(df, ["chr"], "low").first()) == (1, 2, 30)  # a tie: the larger start
    assert tuple(reads.clip_mode(df, ["chr"], "high").first()) == (1, 1, 104)  # one clipped read: the largest end
    assert tuple(reads.footprint(df, ["chr"]).first()) == (1, 100)
    assert reads.clip_mode(df.filter("false"), ["chr"], "low").count() == 0


def test_coverage_of_reads_and_segments(spark):
    placed = spark.createDataFrame([("a", 1, 1, 100, 200), ("b", 1, 1, 100, 300)], "qname string, mate int, chr long, start long, end long")
    features = spark.createDataFrame([(1, 90, 150), (1, 140, 192), (1, 90, 150)], "chr long, start long, end long")
    assert [tuple(r) for r in reads.covered_by(placed, features).collect()] == [("a", 1, 92)]
    segments = spark.createDataFrame([(1, 1, 150, 250), (2, 1, 900, 950)], "seg_id long, chr long, start long, end long")
    assert {r.seg_id: round(r.mean_depth, 6) for r in reads.segment_mean_depth(placed, segments).collect()} == {1: 1.51, 2: 0.01}
    got = {r.seg_id: (r.start, r.end) for r in reads.snap_segment_edges(segments).collect()}
    assert got == {1: (150, 575), 2: (575, 950)}


def test_end_reads(spark):
    call = spark.createDataFrame([(7, 1, 999, 1100, 1, 4999, 5100, "+", "-", 4)], "id long, chr1 long, start1 long, end1 long, chr2 long, start2 long, end2 long, strand1 string, strand2 string, tumour_count long")
    df = spark.createDataFrame([row("a", 1, 50), row("b", 1, 49), row("c", 1, 1149, mate_pos=5949), row("d", 1, 1150), row("e", 1, 1000, mate_strand="+"), row("f", 1, 1000, mate_pos=4849)], ALIGNED)
    assert {tuple(r) for r in reads.collect_end_reads(call, df).collect()} == {(7, "a"), (7, "c")}


def test_running_median(spark):
    points = [(1, k, float(v)) for k, v in enumerate([9, 1, 2, 8, 3, 4, 0])] + [(2, k, float(v)) for k, v in enumerate([5, 1, 7])]
    out = reads.running_median(spark.createDataFrame(points, "chr long, bin long, v double"), "v").orderBy("chr", "bin").collect()
    assert [r.smooth for r in out] == [2, 2, 3, 3, 3, 3, 3, 5, 1, 7]


def test_a_read_meets_the_union_of_overlapping_features_once(spark):
    from svweave.operators import reads

    features = spark.createDataFrame([(1, 100 + k, 160 + k) for k in range(40)] + [(1, 199, 205), (1, 300, 300), (2, 0, 10), (None, 5, 9)], "chr long, start long, end long")
    whole = {tuple(r) for r in reads.united(features).collect()}
    assert whole == {(1, 100, 199), (1, 199, 205), (1, 300, 300), (2, 0, 10), (None, 5, 9)}
    mine = spark.createDataFrame([("a", 1, 1, 110, 210), ("b", 1, 1, 110, 216), ("c", 2, 2, 0, 20), ("d", 1, 1, 296, 304), ("e", 1, 1, 50, 100)], "qname string, mate int, chr long, start long, end long")
    assert {tuple(r) for r in reads.covered_by(mine, features).collect()} == {("a", 1, 95), ("c", 2, 10), ("d", 1, 0)}


def test_keys_with_names_count_different_names(spark):
    rng = random.Random(4)
    rows = [(k, f"n{rng.randint(0, k)}") for k in range(40) for _ in range(30)] + [(50, None)] * 9 + [(51, "a"), (51, "b"), (51, None), (51, None)]
    # names of one bit are told apart all the same
    many = [r.v for r in spark.range(4000).selectExpr("'x' || id AS v").filter("pmod(xxhash64(v), 64) = 7").limit(20).collect()]
    rows += [(60, v) for v in many[:4]] + [(61, v) for v in many[:3] * 5]
    names = {}
    for k, v in rows:
        names.setdefault(k, set()).update({v} - {None})
    df = spark.createDataFrame(rows, "id long, qname string").repartition(3)
    for least in (1, 4, 20):
        got = sorted(r.id for r in reads.keys_with_names(df, ["id"], "qname", least).collect())
        assert got == sorted(k for k, v in names.items() if len(v) >= least), least
    assert len(many) == 20 and reads.keys_with_names(df.limit(0), ["id"], "qname", 4).count() == 0


def test_calls_of_a_support_move_no_names(spark):
    from svweave.plans import copy_number_queries as by_copy
    from svweave.plans.views import BEDPE, view

    data = "/root/testdata/sf0.01"
    got = by_copy.supported_calls(spark, data, 4)
    want = view(spark, data, BEDPE).filter("tumour_count >= 4").selectExpr("id", "chr1", "start1 AS pos1", "chr2", "end2 AS pos2")
    assert 0 < want.count() == got.count() and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
