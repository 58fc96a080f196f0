import pytest

from svweave.operators import results, segments

CENTTEL = "chr string, ptel long, cen_start long, cen_end long, qtel long"
ENDS = "id string, chr1 string, pos1 long, strand1 string, chr2 string, pos2 long, strand2 string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_segments_and_breakpoints(spark):
    calls = spark.createDataFrame([("a", "1", 300, "+", "2", 50, "-"), ("b", "1", 520, "+", "1", 800, "-")], ENDS)  # b starts in the centromere
    centtel = spark.createDataFrame([("1", 10, 500, 600, 1000), ("2", 5, 0, 40, 200)], CENTTEL)
    breaks = spark.createDataFrame([("1", 300)], "chr string, pos long")
    got = segments.build_segments(calls, breaks, centtel)
    assert rows(got) == [
        ("1", 10, 300, "1_ptel", "a:1", False), ("1", 300, 300, "a:1", "cn_bkpt", False), ("1", 300, 500, "cn_bkpt", "centromere", False), ("1", 500, 600, "centromere", "centromere", False),
        ("1", 600, 1000, "centromere", "1_qtel", False), ("2", 5, 40, "2_ptel", "centromere", True), ("2", 40, 50, "centromere", "a:2", False), ("2", 50, 200, "a:2", "2_qtel", False),
    ]
    kept = segments.attach_breakpoints(got.filter("start_bkpt <> 'cn_bkpt'"), calls)
    assert rows(kept.filter("low_bkpt IS NOT NULL OR high_bkpt IS NOT NULL").select("start", "low_bkpt", "high_bkpt")) == [(10, None, "a:1"), (50, "a:2", None)]
    gone = segments.attach_breakpoints(got, calls.filter("id = 'b'"))
    assert {r.low_boundary for r in gone.filter("start_bkpt LIKE 'a:%'").collect()} == {"cn_bkpt"}


def test_support_reads(spark):
    calls = spark.createDataFrame([("a", "1", 5000, "+", "1", 9000, "+")], ENDS)
    schema = "qname string, mate int, chr string, pos long, strand string, mate_chr string, mate_pos long, mate_strand string, read_len long, flag int"
    spots = [("in", 5000, 9000, 1), ("late", 6001, 9000, 1), ("edge", 3901, 9000, 1), ("short", 3900, 9000, 1), ("supplementary", 5000, 9000, 2049), ("unpaired", 5000, 9000, 0), ("another", 5000, 9000, 1)]
    reads = spark.createDataFrame([(n, 1, "1", p, "+", "1", m, "+", 100, f) for n, p, m, f in spots], schema)
    names = spark.createDataFrame([("a", n) for n, *_ in spots if n != "another"], "id string, qname string")
    assert rows(segments.collect_support_reads(calls, reads.unionByName(reads), names).select("qname")) == [("edge",), ("in",)]


def test_remap_scores(spark):
    reads = spark.createDataFrame([("a", "low", k) for k in "xyz"] + [("a", "high", "x"), ("b", "low", "u"), ("b", "low", "v"), ("b", "low", "w")], "id string, side string, read_id string")
    scores = spark.createDataFrame([("x", False, 90), ("x", True, 70), ("y", False, 40), ("z", True, 99)], "read_id string, target boolean, score int")
    assert rows(segments.remap_scores(reads, scores).filter("id = 'a'")) == [("a", "high", 1, None), ("a", "low", 3, 40)]
    assert rows(segments.remap_scores(reads, scores).filter("id = 'b'")) == [("b", "low", 3, None)]


def test_merge_calls_and_coverage(spark):
    calls = spark.createDataFrame([(1, "7", "1", 10, 20, "r1,r2", 2, 1), (1, "9", "1", 5, 15, "r2,r3", 2, 4), (2, "8", "1", 0, 1, "", 0, 0)], "k int, id string, chr1 string, start1 int, end1 int, names string, tumour_count int, normal_count int")
    got = {r.k: r for r in segments.merge_calls(calls, "k").collect()}
    assert (got[1].id, got[1].start1, got[1].end1, got[1].names, got[1].tumour_count, got[1].normal_count) == ("7,9", 5, 20, "r1,r2,r3", 3, 5)
    assert (got[2].names, got[2].tumour_count) == ("", 0)
    with pytest.raises(Exception, match="chr1 differs within 1"):
        segments.merge_calls(calls.selectExpr("k", "id AS chr1"), "k").collect()
    parts = spark.createDataFrame([("1", 0, 5), ("2", 0, 6), ("3", 0, 7)], "chr string, start int, depth int")
    refs = spark.createDataFrame([("2", 0), ("1", 1)], "chr string, ref_idx int")
    assert [tuple(r) for r in segments.merge_coverage(parts, refs).collect()] == [("2", 0, 6), ("1", 0, 5)]
    with pytest.raises(ValueError, match="no coverage of 1"):
        segments.merge_coverage(parts.filter("chr <> '1'"), refs)


def test_merged_calls_recompute_what_depends_on_them(spark):
    columns = "k int, id string, chr1 string, start1 int, end1 int, start2 int, end2 int, names string, tumour_count int, normal_count int, bkpt_distance int, occ_l int, count int"
    calls = spark.createDataFrame([(1, "a", "1", 10, 20, 50, 60, "r1,r2", 2, 1, 40, 7, 3), (1, "b", "1", 12, 30, 45, 55, "r2,r3", 2, 4, 33, 9, 6), (2, "c", "1", 5, 6, 9, 9, "r9", 4, 0, 77, 1, 8), (3, "d", "1", 1, 1, 1, 1, "x", 1, 0, -1, 1, 1), (3, "e", "1", 1, 1, 1, 1, "y", 1, 0, -1, 2, 1)], columns)
    got = {r.k: (r.tumour_count, r.bkpt_distance, r.occ_l, r["count"]) for r in segments.merge_calls(calls, "k").collect()}
    assert got == {1: (3, 35, 9, 8), 2: (4, 77, 1, 8), 3: (2, -1, 2, 2)}
    mixed = spark.createDataFrame([(1, "a", 1, 2, 3, 4, -1), (1, "b", 1, 2, 3, 4, 5)], "k int, id string, start1 int, end1 int, start2 int, end2 int, bkpt_distance int")
    with pytest.raises(Exception, match="within and across"):
        segments.merge_calls(mixed, "k").collect()


def test_arm_copy_numbers(spark):
    schema = "chr string, start long, end long, low_boundary string, high_boundary string, cn double"
    whole = [("1", 1, 5, "1_ptel", "rg", 2.0), ("1", 5, 9, "rg", "centromere", 4.0), ("1", 9, 12, "centromere", "centromere", 9.0), ("1", 12, 20, "centromere", "rg", None), ("1", 20, 30, "rg", "1_qtel", 3.0)]
    assert rows(results.arm_cn(spark.createDataFrame(whole, schema))) == [("1", 3.0)]
    for part in (whole[1:], whole[:-1], [(*r[:5], None) for r in whole]):
        with pytest.raises(Exception, match="missing on 1"):
            results.arm_cn(spark.createDataFrame(part, schema)).collect()


def test_original_mappings_meet_one_to_one(spark):
    reads = spark.createDataFrame([("a", 1, 7), ("a", 2, 8), ("b", 1, 9)], "qname string, mate int, mapq int")
    old = spark.createDataFrame([("a", 1, 1, 5), ("a", 2, 2, None), ("b", 1, 3, 6), ("c", 1, 4, 4)], "qname string, mate int, mapq int, x1 int")
    assert rows(results.augment_original(reads, old)) == [("a", 1, 7, 1, 5), ("a", 2, 8, 2, None), ("b", 1, 9, 3, 6)]
    for mine, other, pairwise, text in ((reads, old.filter("qname <> 'b'"), False, "no original"), (reads.union(reads), old, False, "more than once"), (reads, old.union(old), False, "more than once"), (reads, old, True, "no mate")):
        with pytest.raises(Exception, match=text):
            results.augment_original(mine, other, pairwise).collect()


def test_remapping_filter(spark):
    calls = spark.createDataFrame([("a", 5), ("b", 5), ("c", 5), ("d", 5), ("e", 5), ("f", 5)], "id string, score int")
    schema = "id string, low_score int, high_score int, low_footprint int, high_footprint int, has_n boolean, small_indel boolean, microbes int"
    judged = [("a", 81, 81, 51, 51, False, False, 4), ("b", 80, 99, 99, 99, False, False, 0), ("c", None, None, 99, 99, True, True, None), ("d", 99, 99, 99, 99, False, False, 5), ("e", 99, 99, 50, 99, False, False, 0), ("f", 99, 99, 99, 99, True, False, 0)]
    assert rows(results.filter_remap(calls, spark.createDataFrame(judged, schema)).select("id")) == [("a",), ("c",)]
