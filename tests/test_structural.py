"""Structural-variant operators: known answers, and the sweep against a global one."""

import random

from pyspark.sql import functions as F

from svweave.functions import expr
from svweave.operators import calls, grouping
from svweave.sources import text

CALLS = "id long, chr1 long, start1 long, end1 long, chr2 long, start2 long, end2 long, strand1 string, strand2 string, tumour_count long"


def test_balanced_and_inversions(spark):
    df = spark.createDataFrame(
        [(1, 1, 100, 110, 2, 500, 510, "+", "-", 4), (2, 1, 900, 910, 2, 900, 910, "-", "+", 4), (3, 1, 500_000, 500_010, 2, 500, 510, "-", "+", 4),
         (4, 3, 100, 110, 3, 9000, 9010, "+", "+", 4), (5, 3, 400, 410, 3, 9300, 9310, "-", "-", 4), (6, 3, 5000, 5010, 3, 9300, 9310, "-", "-", 4)], CALLS)
    assert {(r.id, r.bal_trans) for r in calls.flag_balanced(df).collect()} == {(1, "2"), (2, "1")}
    assert {(r.id, r.inv) for r in calls.flag_inversions(df).collect()} == {(4, "5"), (5, "4")}


def test_copy_number_flags(spark):
    df = spark.createDataFrame([(1, 1, 1000, 1010, 1, 9000, 9010, "+", "-", 4), (2, 1, 1000, 1010, 1, 5000, 5010, "+", "-", 4)], CALLS)
    seg = spark.createDataFrame([("A", 1, 900, 9100), ("B", 1, 8900, 20_000)], "source string, chr long, start long, end long")
    both = dict(calls.flag_cn_changepoints(df, seg, 500).collect())
    one = dict(calls.flag_cn_changepoints(df, seg, 500, one_end=True).collect())
    assert both == {1: "A_AB", 2: "_"} and one == {1: "A_AB", 2: "A_"}


def test_merge_double_calls(spark):
    df = spark.createDataFrame([(9, 1, 100, 200, 2, 100, 200, "+", "-", 4), (10, 1, 250, 300, 2, 150, 260, "+", "-", 4), (3, 1, 5000, 5100, 2, 100, 200, "+", "-", 9)], CALLS)
    got = {r.id: (r.start1, r.end1, r.start2, r.end2) for r in calls.merge_double_calls(df).collect()}
    assert got == {10: (100, 300, 100, 260), 3: (5000, 5100, 100, 200)}  # 9 > 10 as text


def global_sweep(rows):
    active, done = [], []
    for r in rows:
        still, joined = [], False
        for g in active:
            if g[0] <= r["l5"] and g[4] == r["strand_l"] and g[6] == (r["chr_l"], r["chr_h"]):
                done.append(g)
                continue
            still.append(g)
            if g[4:7] == [r["strand_l"], r["strand_h"], (r["chr_l"], r["chr_h"])] and g[1] <= r["l3"] and r["l5"] <= g[0] and g[3] <= r["h3"] and r["h5"] <= g[2]:
                g[0], g[1], g[2], g[3] = min(g[0], r["l3"]), max(g[1], r["l5"]), min(g[2], r["h3"]), max(g[3], r["h5"])
                g[7].append(r["qname"])
                joined = True
        active = still
        if not joined:
            active.append([r["l3"], r["l5"], r["h3"], r["h5"], r["strand_l"], r["strand_h"], (r["chr_l"], r["chr_h"]), [r["qname"]]])
    return sorted(sorted(g[7]) for g in done + active)


def test_islands_equal_the_global_sweep(spark):
    rng = random.Random(3)
    rows = [(f"q{k}", "T1", rng.randint(1, 2), rng.randint(1, 4000), rng.choice("+-"), rng.randint(1, 2), rng.randint(1, 4000), rng.choice("+-"), 60, 1, rng.choice([200, 345, 420]), rng.choice([75, 100])) for k in range(400)]
    pairs = spark.createDataFrame(rows, "qname string, sample string, chr_l long, pos_l long, strand_l string, chr_h long, pos_h long, strand_h string, mapq int, flag int, max_insert long, read_len long")
    members = grouping.group_members(pairs, 5000).toPandas()
    got = sorted(sorted(g.qname) for _, g in members.groupby(["chr_l", "strand_l", "chr_h", "island", "number"]))
    local = [r.asDict() for r in grouping.with_windows(pairs, 5000).orderBy(*grouping.ORDER).collect()]
    assert got == global_sweep(local)


def test_sweep_holds_no_members(spark):
    """A deep island passes as a stream: members leave while it is still read, not at its end."""
    import pyarrow as pa

    rows = 50_000
    fixed = {"chr_l": 1, "strand_l": "+", "chr_h": 2, "island": 1, "strand_h": "-", "l5": 100, "l3": 500, "h5": 900, "h3": 1300, "sample": "T1"}
    read = 0

    def batches():
        nonlocal read
        for k in range(0, rows, 1000):
            read += 1000
            yield pa.RecordBatch.from_pydict({**{c: [v] * 1000 for c, v in fixed.items()}, "qname": [f"q{k + i}" for i in range(1000)]})

    most, members, groups = 0, 0, []
    for b in grouping.sweep(batches()):
        members += b.num_rows - len(ended := [r for r in b.to_pylist() if r["number"] is not None])
        groups += ended
        most = max(most, read - members)
    assert most <= 2 * 10_000 and members == rows
    assert [(g["opened"], g["number"], g["l5"], g["l3"], g["h5"], g["h3"]) for g in groups] == [(0, 0, 100, 500, 900, 1300)]


def test_islands_are_dealt_and_numbered_together(spark):
    """More islands of one key than one numbering takes: (island, number) stay unique and count on over islands."""
    rows = [(f"q{k}", "T1", 1, 1 + 1000 * (k // 2), "+", 2, 500 + 5000 * (k % 2), "-", 60, 1, 345, 100) for k in range(600)]
    pairs = spark.createDataFrame(rows, "qname string, sample string, chr_l long, pos_l long, strand_l string, chr_h long, pos_h long, strand_h string, mapq int, flag int, max_insert long, read_len long")
    members = grouping.group_members(pairs, 1_000_000)
    got = sorted((r.island, r.number) for r in members.collect())
    assert got == [(0, k) for k in range(510)] + [(1, k) for k in range(90)]
    odd = pairs.limit(1).withColumn("chr_h", F.lit(None).cast("long"))
    assert grouping.group_members(odd, 1_000_000).count() == 1
    assert "FlatMapGroupsInPandas" not in members._jdf.queryExecution().toString()


def test_expressions_and_sources(spark, tmp_path):
    row = spark.range(1).select(expr.revcomp(F.lit("AACG")), expr.ref_end(F.lit(10), F.lit("5S10M2D3M")), expr.clip_side(F.lit("5S10M")), expr.sanitise_sample(F.lit("a b/c"))).first()
    assert tuple(row) == ("CGTT", 24, "low", "a_b_c")
    (tmp_path / "x.sam").write_text("@RG\tID:1\tSM:T\tMI:Z:345\nq\t99\t1\t5\t60\t5M\t=\t90\t100\tACGTA\t*\tRG:Z:1\tX1:i:3\n")
    got = text.read_sam(spark, str(tmp_path / "x.sam")).first()
    assert (got.qname, got.flag, got.pos, got.tags) == ("q", 99, 5, {"RG": "1", "X1": "3"})
    assert tuple(text.read_groups(spark, str(tmp_path / "x.sam")).first()) == ("1", "T", 345)
