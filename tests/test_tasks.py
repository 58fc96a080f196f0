"""Steps whose tasks grow with their rows."""

import random

from pyspark.sql import functions as F

from svweave.operators import grouping, interval, reads, results


def test_exclusion_by_name_is_dealt_to_as_many_tasks_as_rows_ask_for(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(reads, "tasks_for", lambda s, rows: asked.append(rows) or 7)
    rows = spark.createDataFrame([(f"r{i % 50}" if i % 10 else None, i) for i in range(100)], "qname string, mapq int")
    got = reads.exclude_by_qname(rows.unionByName(rows.limit(0)), rows.filter("mapq < 30"))
    assert asked == [100] and got.rdd.getNumPartitions() == 7
    assert sorted(r.mapq for r in got.collect()) == sorted(i for i in range(100) if not i % 10 or 30 <= i % 50)


def test_original_mappings_meet_reads_without_a_join(spark):
    table = spark.createDataFrame([(f"r{i}", m, 10 * i + m, i) for i in range(5) for m in (1, 2)], "qname string, mate int, mapq int, x1 int")
    got = results.augment_original(table.drop("x1"), table.withColumn("mapq", F.col("mapq") + 100), pairwise=True)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.qname, r.mate): (r.mapq, r.zm, r.z1) for r in got.collect()} == {(f"r{i}", m): (10 * i + m, 100 + 10 * i + m, i) for i in range(5) for m in (1, 2)}


def test_islands_over_blocks_equal_a_plain_walk(spark):
    rng = random.Random(2)
    rows = [(k, lo, lo + rng.choice([0, 1, 3, 8, 60]), i) for i, (k, lo) in enumerate((rng.choice(["a", None]), rng.randrange(600)) for _ in range(150))] + [("b", 5, 7, 1000), ("c", None, 7, 1001), ("c", 8, None, 1002), ("c", 9, 12, 1003)]
    want = {}
    for k in {r[0] for r in rows}:
        reach, n = None, 0
        for _, lo, hi, i in sorted((r for r in rows if r[0] == k), key=lambda r: (r[1] is not None, r[1] or 0, r[3])):
            n += reach is None or (lo is not None and lo >= reach)
            want[i] = n
            reach = hi if reach is None else reach if hi is None else max(reach, hi)
    got = interval.interval_islands(spark.createDataFrame(rows, "k string, lo int, hi int, i int"), ["k"], "lo", "hi", ["lo", "i"], size=10)
    assert got.columns == ["k", "lo", "hi", "i", "island"] and {r.i: r.island for r in got.collect()} == want


def test_counts_of_groups_move_members_once_by_group_and_name(spark):
    rows = [("g", "r1", "T1"), ("g", "r1", "T1"), ("g", "r1", "N1"), ("g", "r2", "NP_1"), ("g", "r2", "NP_2"), ("g", "r3", "NP_1"), ("g", None, "NP_3"), ("g", "r4", None), (None, "r1", "T1"), (None, None, "T1")]
    got = grouping.sample_counts(spark.createDataFrame(rows, "g string, qname string, sample string"), ["g"], "T1", "N1", rows=10)
    assert "Expand" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert {r.g: tuple(r)[1:] for r in got.collect()} == {"g": (1, 1, 2, 3, 8), None: (1, 0, 0, 0, 2)}
