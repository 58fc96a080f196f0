"""Line dedup, hard negatives and spelling variants against plain versions."""

import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from svweave.llm import hard_negatives, line_dedup, spelling  # noqa: E402
from svweave.llm.common import text_table  # noqa: E402

SCHEMA = "doc_id long, text string, kept string, pack long, n long, hi long, word string"


def key(rows):
    return sorted(map(tuple, rows), key=repr)


def table(spark, rows):
    """Documents with columns that clash with the operators' own."""
    return spark.createDataFrame([(i, t, "c", 1, 2, 3, "w") for i, t in rows], SCHEMA).repartition(5)


def line_rows():
    rng = random.Random(3)
    often = ["All rights reserved", "  ALL rights Reserved\t", "Été", "été", "x", "home | news", "", "  "]
    say = lambda: " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randint(0, 40)) for _ in range(rng.randint(1, 4)))
    rows = [(None, None), (1, ""), (2, "\n"), (3, "x\nx\nx"), (3, "x\nx\nx"), (None, "x\nÉté"), (4, "a\r\nb\r\n")]
    rows += [(10 + k, "\n".join(rng.choice(often) if rng.random() < 0.3 else say() for _ in range(rng.randint(1, 12)))) for k in range(60)]
    return rows + [(90, "\n".join(say() for _ in range(20000)) + "\nAll rights reserved")]


@pytest.mark.parametrize("min_docs,batches,fan_in", [(10, 5, 2), (3, 1, 4)])
def test_line_dedup(spark, monkeypatch, min_docs, batches, fan_in):
    pack = line_dedup.packs
    monkeypatch.setattr(line_dedup, "packs", lambda docs: pack(docs.repartition(16)))  # so that every batch has packs
    rows = line_rows()
    out = line_dedup.line_dedup(text_table(table(spark, rows)), min_docs, 1, batches, fan_in)
    assert key(out.collect()) == key(brute.line_dedup(rows, min_docs))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("lines_")]


def test_line_dedup_of_short_keys_and_nothing(spark):
    rows = line_rows()[:30]
    assert key(line_dedup.line_dedup(text_table(table(spark, rows)), 2, 4).collect()) == key(brute.line_dedup(rows, 2, 4))
    assert line_dedup.line_dedup(text_table(table(spark, rows).limit(0))).count() == 0


def test_known_frequent_lines_leave_later_batches(spark):
    runs = line_dedup.LineRuns(spark, 3, fan_in=2)
    batch = lambda pairs: spark.createDataFrame([(1, k, n) for k, n in pairs], "hi long, lo long, n long")
    try:
        for pairs in ([(1, 2), (2, 1)], [(1, 1), (3, 1)], [(1, 9), (3, 1)]):
            runs.add(batch(pairs))
        assert [[spark.table(name).count() for name, _ in level] for level in runs.levels] == [[1], [3]]  # (1, 1) is settled
        assert {r.lo for r in runs.frequent().collect()} == {1}
        runs.add(batch([(3, 1)]))
        assert {r.lo for r in runs.frequent().collect()} == {1, 3}
    finally:
        runs.close()


def negative_rows(n=420, dim=8):
    rng = np.random.default_rng(4)
    middle = rng.normal(size=(4, dim))
    rows = [(k, (middle[k % 4] + rng.normal(size=dim) * 0.6) * rng.choice([0.2, 1.0, 3.0])) for k in range(n)]
    return [(k, int(rng.integers(0, 3)) if k % 9 else 7, [float(x) for x in v]) for k, v in rows]


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives(spark, monkeypatch, small):
    if small:  # many buckets, spans and chunks
        for name, value in (("BUCKET_ROWS", 16), ("SPAN_BUCKETS", 2), ("CHUNK_ANCHORS", (1, 2)), ("FOCUS", 3)):
            monkeypatch.setattr(hard_negatives, name, value)
    rows = negative_rows() + [(1000, 1, [0.5] * 8), (1001, 1, [0.5] * 8), (1002, 2, [0.5] * 8), (1003, 2, [0.5] * 8), (1100, 5, [0.0] * 8), (1200, 6, [-1.0] * 8), (1201, 6, [1.0] * 8)]
    left_out = [(2000, None, [1.0] * 8), (2100, 1, None), (2200, 1, [None] + [1.0] * 7), (2300, 1, [float("nan")] * 8), (2400, 1, [float("inf")] * 8), (None, 1, [1.0] * 8)]
    df = spark.createDataFrame([(i, v, y, "a", 1) for i, y, v in rows + left_out], "vec_id long, embedding array<double>, label int, id string, anchor int").repartition(3)
    whole = [(i, y, [int(np.floor(256 * x)) for x in v]) for i, y, v in rows]
    assert key(hard_negatives.mine(df).collect()) == key(brute.hard_negatives(whole))
    assert len(brute.hard_negatives(whole)) > 50


def test_hard_negatives_of_nothing_and_repeated_rows(spark):
    df = spark.createDataFrame([(0, [1.0], 1), (0, [1.0], 1), (1, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2), (2, [0.9], 2)], "vec_id long, embedding array<double>, label int")
    got = key(hard_negatives.mine(df).collect())
    assert got == key([(0, 1, k, 2, 65536, 256 * 230) for k in (1, 2)] * 2)
    assert hard_negatives.mine(df.limit(0)).count() == 0
    assert hard_negatives.mine(df.filter("label = 2")).count() == 0


def test_candidates_are_a_superset_of_what_reaches_the_score():
    rng = np.random.default_rng(2)
    for dim in (1, 2, 5):
        x = rng.integers(-300, 300, (200, dim))
        x[:3] = 0
        unit, length = hard_negatives._unit(x)
        lists = np.argsort(unit, axis=0, kind="stable").T.astype(np.uint16)
        bucket = hard_negatives.Bucket({"ids": np.arange(200).tobytes(), "tags": np.zeros(200, np.int64).tobytes(), "vecs": x.astype(np.int64).tobytes(), "lists": np.ascontiguousarray(lists).tobytes(), "longest": float(length.max())}, dim)
        pruned = 0
        for q in rng.integers(-300, 300, (40, dim)):
            scores = x @ q
            for reach in (-1.0, 0.0, 1.0, float(np.quantile(scores, 0.9)), float(scores.max())):
                found = bucket.candidates(q.astype(float), reach)
                assert set(np.flatnonzero(scores >= reach)) <= set(found)
                pruned += 200 - len(found)
        assert pruned > 1000


def word_rows():
    rng = random.Random(6)
    letters = "abcdeéÿÉ"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(40)]
    rows = [(None, None), (1, ""), (2, "4 + 4"), (None, "abcde Abcde ABCDE"), (3, "a" * 20_000 + " " + "a" * 20_000), (4, "a" * 20_000 + " " + "a" * 20_001 + " " + ("a" * 20_001 + " ") * 2)]
    for k in range(120):
        words = []
        for _ in range(30):
            w = list(base[min(rng.randint(0, 39), rng.randint(0, 39))])
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w[at : at + rng.randint(0, 1)] = rng.choice([[], [rng.choice(letters)]])
            words.append("".join(w))
        rows.append((10 + k, rng.choice([" ", "-", "1"]).join(words)))
    return rows + rows[10:14]


def test_spelling_variants(spark):
    rows = word_rows()
    out = spelling.spelling_variants(text_table(table(spark, rows)), typo_modulus=97)
    got = key(out.select("word", "form", "root", "n", "n_near", "form_n").collect())
    want = brute.variants(brute.vocabulary(rows))
    assert got == key(want) and sum(r[1] is not None for r in want) > 20
    assert spelling.spelling_variants(text_table(table(spark, rows).limit(0))).count() == 0


def test_chains_of_forms_and_every_alphabet(spark):
    counts = {"aaaaaa"[:5] + "b" * k: 3 * 2 ** (20 - k) for k in range(20)} | {"zzzzz": 3, "zzzzy": 5, "zzzyz": 5}
    vocabulary = spark.createDataFrame(list(counts.items()), "word string, n long")
    for symbols in (1, 50):
        out = spelling.group_variants(vocabulary, symbols=symbols).select("word", "form", "root", "n", "n_near", "form_n")
        assert key(out.collect()) == key(brute.variants(counts))


def test_no_step_broadcasts_words_or_neighbourhoods(spark, monkeypatch):
    plans, plain = [], spelling.stored

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, name)

    monkeypatch.setattr(spelling, "stored", seen)
    out = spelling.group_variants(spark.createDataFrame([("aaaaa", 9), ("aaaab", 3), ("zzzzz", 3)], "word string, n long"))
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert sorted(r.root for r in out.collect()) == ["aaaaa", "aaaaa", "zzzzz"]
    assert sum("SortMergeJoin" in p for p in plans) >= 5 and not any("Broadcast" in p for p in plans)


def test_neighbourhoods_hold_every_edit_once():
    words = ["abca", "x", "éé"]
    for key_, near in spelling.neighbourhoods(words, 3):
        assert len(np.unique(np.stack([key_, near]), axis=1).T) == len(near)
    at = {w: int(k) for w, k in zip(words, spelling.reduced_keys(words, 3))}
    found = {}
    for k, n in spelling.neighbourhoods(words, 3):
        for a, b in zip(k.tolist(), n.tolist()):
            found.setdefault(a, set()).add(b)
    for w in words:
        edits = [w[:k] + w[k + 1 :] for k in range(len(w))] + [w[:k] + c + w[k + d :] for k in range(len(w) + 1) for c in "abcxyzé" for d in (0, 1)]
        assert {int(x) for x in spelling.reduced_keys([e for e in edits if e], 3)} <= found[at[w]] | {0}
