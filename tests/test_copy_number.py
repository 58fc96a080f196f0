import random

import numpy as np
import pytest

from svweave.operators import copy_number as cn


def natural(x, knots):
    u, at = (x - knots[0]) / (knots[-1] - knots[0]), (np.array(knots) - knots[0]) / (knots[-1] - knots[0])
    cube = lambda k: np.maximum(u - k, 0) ** 3
    curve = lambda k: (cube(k) - cube(at[-1])) / (at[-1] - k)
    return [u, *(curve(k) - curve(at[-2]) for k in at[:-2])]


@pytest.mark.parametrize("penalty", [0.0, 0.01])
def test_residuals_equal_a_dense_solve(spark, penalty):
    rng = np.random.default_rng(1)
    gc, fb, flat = rng.uniform(0.2, 0.7, 800), rng.gamma(2.0, 0.1, 800), np.full(800, 3.0)
    y = np.sin(6 * gc) + np.log(fb + 0.1) + rng.normal(0, 0.1, 800)
    rows = [(k, float(a), float(b), float(c), float(d)) for k, (a, b, c, d) in enumerate(zip(gc, fb, flat, y))] + [(800, None, 1.0, 3.0, 1.0), (801, 0.5, float("nan"), 3.0, 1.0), (802, 0.5, 0.1, 3.0, float("inf"))]
    df = spark.createDataFrame(rows, "k int, gc double, fb double, flat double, y double")
    got = {r.k: r.residual for r in cn.additive_residuals(df, "y", ["gc", "fb", "flat"], penalty).collect()}
    columns = [np.ones(800)]
    for x in (gc, fb):
        columns += natural(x, [float(np.quantile(x, q)) for q in cn.KNOTS])
    a = np.stack(columns, 1)
    ridge = np.diag([0.0, *([0.0] + [penalty * 800] * (len(cn.KNOTS) - 2)) * 2])
    want = y - a @ np.linalg.solve(a.T @ a + ridge, a.T @ y)
    assert np.allclose([got[k] for k in range(800)], want, atol=1e-6) and [got[k] for k in (800, 801, 802)] == [None] * 3
    assert want.std() < 0.5 * y.std()
    assert cn.additive_residuals(df.limit(0), "y", ["gc"]).count() == 0


def plain_cost(x, penalty, least):
    """Exact least cost over all partitions, a segment after the other."""
    best = [-penalty] + [np.inf] * len(x)
    for t in range(1, len(x) + 1):
        for s in range(t):
            if t - s >= least or (s == 0 and t == len(x)):
                part = x[s:t]
                best[t] = min(best[t], best[s] + ((part - part.mean()) ** 2).sum() + penalty)
    return best[-1]


def test_segments_cost_as_little_as_the_exact_optimum(spark):
    rng, rows, values = np.random.default_rng(7), [], {}
    for k in range(8):
        steps = rng.choice([0.0, 0.5, 1.0, 1.4], rng.integers(1, 9))
        x = np.concatenate([np.full(rng.integers(3, 60), s) for s in steps])
        x = x + rng.normal(0, 0.12, len(x))
        values[str(k)] = x
        rows += [(str(k), 7 + i, float(v)) for i, v in enumerate(x)]
    values["short"] = np.array([1.0, 2.0])
    rows += [("short", 3, 1.0), ("short", 9, 2.0), ("short", 10, None)]
    df = spark.createDataFrame(rows, "chr string, bin int, x double").repartition(5)
    for block in (32, 64, 2048):
        got = cn.segment_cn(df, "x", ["chr"], gamma=10.0, least=3, block=block, sd=0.12).collect()
        for c, x in values.items():
            segs, at = sorted((r.first, r.last, r.n_win, r.mean) for r in got if r.chr == c), 0
            cost = -10 * 0.12**2
            for first, last, n, mean in segs:
                part = x[at : at + n]
                assert np.isclose(mean, part.mean()) and (c == "short" or (first, last) == (7 + at, 7 + at + n - 1)) and (n >= 3 or len(segs) == 1)
                cost, at = cost + ((part - part.mean()) ** 2).sum() + 10 * 0.12**2, at + n
            assert at == len(x) and np.isclose(cost, plain_cost(x, 10 * 0.12**2, 3)), (block, c)
    assert cn.segment_cn(df.limit(0), "x", ["chr"]).count() == 0
    assert 0.05 < cn.robust_sd(df.filter("chr <> 'short'"), "x", ["chr"], "bin") < 0.2


def plain_rescue(rows, depth, purity):
    """Runs of one chromosome after another."""
    out, i = [list(r) for r in rows], 0
    while i < len(rows):
        if rows[i][3] is not None or rows[i][0] == "Y":
            i += 1
            continue
        j = i
        while j + 1 < len(rows) and rows[j + 1][0] == rows[i][0] and rows[j + 1][3] is None:
            j += 1
        left = rows[i - 1] if i and rows[i - 1][0] == rows[i][0] else None
        right = rows[j + 1] if j + 1 < len(rows) and rows[j + 1][0] == rows[i][0] else None
        involved = any(x not in ("cn_bkpt", "centromere") for r in rows[i : j + 1] for x in (r[4], r[5]))
        if rows[i][4].endswith("_ptel") and rows[i][5] == "centromere" and rows[i][6] == 0:
            involved = False
        parts = [depth.get((*r[:3], "own")) for r in rows[i : j + 1]] + [depth.get((*r[:3], p)) for r, p in ((left, "tail"), (right, "head")) if r]
        if (left or right) and involved and any(parts):
            for k in range(i, j + 1):
                own = (depth.get((*rows[k][:3], "own")) or 0.0) + 0.01
                est = [(own * (purity * r[3] + (1 - purity) * 2) / ((depth.get((*r[:3], p)) or 0.0) + 0.01) - (1 - purity) * 2) / purity for r, p in ((left, "tail"), (right, "head")) if r]
                open_end = (not left and k == i) or (not right and k == j)
                tiny = rows[k][2] - rows[k][1] <= 1 and not open_end
                out[k][3] = None if tiny else est[0] if len(est) == 1 else (max(0, est[0]) * max(0, est[1])) ** 0.5
        i = j + 1
    return out


def test_short_segments_are_rescued_as_in_a_plain_walk(spark):
    rng, rows = random.Random(4), []
    for c in ("1", "2", "13", "Y"):
        at = 1
        for k in range(40):
            size = rng.choice([0, 1, 50, 900, 30000])
            value = None if rng.random() < 0.6 else round(rng.uniform(0.5, 5), 2)
            names = [f"{c}_ptel" if k == 0 else rng.choice(["cn_bkpt", "centromere", "a:1"]), f"{c}_qtel" if k == 39 else "centromere" if k == 0 and c == "13" else rng.choice(["cn_bkpt", "centromere", "b:2"])]
            rows.append((c, at, at + size, value, *names, 0 if c == "13" else 1))
            at += size + 1
    df = spark.createDataFrame(rows, "chr string, start long, end long, cn double, start_bkpt string, end_bkpt string, ptel long")
    regions = cn.edge_regions(df).collect()
    depth = {(r.chr, r.start, r.end, r.part): rng.choice([None, 0.0, 12.5, 30.0, 41.0]) for r in regions}
    depths = spark.createDataFrame([(*k, v) for k, v in depth.items()], "chr string, start long, end long, part string, depth double")
    got = sorted(tuple(r) for r in cn.rescue_small_segments(df, depths, 0.7).select(*df.columns).collect())
    want = sorted(map(tuple, plain_rescue(rows, depth, 0.7)))
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert all((a[3] is None) == (b[3] is None) and (a[3] is None or np.isclose(a[3], b[3])) for a, b in zip(got, want))
    assert sum(r[3] is None for r in rows) > sum(r[3] is None for r in got) > 0
    spot = {(r.chr, r.start, r.part): (r.lo, r.hi) for r in regions}
    nxt = rows[1]
    assert spot["1", nxt[1], "head"] == (nxt[1], min(nxt[2], rows[0][2] + 10_000)) and spot["1", rows[0][1], "tail"] == (max(rows[0][1], nxt[1] - 10_000), rows[0][2])
