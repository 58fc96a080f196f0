"""Copy number along chromosomes: additive correction, piecewise-constant segments, rescue of short segments."""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..sources.shared import stored

#: Quantiles at which splines have their knots.
KNOTS = (0.02, 0.25, 0.5, 0.75, 0.98)


def spline_columns(x: Column, knots: list[float]) -> list[Column]:
    """Natural cubic spline basis without its constant: ``x`` and, for each knot but the last two, its curve, all on the scale of the knots."""
    low, high = knots[0], knots[-1]
    u = (x - low) / (high - low)
    at = [(k - low) / (high - low) for k in knots]

    def cube(k: float) -> Column:
        past = F.greatest(u - k, F.lit(0.0))
        return past * past * past

    def curve(k: float) -> Column:
        return (cube(k) - cube(at[-1])) / (at[-1] - k)

    return [u, *(curve(k) - curve(at[-2]) for k in at[:-2])]


def additive_residuals(df: DataFrame, y: str, xs: list[str], penalty: float = 0.0, knots: tuple[float, ...] = KNOTS, out: str = "residual") -> DataFrame:
    """``df`` with ``out``, what ``y`` leaves over a sum of smooth functions of ``xs`` (natural cubic splines, least squares).

    Knots stand at quantiles of each of ``xs`` (exact ones; equal knots count once, and of fewer than three the function is a
    line, of one none). ``penalty`` weighs the curves' squared coefficients against the mean squared residual. The normal
    equations are sums over all rows, so that a few hundred numbers reach the driver. Rows with a null or non-finite value
    take no part and get null.
    """
    names = [y, *xs]
    fine = F.lit(True)
    for c in names:
        fine = fine & F.col(c).isNotNull() & (F.abs(F.col(c).cast("double")) < F.lit(float("inf")))
    known = df.filter(fine)
    places = known.agg(*(F.percentile(F.col(c).cast("double"), F.array(*(F.lit(q) for q in knots))).alias(f"q{k}") for k, c in enumerate(xs))).first()
    basis, curved = [F.lit(1.0)], [False]
    for k, c in enumerate(xs):
        at = sorted(set(places[k] or []))
        if len(at) < 2:
            continue
        columns = spline_columns(F.col(c).cast("double"), at)
        basis += columns
        curved += [False] + [True] * (len(columns) - 1)
    p, target = len(basis), F.col(y).cast("double")
    terms = known.select(target.alias("y"), *(b.alias(f"b{k}") for k, b in enumerate(basis)))
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    sums = terms.agg(F.count("*").alias("n"), *(F.sum(F.col(f"b{i}") * F.col(f"b{j}")).alias(f"s{i}_{j}") for i, j in pairs), *(F.sum(F.col(f"b{i}") * F.col("y")).alias(f"t{i}") for i in range(p))).first()
    if not sums["n"]:
        return df.withColumn(out, F.lit(None).cast("double"))
    left, right = np.zeros((p, p)), np.array([sums[f"t{i}"] for i in range(p)])
    for i, j in pairs:
        left[i, j] = left[j, i] = sums[f"s{i}_{j}"]
    left += np.diag(np.where(curved, penalty * sums["n"], 0.0))
    weights = np.linalg.lstsq(left, right, rcond=1e-12)[0]
    fitted = sum((b * float(w) for b, w in zip(basis[1:], weights[1:])), F.lit(float(weights[0])))
    return df.withColumn(out, F.when(fine, target - fitted))


def optimal_breaks(sums: np.ndarray, squares: np.ndarray, sizes: np.ndarray, penalty: float, least: int) -> list[int]:
    """Starts of the segments (but for 0) of the least squared error plus ``penalty`` for each; items may be sums of ``sizes`` points
    and a segment holds ``least`` points at least, unless there are fewer."""
    s, q, n = (np.concatenate([[0.0], np.cumsum(x)]) for x in (sums, squares, sizes))
    best, back = np.full(len(n), np.inf), np.zeros(len(n), np.int64)
    best[0] = -penalty
    for t in range(1, len(n)):
        # segments end at t and start where least points fit; the last one may take what is too few
        m = int(np.searchsorted(n, n[t] - least, "right"))
        if m == 0:
            m = 1 if t == len(n) - 1 else 0
        if m:
            size = n[t] - n[:m]
            cost = best[:m] + (q[t] - q[:m]) - (s[t] - s[:m]) ** 2 / size + penalty
            back[t] = int(cost.argmin())
            best[t] = cost[back[t]]
    cuts, t = [], len(n) - 1
    while t > 0 and back[t] > 0:
        t = int(back[t])
        cuts.append(t)
    return cuts[::-1]


def robust_sd(points: DataFrame, value: str, by: list[str], at: str) -> float:
    """Deviation of noise: 1.4826 times the median absolute difference of neighbours, over the square root of two."""
    apart = F.abs(F.col(value) - F.lag(value).over(Window.partitionBy(*by).orderBy(at)))
    middle = points.select(apart.alias("d")).agg(F.percentile("d", F.lit(0.5))).first()[0]
    return 1.4826 * (middle or 0.0) / 2**0.5


def segment_cn(points: DataFrame, value: str, by: list[str], at: str = "bin", gamma: float = 200.0, least: int = 5, block: int = 2048, sd: float | None = None) -> DataFrame:
    """``*by, first, last, n_win, mean``: stretches of equal copy number of ``points`` (``*by, at, value``; one row a place).

    They minimise squared error plus ``gamma * sd^2`` for each, with ``least`` points each at least. ``sd`` defaults to
    :func:`robust_sd`. Blocks of ``block`` places, with an eighth of it from each neighbour, are solved for a quarter of the
    penalty at once; their breaks, the two places on both sides of each and the blocks' bounds cut the points into runs, of which
    only sums go on, and the whole is solved over the runs. So no task holds a chromosome's points. Null values take no part.
    """
    sd = robust_sd(points, value, by, at) if sd is None else sd
    penalty = gamma * sd * sd
    known = points.filter(F.col(value).isNotNull() & F.col(at).isNotNull()).select(*by, F.col(at).cast("long").alias("at"), F.col(value).cast("double").alias("x"))
    side = block // 8
    own = F.floor(F.col("at") / block)
    near = F.array_distinct(F.array(own, F.floor((F.col("at") - side) / block), F.floor((F.col("at") + side) / block)))
    spread = known.select("*", F.explode(near).alias("block"))

    def cut(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        x, place, number = table.column("x").to_numpy(), table.column("at").to_numpy(), table.column("block")[0].as_py()
        starts = np.array(optimal_breaks(x, x * x, np.ones(len(x)), penalty / 4, least), np.int64)
        starts = np.unique(np.clip(starts[:, None] + np.arange(-2, 3), 0, len(x) - 1)) if len(starts) else starts
        found = np.append(place[starts], number * block)
        found = found[(found >= number * block) & (found < (number + 1) * block)]
        keys = table.select(by).slice(0, 1).to_pylist()[0]
        return pa.table({**{c: pa.array([keys[c]] * len(found), table.schema.field(c).type) for c in by}, "start": pa.array(found, pa.int64())})

    cut_schema = points.select(*by).schema.add("start", T.LongType())
    starts = stored(spread.groupBy(*by, "block").applyInArrow(cut, cut_schema), "starts").distinct()
    # each point's run is the last start at or before it; a block's bound is a start, so blocks are numbered on their own
    marks = starts.select(*by, F.col("start").alias("at"), F.lit(None).cast("double").alias("x"), F.lit(1).alias("mark"))
    rows = known.withColumn("mark", F.lit(0)).unionByName(marks).withColumn("block", own)
    order = Window.partitionBy(*by, "block").orderBy("at", F.desc("mark"))
    run = F.sum("mark").over(order.rowsBetween(Window.unboundedPreceding, 0))
    runs = rows.withColumn("run", run).filter("mark = 0").groupBy(*by, "block", "run").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("n"), F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("first")
        s, q, n, first, last = (table.column(c).to_numpy() for c in ("s", "q", "n", "first", "last"))
        edges = np.array([0, *optimal_breaks(s, q, n, penalty, least)])
        total, count = np.add.reduceat(s, edges), np.add.reduceat(n, edges)
        keys = table.select(by).slice(0, 1).to_pylist()[0]
        ends = last[np.append(edges[1:], len(last)) - 1]
        return pa.table({**{c: pa.array([keys[c]] * len(edges), table.schema.field(c).type) for c in by}, "first": first[edges], "last": ends, "n_win": count, "mean": total / count})

    return runs.groupBy(*by).applyInArrow(join, points.select(*by).schema.add("first", T.LongType()).add("last", T.LongType()).add("n_win", T.LongType()).add("mean", T.DoubleType()))


def rescue_small_segments(segments: DataFrame, depths: DataFrame, purity: float, absent: str = "Y") -> DataFrame:
    """``segments`` (``chr, start, end, cn, start_bkpt, end_bkpt, ptel``) with copy numbers for runs that have none, by depth.

    A run is as many neighbours with null ``cn`` as there are, next to one with a copy number on at least one side, and with a
    boundary that is neither ``cn_bkpt`` nor ``centromere``. The first segment of a chromosome whose telomere ends at 0 and which
    ends at the centromere begins no run to be rescued, and the ``absent`` chromosome has none. ``depths`` has ``chr, start, end,
    part, depth``: a segment's own mean depth (``part`` ``own``) and that of its last and first bases that a run is compared with
    (``tail``, ``head``); null or absent: no reads. From one side the estimate is the neighbour's total copy number times the
    depths' ratio, less what normal cells have; from both the geometric mean of both, each at least 0. Segments of at most one
    base inside a run stay null. :func:`edge_regions` says which bases ``tail`` and ``head`` are.
    """
    order = Window.partitionBy("chr").orderBy("start", "end")
    by_part = {p: depths.filter(F.col("part") == p).select("chr", "start", "end", F.col("depth").alias("_" + p)) for p in ("own", "tail", "head")}
    rows = segments
    for part in by_part.values():
        rows = rows.join(part, ["chr", "start", "end"], "left")
    empty = F.col("cn").isNull()
    rows = rows.withColumn("_new", (~empty | F.lag("cn").over(order).isNotNull() | (F.row_number().over(order) == 1)).cast("int")).withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    for name, c in (("_lcn", "cn"), ("_ldepth", "_tail")):
        rows = rows.withColumn(name, F.lag(c).over(order))
    for name, c in (("_rcn", "cn"), ("_rdepth", "_head")):
        rows = rows.withColumn(name, F.lead(c).over(order))
    run = Window.partitionBy("chr", "_run").orderBy("start", "end")
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    inner = lambda c: F.col(c).isin("cn_bkpt", "centromere")
    involved = F.max(~inner("start_bkpt") | ~inner("end_bkpt")).over(whole)
    begin, last = F.first(F.struct("start_bkpt", "end_bkpt", "ptel")).over(whole), F.last(F.struct("_rcn", "_rdepth")).over(whole)
    acrocentric = begin["start_bkpt"].endswith("_ptel") & (begin["end_bkpt"] == "centromere") & (begin["ptel"] == 0)
    left, right = F.first(F.struct("_lcn", "_ldepth")).over(whole), last
    rows = rows.withColumn("_ok", empty & involved & ~acrocentric & (F.col("chr").cast("string") != absent))
    rows = rows.withColumn("_l", left).withColumn("_r", right).withColumn("_i", F.row_number().over(run)).withColumn("_n", F.count("*").over(whole))
    rows = rows.withColumn("_reads", F.max(F.coalesce(F.col("_own") > 0, F.lit(False))).over(whole) | F.coalesce(F.col("_l._ldepth") > 0, F.lit(False)) | F.coalesce(F.col("_r._rdepth") > 0, F.lit(False)))
    depth = F.coalesce("_own", F.lit(0.0)) + 0.01

    def estimate(cn: Column, there: Column) -> Column:
        return (depth * (purity * cn + (1 - purity) * 2) / (F.coalesce(there, F.lit(0.0)) + 0.01) - (1 - purity) * 2) / purity

    one, two = estimate(F.col("_l._lcn"), F.col("_l._ldepth")), estimate(F.col("_r._rcn"), F.col("_r._rdepth"))
    both = F.sqrt(F.greatest(one, F.lit(0.0)) * F.greatest(two, F.lit(0.0)))
    has_left, has_right = F.col("_l._lcn").isNotNull(), F.col("_r._rcn").isNotNull()
    tiny = F.col("end") - F.col("start") <= 1
    # at a run's open end the outermost segment is taken whatever its length is
    outer = (~has_left & (F.col("_i") == 1)) | (~has_right & (F.col("_i") == F.col("_n")))
    value = F.when(tiny & ~outer, F.lit(None)).when(has_left & has_right, both).when(has_left, one).when(has_right, two)
    return rows.withColumn("cn", F.when(F.col("_ok") & F.col("_reads"), value).otherwise(F.col("cn"))).select(*segments.columns)


def edge_regions(segments: DataFrame, reach: int = 10_000) -> DataFrame:
    """``chr, start, end, part, lo, hi`` of each segment: itself (``own``) and the bases within ``reach`` of its neighbours' bounds
    that a run beside it is compared with (``tail`` before the next segment, ``head`` after the one before)."""
    order = Window.partitionBy("chr").orderBy("start", "end")
    rows = segments.select("chr", "start", "end", F.lead("start").over(order).alias("_next"), F.lag("end").over(order).alias("_prev"))
    own = F.struct(F.lit("own").alias("part"), F.col("start").alias("lo"), F.col("end").alias("hi"))
    tail = F.struct(F.lit("tail").alias("part"), F.greatest("start", F.coalesce("_next", "end") - reach).alias("lo"), F.col("end").alias("hi"))
    head = F.struct(F.lit("head").alias("part"), F.col("start").alias("lo"), F.least("end", F.coalesce("_prev", "start") + reach).alias("hi"))
    return rows.select("chr", "start", "end", F.explode(F.array(own, tail, head)).alias("r")).select("chr", "start", "end", "r.*")
