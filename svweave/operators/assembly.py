"""De Bruijn graphs of sequences: unitigs with their twins, arcs, smoothed bubbles, breakpoint patterns and their scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expr
from ..sources.shared import freed, stored
from .chains import chain_places
from .sequences import kmers
from .unitig_parts import LONGEST_K, unitig_parts


def oriented(rows: DataFrame, by: list[str]) -> DataFrame:
    """``*by, kmer, n`` of canonical k-mers, each in both directions."""
    return rows.select(*by, F.explode(F.array("kmer", expr.revcomp(F.col("kmer")))).alias("kmer"), "n").distinct()


def unitigs(seqs: DataFrame, k: int, by: list[str], cutoff: float = 1.001) -> tuple[DataFrame, DataFrame]:
    """Vertices ``*by, vertex, twin, seq, n_kmers, coverage`` and arcs ``*by, source, target, weight`` of each graph.

    K-mers (``k`` odd) above ``cutoff`` are linked where a (k+1)-mer above it joins them; a link that is the only one out of a
    k-mer and into the next is compacted, unless the two are each other's reverse complement. A vertex is named by its first
    k-mer, its twin (the reverse complement) by the reverse complement of its last; both are rows. ``coverage`` adds up k-mers'
    counts, ``weight`` is the joining (k+1)-mer's count. Circles are cut at their smallest k-mer, or just after its reverse
    complement. Only letters A, C, G, T make k-mers.
    """
    if k % 2 == 0:
        raise ValueError("k must be odd, or a k-mer could be its own reverse complement")
    spark = seqs.sparkSession
    parts = unitig_parts(seqs, k, by, cutoff) if k <= LONGEST_K else _single_parts(seqs, k, by, cutoff)
    parts = stored(parts, "parts")
    freed(spark)
    placed = chain_places(_joined(parts, by), by, rank="rank")
    # parts move once, those of circles with where they would be cut
    kept = [F.when(F.col("cyclic"), F.col(c)).alias(c) for c in ("next", "single", "least", "cuts")]
    whole = stored(placed.join(parts, [*by, "node"]).select(*by, "node", "head", "place", "cyclic", "seq", "n_kmers", "coverage", "outs", *kept), "whole")
    freed(spark, parts)
    columns = [*by, "head", "place", "seq", "n_kmers", "coverage", "outs"]
    circles, whole = whole.filter("cyclic"), whole.filter("NOT cyclic").select(*columns)
    if not circles.isEmpty():
        opened = stored(_opened(circles.withColumnRenamed("head", "smallest").select(*parts.columns, "smallest"), k), "opened")
        whole = whole.unionByName(chain_places(_joined(opened, by), by, rank="rank").join(opened, [*by, "node"]).select(*columns))
    rows = whole.groupBy(*by, "head").agg(F.array_sort(F.collect_list(F.struct("place", "seq"))).alias("parts"), F.sum("n_kmers").alias("n_kmers"), F.sum("coverage").alias("coverage"), F.max_by("outs", "place").alias("outs"))
    seq = F.array_join(F.transform("parts", lambda p: F.when(p["place"] == 0, p["seq"]).otherwise(F.substring(p["seq"], F.lit(k), F.length(p["seq"])))), "")
    rows = rows.select(*by, seq.alias("seq"), "n_kmers", "coverage", "outs")
    named = rows.select(*by, F.substring("seq", 1, k).alias("vertex"), expr.revcomp(F.substring("seq", -k, k)).alias("twin"), "seq", "n_kmers", "coverage", "outs")
    named = stored(named, "vertices")
    freed(spark)
    # an arc that doesn't go on inside a vertex leads to the first k-mer of one
    arcs = named.select(*by, "vertex", "seq", F.explode("outs").alias("out"))
    edges = arcs.select(*by, F.col("vertex").alias("source"), F.concat(F.substring("seq", 1 - k, k - 1) if k > 1 else F.lit(""), "out.letter").alias("target"), F.col("out.weight").alias("weight"))
    return named.drop("outs"), stored(edges, "edges")


def _joined(parts: DataFrame, by: list[str]) -> DataFrame:
    """``*by, node, prev, rank``: a part's ``next`` is joined to it if no other arc leads there."""
    rows = parts.select(*by, "node", "single", F.col("least").alias("rank"))
    before = parts.filter("next IS NOT NULL").select(*by, F.col("next").alias("node"), F.col("node").alias("prev"))
    alone = rows.filter("single").join(before, [*by, "node"], "left").select(*by, "node", "prev", "rank")
    return alone.unionByName(rows.filter("NOT single").select(*by, "node", F.lit(None).cast(parts.schema["node"].dataType).alias("prev"), "rank"))


def _opened(parts: DataFrame, k: int) -> DataFrame:
    """Parts of circles, those with the circle's ``smallest`` k-mer or its reverse complement cut there."""
    node = parts.schema["node"].dataType
    here = F.col("least") == F.col("smallest")
    rest = parts.filter(~here).drop("smallest")
    cuts = F.filter("cuts", lambda c: (c["at"] > 0) & (c["at"] < F.col("n_kmers")))
    starts = F.array_sort(F.concat(F.array(F.struct(F.lit(0).alias("at"), F.col("node").alias("node"), F.lit(0).cast("long").alias("before"), F.lit(0).cast("long").alias("weight"))), cuts))
    stops = F.array_append(F.slice(starts, 2, F.size(starts)), F.struct(F.col("n_kmers").cast("int").alias("at"), F.lit(None).cast(node).alias("node"), F.col("coverage").alias("before"), F.lit(0).cast("long").alias("weight")))
    at_start, at_end = F.exists("cuts", lambda c: c["at"] == 0), F.exists("cuts", lambda c: c["at"] == F.col("n_kmers"))
    pieces = parts.filter(here).withColumns({"at_start": at_start, "at_end": at_end}).select("*", F.explode(F.arrays_zip(starts.alias("a"), stops.alias("z"))).alias("p"))
    low, high, last = F.col("p.a.at"), F.col("p.z.at"), F.col("p.z.node").isNull()
    changed = {
        "node": F.col("p.a.node"), "next": F.when(last & ~F.col("at_end"), F.col("next")), "single": F.col("single") & (low == 0) & ~F.col("at_start"),
        "outs": F.when(last, F.col("outs")).otherwise(F.array(F.struct(F.substring(F.col("seq"), high + k, F.lit(1)).alias("letter"), F.col("p.z.weight").alias("weight")))),
        "seq": F.substring(F.col("seq"), low + 1, high - low + k - 1), "n_kmers": (high - low).cast("long"), "coverage": F.col("p.z.before") - F.col("p.a.before"),
    }
    return rest.unionByName(pieces.select(*(changed.get(c, F.col(c)).alias(c) for c in rest.columns)))


def _single_parts(seqs: DataFrame, k: int, by: list[str], cutoff: float) -> DataFrame:
    """As :func:`unitig_parts`, for a k-mer of any length each, by its text."""
    nodes = stored(oriented(kmers(seqs, k, by, cutoff, pure=True), by), "kmers")
    joins = oriented(kmers(seqs, k + 1, by, cutoff, pure=True), by)
    arcs = stored(joins.select(*by, F.expr(f"substring(kmer, 1, {k})").alias("u"), F.expr(f"substring(kmer, 2, {k})").alias("v"), F.col("n").alias("weight")), "arcs")
    # a (k+1)-mer above the cutoff has both its k-mers above it; at most four arcs leave or enter a k-mer
    outs = arcs.groupBy(*by, F.col("u").alias("kmer")).agg(F.collect_list(F.struct(F.substring("v", -1, 1).alias("letter"), "weight")).alias("outs"), F.min("v").alias("v"))
    ins = arcs.groupBy(*by, F.col("v").alias("kmer")).agg(F.count("*").alias("n_in"))
    rows = nodes.join(outs, [*by, "kmer"], "left").join(ins, [*by, "kmer"], "left")
    back = expr.revcomp(F.col("kmer"))
    goes_on = (F.size("outs") == 1) & (F.col("v") != F.col("kmer")) & (F.col("v") != back)
    at = F.when(F.col("kmer") < back, 0).otherwise(1)
    cut = F.struct(at.alias("at"), F.when(at == 0, F.col("kmer")).alias("node"), F.when(at == 0, F.lit(0)).otherwise(F.col("n")).cast("long").alias("before"), F.lit(0).cast("long").alias("weight"))
    return rows.select(
        *by, F.col("kmer").alias("node"), F.when(goes_on, F.col("v")).alias("next"), F.coalesce(F.col("n_in") == 1, F.lit(False)).alias("single"), F.col("kmer").alias("seq"), F.lit(1).cast("long").alias("n_kmers"),
        F.col("n").cast("long").alias("coverage"), F.least("kmer", back).alias("least"), F.array(cut).alias("cuts"), F.coalesce("outs", F.array().cast("array<struct<letter: string, weight: bigint>>")).alias("outs"),
    )


def degrees(vertices: DataFrame, edges: DataFrame, by: list[str]) -> DataFrame:
    """``vertices`` with ``n_in`` and ``n_out``."""
    outs = edges.groupBy(*by, F.col("source").alias("vertex")).agg(F.count("*").alias("n_out"))
    ins = edges.groupBy(*by, F.col("target").alias("vertex")).agg(F.count("*").alias("n_in"))
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("n_in", "n_out")}
    return vertices.join(outs, [*by, "vertex"], "left").join(ins, [*by, "vertex"], "left").withColumns(zero)


def bubbles(vertices: DataFrame, edges: DataFrame, by: list[str]) -> DataFrame:
    """``*by, base, end, kept, cost, sides``: vertices all of whose successors lead to one vertex and nowhere else, which nothing
    else enters.

    ``kept`` is the side of most coverage (ties: smaller sequence in either direction); each other side costs 1, or the
    difference of lengths. No vertex of a bubble may be another's twin.
    """
    return _bubbles(vertices, edges, degrees(vertices.select(*by, "vertex", "twin", "n_kmers"), edges, by), by)


def _bubbles(vertices: DataFrame, edges: DataFrame, known: DataFrame, by: list[str]) -> DataFrame:
    """:func:`bubbles`, with the ``degrees`` of the vertices; sequences are those of sides whose numbers fit alone."""
    side = known.filter("n_in = 1 AND n_out = 1").select(*by, "vertex", F.least("vertex", "twin").alias("name"), "n_kmers")
    through = edges.select(*by, F.col("source").alias("base"), F.col("target").alias("vertex")).join(side, [*by, "vertex"])
    through = through.join(edges.select(*by, F.col("source").alias("vertex"), F.col("target").alias("end")), [*by, "vertex"])
    met = through.groupBy(*by, "base", "end").agg(F.collect_list(F.struct("vertex", "n_kmers", "name")).alias("sides")).filter(F.size("sides") >= 2)
    at = known.select(*by, F.col("vertex").alias("base"), F.col("n_out").alias("leaving"), F.least("vertex", "twin").alias("base_name"))
    to = known.select(*by, F.col("vertex").alias("end"), F.col("n_in").alias("entering"), F.least("vertex", "twin").alias("end_name"))
    met = met.join(at, [*by, "base"]).join(to, [*by, "end"]).filter((F.size("sides") == F.col("leaving")) & (F.size("sides") == F.col("entering")))
    texts = vertices.select(*by, "vertex", "coverage", F.least("seq", expr.revcomp(F.col("seq"))).alias("text"))
    every = F.array_sort(F.collect_list(F.struct((-F.col("coverage")).alias("rank"), "text", "vertex", "n_kmers", "name")))
    met = met.select(*by, "base", "end", "base_name", "end_name", F.inline("sides")).join(texts, [*by, "vertex"]).groupBy(*by, "base", "end", "base_name", "end_name").agg(every.alias("sides"))
    names = F.concat(F.transform("sides", lambda s: s["name"]), F.array("base_name", "end_name"))
    met = met.filter(F.size(F.array_distinct(names)) == F.size(names))
    apart = F.transform(F.slice("sides", 2, F.size("sides") - 1), lambda s: F.abs(s["n_kmers"] - F.col("sides")[0]["n_kmers"]))
    cost = F.aggregate(apart, F.lit(0).cast("long"), lambda a, d: a + F.when(d == 0, F.lit(1)).otherwise(d))
    return met.select(*by, "base", "end", F.col("sides")[0]["vertex"].alias("kept"), cost.alias("cost"), F.transform("sides", lambda s: s["vertex"]).alias("sides"))


def smooth_bubbles(vertices: DataFrame, edges: DataFrame, k: int, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """The graph (:func:`unitigs`) without the bubbles that follow one another from a source, a vertex that nothing enters;
    ``vertices`` gain ``bubble``, what they cost.

    Of each bubble one side stays (:func:`bubbles`); base, side and end become one vertex, which takes the base's name, and
    their twins one with the name of the last end's twin. A run of bubbles pops at once: its bubbles don't touch each other's
    sides, and a run and its twin are one, told from the source with the smaller name.
    """
    known = stored(degrees(vertices.select(*by, "vertex", "twin", "n_kmers"), edges, by).select(*by, "vertex", "twin", "n_kmers", "n_in", "n_out"), "known")
    found = stored(_bubbles(vertices, edges, known, by), "bubbles")
    before = found.select(*by, F.col("end").alias("base"), F.col("base").alias("prev"))
    runs = chain_places(found.select(*by, "base").join(before, [*by, "base"], "left").withColumnRenamed("base", "node"), by).filter("NOT cyclic")
    sources = known.filter("n_in = 0").select(*by, F.col("vertex").alias("head"))
    popped = runs.join(sources, [*by, "head"], "left_semi").withColumnRenamed("node", "base").join(found, [*by, "base"])
    ends = popped.groupBy(*by, "head").agg(F.max_by("end", "place").alias("last"))
    ends = ends.join(known.select(*by, F.col("vertex").alias("last"), F.col("twin").alias("last_twin"), F.col("n_out").alias("leaving")), [*by, "last"])
    told = ends.filter((F.col("leaving") > 0) | (F.col("head") < F.col("last_twin"))).select(*by, "head", "last", "last_twin")
    popped = stored(popped.join(told, [*by, "head"]), "popped")
    # what a run is made of, in order: its head, then each bubble's side and end
    pieces = popped.select(*by, "head", "last_twin", "cost", F.explode(F.array(F.struct((2 * F.col("place") + 1).alias("at"), F.col("kept").alias("vertex")), F.struct((2 * F.col("place") + 2).alias("at"), F.col("end").alias("vertex")))).alias("p")).select(*by, "head", "last_twin", F.when(F.col("p.at") % 2 == 1, F.col("cost")).otherwise(0).alias("cost"), "p.*")
    pieces = pieces.unionByName(popped.filter("place = 0").select(*by, "head", "last_twin", F.lit(0).cast("long").alias("cost"), F.lit(0).cast("long").alias("at"), F.col("head").alias("vertex")))
    joined = pieces.join(vertices.select(*by, "vertex", "seq", "n_kmers", "coverage"), [*by, "vertex"]).groupBy(*by, "head", "last_twin").agg(F.array_sort(F.collect_list(F.struct("at", "seq"))).alias("parts"), F.sum("n_kmers").alias("n_kmers"), F.sum("coverage").alias("coverage"), F.sum("cost").alias("bubble"))
    text = F.array_join(F.transform("parts", lambda p: F.when(p["at"] == 0, p["seq"]).otherwise(F.substring(p["seq"], F.lit(k), F.length(p["seq"])))), "")
    merged = joined.select(*by, "head", "last_twin", text.alias("seq"), "n_kmers", "coverage", "bubble")
    ways = F.array(F.struct(F.col("head").alias("vertex"), F.col("last_twin").alias("twin"), F.col("seq").alias("seq")), F.struct(F.col("last_twin").alias("vertex"), F.col("head").alias("twin"), expr.revcomp(F.col("seq")).alias("seq")))
    merged = merged.select(*by, F.explode(ways).alias("w"), "n_kmers", "coverage", "bubble").select(*by, "w.vertex", "w.twin", "w.seq", "n_kmers", "coverage", "bubble")
    touched = popped.select(*by, F.explode(F.concat("sides", F.array("base", "end"))).alias("vertex")).distinct()
    touched = stored(touched.join(known.select(*by, "vertex", "twin"), [*by, "vertex"]).select(*by, F.explode(F.array("vertex", "twin")).alias("vertex")).distinct(), "touched")
    rest = vertices.join(touched, [*by, "vertex"], "left_anti").withColumn("bubble", F.lit(0).cast("long"))
    merged = stored(merged, "merged")
    out = rest.select(*by, "vertex", "twin", "seq", "n_kmers", "coverage", "bubble").unionByName(merged)
    freed(vertices.sparkSession)
    # arcs out of a run's last vertex leave the merged one; into its twin's name they stay as they are
    moved = edges.join(told.select(*by, F.col("last").alias("source"), "head"), [*by, "source"], "left").withColumn("source", F.coalesce("head", "source")).drop("head")
    lost = stored(touched.join(merged.select(*by, "vertex"), [*by, "vertex"], "left_anti"), "lost")
    left = moved.join(lost.withColumnRenamed("vertex", "source"), [*by, "source"], "left_anti").join(lost.withColumnRenamed("vertex", "target"), [*by, "target"], "left_anti")
    inner = popped.select(*by, F.col("head").alias("source"), F.explode("sides").alias("target"))
    return out, stored(left.join(inner, [*by, "source", "target"], "left_anti").select(*by, "source", "target", "weight"), "arcs")


def quintets(vertices: DataFrame, edges: DataFrame, k: int, by: list[str]) -> DataFrame:
    """``*by, v0 .. v4``: paths ``v0 <- v1 -> v2 -> v3 <- v4`` around a breakpoint.

    ``v1`` has two arcs out and ``v3`` two in, both have ``k`` k-mers at least, ``v0`` and ``v4`` differ and aren't joined. Of a path and
    its twin the one with at most two vertices named by the larger of their two names is given.
    """
    return _quintets(degrees(vertices.select(*by, "vertex", "twin", "n_kmers"), edges, by), edges, k, by)


def _quintets(known: DataFrame, edges: DataFrame, k: int, by: list[str]) -> DataFrame:
    """:func:`quintets`, with the ``degrees`` of the vertices."""
    known = known.select(*by, "vertex", (F.col("vertex") > F.col("twin")).cast("int").alias("minus"), "n_in", "n_out", "n_kmers")
    e = edges.select(*by, "source", "target")
    one = known.filter((F.col("n_out") == 2) & (F.col("n_kmers") >= k)).select(*by, F.col("vertex").alias("v1"), F.col("minus").alias("m1"))
    three = known.filter((F.col("n_in") == 2) & (F.col("n_kmers") >= k)).select(*by, F.col("vertex").alias("v3"), F.col("minus").alias("m3"))
    out = e.join(one, F.col("source") == F.col("v1")) if not by else e.withColumnRenamed("source", "v1").join(one, [*by, "v1"])
    forks = out.select(*by, "v1", "m1", F.col("target").alias("v2")).join(out.select(*by, "v1", F.col("target").alias("v0")), [*by, "v1"]).filter("v0 <> v2")
    into = e.withColumnRenamed("target", "v3").join(three, [*by, "v3"])
    meets = into.select(*by, "v3", "m3", F.col("source").alias("v2")).join(into.select(*by, "v3", F.col("source").alias("v4")), [*by, "v3"]).filter("v2 <> v4")
    paths = forks.join(meets, [*by, "v2"]).filter("v1 <> v3 AND v0 <> v4")
    paths = paths.join(e.select(*by, F.col("source").alias("v0"), F.col("target").alias("v4")), [*by, "v0", "v4"], "left_anti")
    for v in ("v0", "v2", "v4"):
        paths = paths.join(known.select(*by, F.col("vertex").alias(v), F.col("minus").alias("m" + v[1])), [*by, v])
    # if both arcs of each side lead to both sides, the pattern isn't one: v0 = v4 under another choice of v2
    both = forks.select(*by, "v1", "v2").join(meets.select(*by, "v3", "v2"), [*by, "v2"]).distinct().groupBy(*by, "v1", "v3").agg(F.count("*").alias("common"))
    paths = paths.join(both.filter("common = 1"), [*by, "v1", "v3"]).filter(sum(F.col(f"m{i}") for i in range(5)) <= 2)
    return paths.select(*by, "v0", "v1", "v2", "v3", "v4")


def quintet_scores(vertices: DataFrame, edges: DataFrame, k: int, by: list[str]) -> DataFrame:
    """``*by, n_quintets, score`` of each graph of smoothed ``vertices``.

    Without a quintet the score is the number of isolated vertices (a vertex and its twin count once), 15 at most; with more
    than one, 60 less 5 for each above two and 1 for each isolated vertex. One quintet scores 100 less 3 for each loop
    (:func:`_loops`) at its ends, 5 for each other vertex with arcs that isn't met exactly once, 1 for each isolated vertex
    and half of its vertices' bubble costs, rounded up. No score is negative.
    """
    known = stored(degrees(vertices.select(*by, "vertex", "twin", "n_kmers", "bubble"), edges, by), "known")
    found = stored(_quintets(known, edges, k, by), "quintets")
    plus = known.filter("vertex < twin").withColumn("alone", ((F.col("n_in") == 0) & (F.col("n_out") == 0)).cast("int"))
    counts = plus.groupBy(*by).agg(F.sum("alone").alias("isolated")).join(found.groupBy(*by).agg(F.count("*").alias("n")), by, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    single = found.join(counts.filter("n = 1").select(*by), by, "left_semi")
    name = known.select(*by, "vertex", "twin", F.least("vertex", "twin").alias("name"), "bubble")
    members = single.select(*by, F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.col(f"v{i}").alias("vertex")) for i in range(5)))).alias("m")).select(*by, "m.*").join(name, [*by, "vertex"])
    ends = members.filter("i <> 2").select(*by, F.when(F.col("i").isin(0, 3), F.col("vertex")).otherwise(F.col("twin")).alias("vertex"))
    loops = stored(ends.join(_loops(known, edges, by), [*by, "vertex"]).select(*by, "members"), "loops")
    met = members.select(*by, "name").unionByName(loops.select(*by, F.explode("members").alias("vertex")).join(name, [*by, "vertex"]).select(*by, "name"))
    times = met.groupBy(*by, "name").agg(F.count("*").alias("times"))
    others = plus.filter("alone = 0").select(*by, F.col("vertex").alias("name")).join(single.select(*by).distinct(), by, "left_semi").join(times, [*by, "name"], "left")
    extra = others.filter("times IS NULL OR times <> 1").groupBy(*by).agg(F.count("*").alias("extra"))
    cost = members.groupBy(*by).agg(F.sum(F.floor((F.col("bubble") + 1) / 2)).alias("cost"))
    out = counts
    for part in (extra, cost, loops.groupBy(*by).agg(F.count("*").alias("loops"))):
        out = out.join(part, by, "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("extra", "cost", "loops")}
    score = F.when(F.col("n") == 0, F.least("isolated", F.lit(15))).when(F.col("n") >= 2, 60 - 5 * (F.col("n") - 2) - F.col("isolated"))
    score = score.otherwise(100 - 3 * F.col("loops") - 5 * F.col("extra") - F.col("isolated") - F.col("cost"))
    return out.withColumns(zero).select(*by, F.col("n").alias("n_quintets"), F.greatest(score, F.lit(0)).cast("long").alias("score"))


def _loops(known: DataFrame, edges: DataFrame, by: list[str]) -> DataFrame:
    """``*by, vertex, members``: two vertices of about one length (two k-mers more at most) that a vertex's two arcs lead to, each
    with one arc out, to a vertex without any."""
    e = edges.select(*by, "source", "target")
    at = lambda v, *keep: known.select(*by, F.col("vertex").alias(v), *(F.col(c).alias(f"{v}_{c}") for c in keep))
    fork = e.withColumnRenamed("source", "vertex").join(at("vertex", "n_out").filter("vertex_n_out = 2"), [*by, "vertex"]).withColumnRenamed("target", "side")
    side = fork.join(at("side", "n_out", "n_kmers").filter("side_n_out = 1"), [*by, "side"]).join(e.select(*by, F.col("source").alias("side"), F.col("target").alias("last")), [*by, "side"])
    side = side.join(at("last", "n_out").filter("last_n_out = 0"), [*by, "last"])
    pairs = side.groupBy(*by, "vertex", "last").agg(F.collect_list("side").alias("sides"), (F.max("side_n_kmers") - F.min("side_n_kmers")).alias("apart"))
    return pairs.filter((F.size("sides") == 2) & (F.col("apart") <= 2)).select(*by, "vertex", F.concat("sides", F.array("last")).alias("members"))


def best_assembly(scores: DataFrame, by: list[str], least: int = 61) -> DataFrame:
    """``*by, k, score`` of the largest ``k`` whose graph scores ``least`` and has exactly one quintet (``*by, k, n_quintets, score``)."""
    return scores.filter((F.col("score") >= least) & (F.col("n_quintets") == 1)).groupBy(*by).agg(F.max_by(F.struct("k", "score"), "k").alias("b")).select(*by, "b.*")


def junction(v1: DataFrame, k: int) -> DataFrame:
    """Rows with ``left, middle, right`` (contigs of v1, v2, v3) and ``gap, kind, bases``: what stands between the two sides.

    The gap is the middle's length less twice ``k - 1``: more than none is ``non-template`` sequence, less is ``micro-homology``, at
    which both sides must agree (else null), none is ``clean``.
    """
    gap = F.length("middle") - 2 * (k - 1)
    inserted = F.substring(F.col("middle"), F.lit(k), gap)
    shared = F.substring(F.col("left"), F.length("left") + gap + 1, -gap)
    same = shared == F.substring(F.col("right"), F.lit(1), -gap)
    return v1.withColumn("gap", gap).withColumn("kind", F.when(gap > 0, "non-template").when(gap < 0, "micro-homology").otherwise("clean")).withColumn("bases", F.when(gap > 0, inserted).when((gap < 0) & same, shared))
