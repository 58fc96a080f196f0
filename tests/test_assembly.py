import random
from collections import Counter

from svweave.operators import assembly, chains, kmer_counts, unitig_parts


def back(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def plain_unitigs(seqs, k, cutoff=1.001):
    """One k-mer after another from each k-mer without a single one before it, then what is left of circles."""
    count = lambda size: {x: n for x, n in Counter(min(s[i : i + size], back(s[i : i + size])) for s in seqs for i in range(len(s) - size + 1)).items() if n > cutoff}
    nodes, joins = count(k), count(k + 1)
    n_of = {y: n for x, n in nodes.items() for y in (x, back(x))}
    outs, ins, weight = {}, {}, {}
    for e, n in joins.items():
        for x in {e, back(e)}:
            outs.setdefault(x[:k], []).append(x[1:])
            ins.setdefault(x[1:], []).append(x[:k])
            weight[x[:k], x[1:]] = n
    single = lambda u, v: len(outs[u]) == 1 and len(ins[v]) == 1 and u != v and u != back(v)
    after = {u: v[0] for u, v in outs.items() if len(v) == 1 and single(u, v[0])}
    before = {v: u for u, v in after.items()}
    walks, seen = [], set()
    for u in sorted(n_of):
        if u not in before:
            walk = [u]
            while walk[-1] in after:
                walk.append(after[walk[-1]])
            walks.append(walk)
            seen.update(walk)
    for u in sorted(set(n_of) - seen):
        if u not in seen:
            circle = [u]
            while after[circle[-1]] != u:
                circle.append(after[circle[-1]])
            seen.update(circle)
            least = min(min(x, back(x)) for x in circle)
            cuts = sorted({i for i, x in enumerate(circle) if x == least or before[x] == back(least)})
            turned = circle[cuts[0] :] + circle[: cuts[0]]
            ends = [c - cuts[0] for c in cuts[1:]] + [len(turned)]
            at = 0
            for end in ends:
                walks.append(turned[at:end])
                at = end
    rows = {(w[0], back(w[-1]), w[0] + "".join(x[-1] for x in w[1:]), len(w), sum(n_of[x] for x in w)) for w in walks}
    first, last = {w[0]: w[0] for w in walks}, {w[-1]: w[0] for w in walks}
    return rows, {(last[u], first[v], n) for (u, v), n in weight.items() if u in last and v in first}


def rows_of(df, *columns):
    return {tuple(r[c] for c in columns) for r in df.collect()}


def check(spark, groups, k, cutoff=1.001):
    table = spark.createDataFrame([(g, s) for g, seqs in groups.items() for s in seqs], "g string, seq string")
    vertices, edges = assembly.unitigs(table, k, ["g"], cutoff)
    want = {g: plain_unitigs(seqs, k, cutoff) for g, seqs in groups.items()}
    assert rows_of(vertices, "g", "vertex", "twin", "seq", "n_kmers", "coverage") == {(g, *r) for g, (v, _) in want.items() for r in v}
    assert rows_of(edges, "g", "source", "target", "weight") == {(g, *r) for g, (_, e) in want.items() for r in e}
    twins = {(r.g, r.vertex): r for r in vertices.collect()}
    for r in twins.values():
        assert twins[r.g, r.twin].seq == back(r.seq) and twins[r.g, r.twin].twin == r.vertex
    return vertices, edges


def test_unitigs_equal_a_plain_walk(spark):
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    base, circle = noise(160), noise(40)
    snp = base[:70] + ("A" if base[70] != "A" else "C") + base[71:]
    reads = [text[i : i + 40] for text in (base, snp, back(base)) for i in range(0, 121, 4)] + [noise(30), "ACG", "", base[:20] + "N" + base[21:60]]
    check(spark, {"bubble": reads, "circle": [(circle * 3)[i : i + 50] for i in range(0, 60, 3)], "few": ["AC"], "low": ["ACACACACACACACACAC"] * 2, "letters": [noise(9) for _ in range(60)]}, 7)


def test_chains_of_every_length(spark):
    rows = [(None, f"{n}.{i}", f"{n}.{i - 1}" if i else None) for n in (1, 2, 3, 64, 65, 200) for i in range(n)] + [("c", f"o{i}", f"o{(i - 1) % 5}") for i in range(5)] + [("c", "self", "self")]
    got = chains.chain_places(spark.createDataFrame(rows, "g string, node string, prev string"), ["g"]).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.g is None:
            n, i = r.node.split(".")
            assert (r.head, r.place, r.cyclic) == (f"{n}.0", int(i), False)
        else:
            assert (r.head, r.place, r.cyclic) == ("self" if r.node == "self" else "o0", None, True)


class Plain:
    """A small graph, changed one step after another."""

    def __init__(self, vertices, edges, k):
        self.k, self.v, self.e = k, {r.vertex: dict(r.asDict(), bubble=r.asDict().get("bubble", 0)) for r in vertices}, {(r.source, r.target): r.weight for r in edges}

    def after(self, u):
        return [b for a, b in self.e if a == u]

    def before(self, v):
        return [a for a, b in self.e if b == v]

    def name(self, u):
        return min(u, self.v[u]["twin"])

    def pop(self, u):
        sides = self.after(u)
        if len(sides) < 2 or len(self.after(sides[0])) != 1:
            return False
        (end,) = self.after(sides[0])
        if len(self.before(end)) != len(sides) or any(self.before(w) != [u] or self.after(w) != [end] for w in sides):
            return False
        if len({self.name(x) for x in (u, end, *sides)}) != len(sides) + 2:
            return False
        best = min(sides, key=lambda w: (-self.v[w]["coverage"], min(self.v[w]["seq"], back(self.v[w]["seq"]))))
        cost = sum(abs(self.v[w]["n_kmers"] - self.v[best]["n_kmers"]) or 1 for w in sides if w != best)
        row = dict(self.v[u])
        for x in (best, end):
            row["seq"] += self.v[x]["seq"][self.k - 1 :]
            for c in ("n_kmers", "coverage", "bubble"):
                row[c] += self.v[x][c]
        row["bubble"] += cost
        row["twin"] = self.v[end]["twin"]
        old_twin = self.v[u]["twin"]
        gone = {x for w in (*sides, end) for x in (w, self.v[w]["twin"])} | {old_twin}
        moved = {(u if a == end else a, b): n for (a, b), n in self.e.items()}
        moved = {(row["twin"] if a == old_twin else a, b): n for (a, b), n in moved.items()}
        for x in gone:
            del self.v[x]
        self.v[u] = row
        self.v[row["twin"]] = dict(row, vertex=row["twin"], twin=u, seq=back(row["seq"]))
        inner = set(sides) | {r for w in sides for r in [w]}
        self.e = {(a, b): n for (a, b), n in moved.items() if a in self.v and b in self.v and not (a == u and b in inner)}
        return True

    def smooth(self):
        for u in sorted(self.v):
            if u in self.v and not self.before(u):
                while self.pop(u):
                    pass

    def quintets(self):
        out = set()
        for a in self.v:
            for b in self.v:
                s, p = self.after(a), self.before(b)
                if a != b and len(s) == 2 and len(p) == 2 and min(self.v[a]["n_kmers"], self.v[b]["n_kmers"]) >= self.k and len(set(s) & set(p)) == 1:
                    (w,) = set(s) & set(p)
                    (u,), (y,) = set(s) - {w}, set(p) - {w}
                    path = (u, a, w, b, y)
                    if (u, y) not in self.e and sum(x > self.v[x]["twin"] for x in path) <= 2:
                        out.add(path)
        return out

    def score(self):
        found, plus = self.quintets(), [x for x in self.v if x < self.v[x]["twin"]]
        alone = {x for x in plus if not self.after(x) and not self.before(x)}
        if len(found) != 1:
            return len(found), max(0, min(len(alone), 15) if not found else 60 - 5 * (len(found) - 2) - len(alone))
        (q,) = found
        score, touched = 100 - len(alone), Counter(self.name(x) for x in q)
        for x in (q[0], self.v[q[1]]["twin"], q[3], self.v[q[4]]["twin"]):
            sides = self.after(x)
            if len(sides) == 2 and abs(self.v[sides[0]]["n_kmers"] - self.v[sides[1]]["n_kmers"]) <= 2:
                ends = [self.after(s) for s in sides]
                if len(ends[0]) == 1 and ends[0] == ends[1] and not self.after(ends[0][0]):
                    score -= 3
                    touched.update(self.name(y) for y in (*sides, ends[0][0]))
        score -= 5 * sum(touched[x] != 1 for x in plus if x not in alone)
        return 1, max(0, score - sum((self.v[x]["bubble"] + 1) // 2 for x in q))


def test_bubbles_quintets_and_scores_equal_a_plain_graph(spark):
    rng, k = random.Random(11), 9
    noise = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    turn = lambda s, *at: "".join({"A": "C", "C": "G", "G": "T", "T": "A"}[c] if i in at else c for i, c in enumerate(s))
    a, b, c, d = (noise(90) for _ in range(4))
    groups = {
        "clean": [a + b, c + d, a + d] * 2, "inserted": [a + b, c + d, a + "ACGTTGCA" + d] * 2, "isolated": [a, b, c] * 2,
        "snps": [a + b, turn(a, 30, 60) + turn(b, 40), turn(a, 30), a + b, c + d, a + d] * 2, "both": [a, turn(a, 45), a[:40] + a[44:]] * 2 + [back(a)] * 3,
        "loop": [a + b + c, c + d, a + d, turn(b, 70)[40:] + c[:5]] * 2, "two": [a + b, c + d, a + d, b + noise(60), noise(50) + c, b + c] * 2, "end": [a + b, a + turn(b, 50), c + d, a + d] * 2,
    }
    table = spark.createDataFrame([(g, s) for g, seqs in groups.items() for s in seqs], "g string, seq string")
    vertices, edges = assembly.unitigs(table, k, ["g"])
    smooth, arcs = assembly.smooth_bubbles(vertices, edges, k, ["g"])
    found, scores = assembly.quintets(smooth, arcs, k, ["g"]).collect(), {r.g: (r.n_quintets, r.score) for r in assembly.quintet_scores(smooth, arcs, k, ["g"]).collect()}
    all_v, all_e, new_v, new_e = vertices.collect(), edges.collect(), smooth.collect(), arcs.collect()
    popped = 0
    for g in groups:
        plain = Plain([r for r in all_v if r.g == g], [r for r in all_e if r.g == g], k)
        before = len(plain.v)
        plain.smooth()
        popped += before - len(plain.v)
        columns = ("twin", "seq", "n_kmers", "coverage", "bubble")
        got = {(r.vertex, *(r[c] for c in columns)) for r in new_v if r.g == g}
        want = {(x, *(r[c] for c in columns)) for x, r in plain.v.items()}
        other = {(r["twin"], x, *(r[c] for c in columns[1:])) for x, r in plain.v.items()}
        assert {tuple(sorted(x[:2])) + x[3:] for x in got} == {tuple(sorted(x[:2])) + x[3:] for x in want} and len(other) == len(got), g
        assert {(r.source, r.target, r.weight) for r in new_e if r.g == g} == {(*x, n) for x, n in plain.e.items()}, g
        assert {tuple(r[f"v{i}"] for i in range(5)) for r in found if r.g == g} == plain.quintets(), g
        assert scores[g] == plain.score(), g
    assert popped > 10 and scores["clean"] == (1, 100) and scores["inserted"][0] == 1 and scores["isolated"][0] == 0
    best = assembly.best_assembly(spark.createDataFrame([("x", 9, 1, 70), ("x", 11, 1, 61), ("x", 13, 2, 99), ("y", 9, 1, 60)], "g string, k int, n_quintets int, score int"), ["g"])
    assert [tuple(r) for r in best.collect()] == [("x", 11, 61)]


def test_junctions(spark):
    rows = [("AAACGT", "CGTGGTTC", "TTCAA"), ("AAACGT", "CGTTTC", "TTCAA"), ("AAACGT", "CGTTC", "TTCAA"), ("AAACGT", "CGT", "CGTAA"), ("AAACGT", "CGT", "AGTAA")]
    got = assembly.junction(spark.createDataFrame(rows, "left string, middle string, right string"), 4).select("gap", "kind", "bases").collect()
    assert [tuple(r) for r in got] == [(2, "non-template", "GG"), (0, "clean", None), (-1, "micro-homology", "T"), (-3, "micro-homology", "CGT"), (-3, "micro-homology", None)]


def test_unitigs_over_many_buckets_circles_and_long_kmers(spark):
    """Chains and circles of more than one bucket's parts, circles with a k-mer and its reverse complement, and k-mers beyond 29 letters."""
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    around = lambda c, size: [(c * (2 + 2 * size // len(c)))[i : i + size] for i in range(len(c))]
    stem = noise(60)
    groups = {
        "long": [noise(3000)] * 2, "circle": around(noise(400), 80), "small": around(noise(30), 80), "turned": around(stem + "ACGTA" + back(stem) + "CCATG", 90),
        "own": ["ACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGTACGT"] * 2, "one": ["A" * 60] * 2, "mixed": [s + noise(1) for s in around(noise(120), 70)] + around(noise(50), 60) * 2,
    }
    for k in (11, 21, 31):
        check(spark, groups, k)


def test_parts_are_far_fewer_than_kmers(spark):
    """Each round of pointer jumping moved a row for each k-mer."""
    text = "".join(random.Random(3).choices("ACGT", k=60_000))
    parts = unitig_parts.unitig_parts(spark.createDataFrame([("g", text), ("g", text)], "g string, seq string"), 21, ["g"], 1.001)
    sizes = [r.n_kmers for r in parts.collect()]
    assert sum(sizes) == 2 * (60_000 - 20) and 4 * len(sizes) < sum(sizes)


def test_sides_of_kmers_in_cut_texts(monkeypatch):
    rng, k = random.Random(4), 11
    texts = ["".join(rng.choice("ACGTACGTACGTN") for _ in range(n)) for n in (5, 11, 12, 74, 75, 76, 400)]
    want = Counter()
    for t in texts:
        for i in range(len(t) - k + 1):
            x, sides = t[i : i + k], (t[i - 1] if i else "", t[i + k] if i + k < len(t) else "")
            if set(x) <= set("ACGT"):
                y, (before, after) = (x, sides) if x < back(x) else (back(x), (back(sides[1]), back(sides[0])))
                code = int("".join(str("ACGT".index(c)) for c in y), 4) << 4
                want[code | ("ACGT".index(after) if after and after in "ACGT" else 8)] += 1
                if before and before in "ACGT":
                    want[code | 4 + "ACGT".index(before)] += 1
    for size in (1 << 21, 64, 20):
        monkeypatch.setattr(kmer_counts, "PACK", size)
        packed = [p for pack, skip in kmer_counts.packs([t.encode() for t in texts], k, True) for _, p in kmer_counts.pieces(pack, k, 6, True, skip)]
        assert Counter(unitig_parts.sided(packed, k).tolist()) == want


def test_rounds_write_only_rows_that_have_not_met_their_head(spark, monkeypatch):
    paths = []
    monkeypatch.setattr(chains, "folder", lambda s, name, of=chains.folder: paths.append(of(s, name)) or paths[-1])
    rows = [(f"s{i}", None) for i in range(500)] + [(f"c{i:03}", f"c{i - 1:03}" if i else None) for i in range(100)] + [("o", "o")]
    got = chains.chain_places(spark.createDataFrame(rows, "node string, prev string"), []).collect()
    assert len(got) == 601 and {(r.head, r.cyclic) for r in got if r.node >= "c" and r.node < "s"} == {("c000", False), ("o", True)}
    written = spark.read.parquet(f"{paths[0]}/*").count()
    assert written < 601 + 100 * 8


def test_links_are_drawn_together_before_pointers_jump(spark, monkeypatch):
    """Chains, circles and rows that point at themselves, with nulls in the keys; all rounds together write a few times the rows."""
    rows = [(g, f"{g}{n}.{i}", f"{g}{n}.{i - 1}" if i else None) for g in ("a", None) for n in (1, 2, 3, 9, 64, 700) for i in range(n)]
    rows += [("c", f"o{i:03}", f"o{(i - 1) % 150:03}") for i in range(150)] + [("c", "self", "self")]
    table, levels, drawn = spark.createDataFrame(rows, "g string, node string, prev string"), [], chains._drawn
    plain = {tuple(r) for r in chains.chain_places(table, ["g"]).collect()}
    monkeypatch.setattr(chains, "JUMPED", 40)
    monkeypatch.setattr(chains, "_drawn", lambda rows, *a: levels.append(rows.count()) or drawn(rows, *a))
    got = chains.chain_places(table, ["g"])
    assert {tuple(r) for r in got.collect()} == plain and got.count() == len(rows) == len(plain)
    assert {(r.head, r.place, r.cyclic) for r in got.collect() if r.g == "c"} == {("o000", None, True), ("self", None, True)}
    assert len(levels) > 4 and sum(levels) < 5 * len(rows) and levels[-1] < len(rows) // 8
