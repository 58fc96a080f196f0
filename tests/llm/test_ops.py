"""Each operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, against plain versions."""

import os
import random
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from svweave.llm import exact_dedup, jaccard_join, mixing, sentence_pieces, substring_dedup, suffix_dedup, token_files, top_k, toxicity, url_filter  # noqa: E402
from svweave.llm.common import doc_batches as token_files_batches  # noqa: E402
from svweave.llm.common import new_folder, text_table  # noqa: E402

public_tokenizers = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, kept string, pack long, row long"


def documents():
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "Δelta", "eps.", "zeta,", "the", "of"]
    say = lambda n: " ".join(rng.choice(words) + str(rng.randint(0, 30)) for _ in range(n))
    passage, base = say(60), say(80).split()
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"), (6, passage), (7, say(10) + " " + passage + "\n" + say(15)), (8, passage), (9, "x " * 90), (10, say(3000) + " " + passage)]
    rows += [(20 + k, " ".join(base[:k] + ["new"] + base[k + 1 :])) for k in range(12)] + [(None, passage), (6, passage), (40, say(5)), (41, "One two")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "c", 1, 2) for i, t in documents()], SCHEMA).repartition(3)


def key(rows):
    return sorted(map(tuple, rows), key=repr)


def test_substring_dedup(spark, docs):
    out = substring_dedup.substring_dedup(text_table(docs)).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert key(out.collect()) == key(brute.substring_dedup(documents(), 20))
    assert substring_dedup.substring_dedup(text_table(docs.limit(0))).count() == 0


def test_suffix_dedup(spark, docs):
    out = suffix_dedup.suffix_dedup(text_table(docs)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert key(out.collect()) == key(brute.byte_dedup(documents(), 50))
    assert suffix_dedup.suffix_dedup(text_table(docs.limit(0))).count() == 0


def test_suffix_dedup_of_a_phrase_in_many_contexts(spark, monkeypatch):
    plain, most = suffix_dedup.window_minima, 16

    def bounded(strings, low, length):
        assert len(strings) <= most, len(strings)
        return plain(strings, low, length)

    monkeypatch.setattr(suffix_dedup, "MERGE_STRINGS", most)
    monkeypatch.setattr(suffix_dedup, "HOT_STRINGS", most, raising=False)
    monkeypatch.setattr(suffix_dedup, "window_minima", bounded)
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    sides = [(noise(40), noise(40)) for _ in range(12)]
    rows = [(k, rng.choice(sides)[0] + " one very frequent phrase, é " + (rng.choice(sides)[1] if k % 3 else noise(40))) for k in range(150)]
    rows += [(150 + k, noise(60) + " one very frequent phrase, é " + noise(60)) for k in range(100)] + [(None, rows[3][1]), (3, rows[9][1])]
    out = suffix_dedup.suffix_dedup(text_table(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)))
    assert key(out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()) == key(brute.byte_dedup(rows, 50))


def test_suffix_dedup_merges_many_shards(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_STRINGS", 4)
    rng = random.Random(12)
    noise = lambda n: "".join(rng.choice("abcd ") for _ in range(n))
    shared = [noise(90) for _ in range(3)]
    rows = [(k, noise(rng.randint(0, 40)) + rng.choice(shared)[rng.randint(0, 20) :] + noise(rng.randint(0, 40))) for k in range(120)]
    out = suffix_dedup.suffix_dedup(text_table(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)))
    assert key(out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()) == key(brute.byte_dedup(rows, 50))


def test_jaccard_join_of_null_ids_and_repeated_rows(spark):
    base = [f"w{k}" for k in range(60)]
    near = " ".join(base[:30] + ["new"] + base[31:])
    rows = [(None, " ".join(base)), (7, " ".join(base)), (9, " ".join(base)), (9, " ".join(base)), (11, near), (12, "alone here now"), (None, None), (13, "")]
    got = key((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_join(text_table(spark.createDataFrame(rows, "doc_id long, text string")), 3, 90).collect())
    assert got == key([(None, 58, 7), (7, 58, 7), (9, 58, 7), (9, 58, 7), (11, 58, 7), (12, 1, 12), (None, 0, None), (13, 0, 13)])


def test_jaccard_join(spark, docs):
    rows = [(i, t) for k, (i, t) in enumerate(documents()) if i is not None and (i, t) not in documents()[:k]]
    own = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_join(own, 3, 90).collect()}
    assert got == brute.jaccard_join(rows)
    assert jaccard_join.jaccard_join(text_table(docs), 3, 90).count() == docs.count()
    assert jaccard_join.jaccard_join(own.limit(0)).count() == 0


def test_jaccard_lists_of_a_shared_passage(spark, monkeypatch):
    """A passage that many texts share is no list of all of them: they'd meet pair by pair."""
    rng, stored, longest = random.Random(5), jaccard_join.stored, []

    def seen(df, name):
        out = stored(df, name)
        if name == "lists":
            longest.append(out.groupBy("token").count().agg({"count": "max"}).first()[0] or 0)
        return out

    monkeypatch.setattr(jaccard_join, "stored", seen)
    passage = " ".join(f"passage{k}" for k in range(8))
    texts = [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * 2 for _ in range(60)) + " " + passage for _ in range(200)]
    rows = list(enumerate(texts)) + [(1000, texts[7] + " aa")]
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_join(text_table(spark.createDataFrame(rows, "doc_id long, text string")), 5, 80).collect()}
    assert got == {k: k for k in range(200)} | {1000: 7}
    assert longest[0] < 20


def test_jaccard_lists_hold_sets_of_like_sizes_alone(spark, monkeypatch):
    """Sets that share rare shingles but are of unlike sizes leave the lists before these are joined."""
    rng, stored, rows_of = random.Random(8), jaccard_join.stored, []

    def seen(df, name):
        out = stored(df, name)
        if name == "lists":
            rows_of.append({r.row for r in out.select("row").collect()})
        return out

    monkeypatch.setattr(jaccard_join, "stored", seen)
    own = lambda n: " ".join(f"w{rng.getrandbits(40)}" for _ in range(n))
    halves = [own(100) for _ in range(8)]  # all shingles of half a text stand in the whole one too, so its prefix holds as rare ones
    texts = halves + [f"{x} {y}" for x, y in zip(halves[::2], halves[1::2])]
    near = own(100)
    rows = list(enumerate(texts)) + [(50, near), (51, near + " a"), (52, near + " a b c")]
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_join(text_table(spark.createDataFrame(rows, "doc_id long, text string")), 3, 90).collect()}
    assert got == {k: k for k in range(12)} | {50: 50, 51: 50, 52: 50}
    assert len(rows_of[0]) == 3
    # the neighbours by size tell the same as all pairs do
    entries = [(row, rng.randint(1, 60)) for row in range(600)]
    entries = [(row, n, rng.randint(0, n - -(-90 * n // 100)), rng.randint(0, 60)) for row, n in entries]
    kept = {r.row for r in jaccard_join.partnered(spark.createDataFrame(entries, "row long, n int, place int, token long"), 90).collect()}
    fits = lambda a, b: min(a[1], b[1]) * 100 >= max(a[1], b[1]) * 90 and min(a[1] - a[2], b[1] - b[2]) >= -(-90 * (a[1] + b[1]) // 190)
    pairs = [(a[0], b[0]) for a in entries for b in entries if a[0] < b[0] and a[3] == b[3] and fits(a, b)]
    assert pairs and {row for pair in pairs for row in pair} <= kept and len(kept) < len(entries)


def test_exact_dedup(spark, docs):
    got_rows = exact_dedup.exact_dedup(docs, keep="largest").collect()
    got = {(r.id, r.text_sha256): r for r in got_rows}
    groups = {}
    for i, t in documents():
        groups.setdefault(t or "", []).append(i)
    for i, t in documents():
        r, ids = got[i, brute.sha((t or "").encode())], groups[t or ""]
        best = max((x for x in ids if x is not None), default=None)
        assert (r.keep_id, r.group_size, r.kept) == (best, len(ids), i == best)
    few = exact_dedup.exact_dedup(docs, keep="largest", runs=7, fan_in=2, ranges=3)
    assert key(few.collect()) == key(got_rows)
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0


def test_mixing(spark, docs):
    sources = docs.withColumn("source", F.when(F.col("doc_id") > 20, "b").when(F.col("doc_id") == 10, "a"))
    got = mixing.mix(mixing.measure(sources)).collect()
    assert len(got) == docs.count() and key(got) == key(mixing.mix(mixing.measure(sources), bin_rows=2).collect())
    total = sum(r.size for r in got)
    by = {r.source: (r.source_size, r.target) for r in got}
    assert abs(sum(t for _, t in by.values()) - total) < 1e-6 and all(t <= 3 * s + 1e-9 for s, t in by.values())
    for s, (size, target) in by.items():
        own = [r for r in got if r.source == s]
        assert all(r.taken <= 3 * r.size for r in own) and abs(sum(r.taken for r in own) - target) <= max(r.size for r in own)
    assert mixing.mix(mixing.measure(sources.limit(0))).count() == 0


def test_token_files(spark, docs, monkeypatch):
    from tokenizers import Tokenizer

    path, coder = public_tokenizers.path("word_bpe_49k.json"), Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    folder = new_folder(spark, "tokens")
    token_files.write_tokens(text_table(docs), folder, path, file_bytes_target=4000)
    rows = sorted(documents(), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    want, at = [], 0
    for i, t in rows:
        ids = coder.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert key(token_files.summary(spark, folder).collect()) == key(want)
    monkeypatch.setattr(token_files, "MOST_RANGES", 2)  # several files a task
    monkeypatch.setattr(token_files, "doc_batches", lambda batches: token_files_batches(batches, 1000))
    many = new_folder(spark, "tokens")
    token_files.write_tokens(text_table(docs), many, path, file_bytes_target=2000)
    assert key(token_files.summary(spark, many).collect()) == key(want) and token_files.file_totals(spark, many).count() > 2
    monkeypatch.undo()
    some = token_files.read_tokens(spark, folder, [4, 10]).collect()
    assert {r.doc_id for r in some} == {4, 10}
    raw = token_files.file_bytes([1], [b"x"], [1], [0]) + (0x8F92EAB1).to_bytes(4, "little")
    with pytest.raises(Exception):
        list(token_files.read_file(raw))
    empty = new_folder(spark, "tokens")
    token_files.write_tokens(text_table(docs.limit(0)), empty, path)
    assert token_files.read_tokens(spark, empty).count() == 0


def test_long_segments_equal_the_library(monkeypatch):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, m, rng = sentencepiece.SentencePieceProcessor(model_file=path), sentence_pieces.PieceModel(path), random.Random(9)
    for text in ("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(300_000)), "a" * 100_001, "=" * 70_001, "the" * 40_000 + "日" * 3000):
        assert np.array_equal(m.encode(text), sp.encode(text))
    monkeypatch.setattr(sentence_pieces, "LONG_SEGMENT", 3)
    words = [["a", "aa", "=", "-", "--", "ab", " "], list("etaoinsr"), ["the", "ing", "tion", "er", "un", "Ab", "xyz", "é日"]]
    for k in range(600):
        m.seen.clear()
        text = "".join(rng.choice(words[k % 3]) for _ in range(rng.randint(1, 120)))
        assert m.encode(text).tolist() == sp.encode(text), text


def test_sentence_pieces(spark, docs):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {(r.doc_id, bytes(r.ids), r.decoded) for r in sentence_pieces.encode_decode(text_table(docs), path).collect()}
    assert got == {(i, np.array(sp.encode(t or ""), "<u4").tobytes(), sp.decode(sp.encode(t or ""))) for i, t in documents()}
    short = {tuple(r) for r in sentence_pieces.encode_digests(text_table(docs), path).collect()}
    assert short == {(i, len(ids) // 4, brute.sha(",".join(map(str, np.frombuffer(ids, "<u4").tolist())).encode()), brute.sha(t.encode())) for i, ids, t in got}
    rng, m = random.Random(2), sentence_pieces.model(path)
    for _ in range(400):
        t = "".join(rng.choice("abcdethisn o▁ \n  <>s0x/é日=\x00-aa") for _ in range(rng.randint(0, 90)))
        assert m.encode(t).tolist() == sp.encode(t) and m.decode(m.encode(t)) == sp.decode(sp.encode(t))


def test_url_filter(spark):
    urls = ["http://a.EXAMPLE.com/en/7x?q", "http://b.com/en/", "https://example.net/de/81#f", "http://x.net/de/", "http://notnet/de/", None, "no scheme", "http://org", "x://org/es/y", "http://com/en/z://q", "https://example.com?next=https://x.net/en/9", "https://example.org#a://b.net/de/1", "://", "http://com/en/\U0010ffffx", "http://a.com/en/\U0010ffff"]
    pages = spark.createDataFrame([(k % 9, u, "host") for k, u in enumerate(urls)], "page_id long, url string, host string")
    rules = spark.createDataFrame([("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")], url_filter.RULE_SCHEMA)
    got = {(r.host, r.path): (r.rule, r.verdict) for r in url_filter.url_filter(pages, rules).collect()}
    assert got == {
        ("a.example.com", "/en/7x"): ("example.com/en/7", "allow"), ("b.com", "/en/"): ("com/en/", "block"), ("example.net", "/de/81"): ("example.net/de/8", "block"),
        ("x.net", "/de/"): ("net/de/", "allow"), ("notnet", "/de/"): (None, "allow"), ("", ""): (None, "allow"), ("org", ""): (None, "allow"), ("org", "/es/y"): ("org/es/", "block"), ("com", "/en/z://q"): ("com/en/", "block"),
        ("example.com", ""): (None, "allow"), ("example.org", ""): (None, "allow"), ("com", "/en/\U0010ffffx"): ("com/en/", "block"), ("a.com", "/en/\U0010ffff"): ("com/en/", "block"),
    }
    bare = spark.createDataFrame([("com", "", "block")], url_filter.RULE_SCHEMA)
    hosts = spark.createDataFrame([(1, "http://com\u0001x/a"), (2, "http://x\u0001com/a"), (3, "http://b.com"), (4, "http://com/\U0010ffff")], "page_id long, url string")
    assert {r.id: r.rule for r in url_filter.url_filter(hosts, bare).collect()} == {1: None, 2: None, 3: "com", 4: "com"}
    assert url_filter.url_filter(pages.limit(0), rules).count() == 0


def test_top_k(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(k, [float(x) for x in rng.normal(size=8)]) for k in range(120)] + [(200, None), (201, [None, 1.0]), (202, [float("nan")]), (300, [0.5] * 8), (301, [0.5] * 8), (302, [0.5] * 8), (None, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = key((r.query_id, r.rank, r.vec_id, r.score) for r in top_k.search(df).collect())
    good = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v and None not in v and not any(map(np.isnan, v))]
    want = []
    for q, v in good:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == key(want)
    monkeypatch.setattr(top_k, "QUERY_CHUNK", 1)  # several chunks, cells, rings and spans
    monkeypatch.setattr(top_k, "CELL_ROWS", 16)
    monkeypatch.setattr(top_k, "RING_ROWS", 4)
    monkeypatch.setattr(top_k, "SPAN_CELLS", 2)
    assert key((r.query_id, r.rank, r.vec_id, r.score) for r in top_k.search(df).collect()) == key(want)
    assert top_k.search(df.limit(0)).count() == 0
    empty = spark.createDataFrame([(k, []) for k in range(4)], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in top_k.search(empty, k=2).orderBy("rank").collect()] == [(0, 1, 1, 0), (0, 2, 2, 0)]


def plain_score(net, text):
    """One document, one window and one word at a time."""
    words, scores = text.lower().split(), []
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    w, h = {k: v.astype(np.float64) for k, v in net.w.items()}, toxicity.HIDDEN
    for start in range(0, max(1, len(words) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE):
        x, sides = net.inputs(words[start : start + toxicity.WINDOW]).astype(np.float64), {}
        for side, order in (("f", range(len(x))), ("b", range(len(x) - 1, -1, -1))):
            state, sides[side] = np.zeros(h), [None] * len(x)
            for k in order:
                gates = x[k] @ w[side + "x"] + w[side + "b"]
                z, r = np.split(sigmoid(gates[: 2 * h] + state @ w[side + "u"]), 2)
                state = (1 - z) * np.tanh(gates[2 * h :] + (r * state) @ w[side + "n"]) + z * state
                sides[side][k] = state
        states = np.concatenate([sides["f"], sides["b"]], 1)
        attention = np.exp(np.tanh(states @ w["aw"] + w["ab"]) @ w["av"])
        scores.append(sigmoid((attention / attention.sum()) @ states @ w["ow"] + w["ob"][0]))
        if start + toxicity.WINDOW >= len(words):
            break
    return max(scores)


def test_toxicity(spark, docs):
    rng = random.Random(4)
    plain = ["tree", "house", "river", "stone", "cloud", "paper"]
    texts = [" ".join(rng.choice(plain) for _ in range(rng.randint(5, 150))) for _ in range(160)]
    labels = [k % 2 for k in range(160)]
    texts = [t + (" grumbleworth " + t[:50] if y else "") for t, y in zip(texts, labels)]
    net = toxicity.train([t.encode() for t in texts[:120]], labels[:120])
    some = [*texts[120:140], " ".join(texts[:9]), "one", " ".join(["river"] * 65)]
    assert np.allclose(net.document_scores([t.encode() for t in some]), [plain_score(net, t.encode()) for t in some], atol=1e-4)
    guess = net.document_scores([t.encode() for t in texts[120:]]) >= 0.5
    assert np.mean(guess == np.array(labels[120:])) >= 0.9
    out = toxicity.score(text_table(docs), net)
    assert out.count() == docs.count() and out.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert {r.score for r in out.filter("doc_id IN (1, 2, 3)").collect()} == {float(net.document_scores([b""])[0])}
    assert toxicity.score(text_table(docs.limit(0)), net).count() == 0
    assert (toxicity.train([], []).document_scores([b"a", b""]) < 0.5).all()
