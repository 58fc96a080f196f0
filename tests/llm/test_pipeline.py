"""Each stage of the corpus pipeline, and all of them, on nulls, empty and long texts, ties, repeated rows, clashing names and empty tables."""

import hashlib
import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
import corpus_pipeline as pipeline  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, kept string, text_md5 string, toxicity_score double, id long"


def rows():
    rng = random.Random(9)
    say = lambda n: " ".join(rng.choice(["tree", "house", "river", "stone", "cloud"]) + str(rng.randint(0, 99)) for _ in range(n))
    base, long = say(120), say(4000)
    texts = [(1, None), (2, ""), (3, " \n"), (4, base), (5, base), (6, base + " end"), (7, base.replace("tree", "wood", 1)), (7, say(30)), (8, long), (9, long + " x"), (None, say(20)), (None, say(25)), (None, base), (4, base), (10, "one")]
    texts += [(20 + k, say(40) + (" grumbleworth vilefoo" if k % 2 else "")) for k in range(40)]
    return [(i, t, "en", [None, "a", "b"][k % 3], len(t or ""), 1, "k", "m", 0.5, 3) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.parquet(d + "/documents.parquet")
    labels = [(20 + k, k % 3 % 2, k % 2) for k in range(40)] + [(None, 1, 1), (1, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(d + "/labels.parquet")
    return d


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(sf_dir + "/documents.parquet")
    clean = pipeline.drop_toxic(spark, docs, sf_dir)
    assert clean.columns == docs.columns
    left = pairs(clean)
    assert {i for i, t in left if i and i >= 20} <= {i for i, t in pairs(docs) if "vilefoo" not in (t or "")} and {(1, None), (2, ""), (10, "one")} <= set(left)

    exact = pipeline.drop_exact_copies(spark, docs, sf_dir)
    best = {}
    for i, t, *_ in rows():
        k = t or ""
        best[k] = min(best.get(k, (i is None, i or 0)), (i is None, i or 0))
    assert exact.columns == docs.columns and sorted((i is None, i or 0, t or "") for i, t in pairs(exact)) == sorted((*v, k) for k, v in best.items())

    near = pipeline.drop_near_copies(spark, exact, sf_dir)
    kept = pairs(near)
    assert near.columns == docs.columns and {i for i, _ in kept if i in (4, 6, 7, 8, 9)} == {4, 7, 8} and len([i for i, _ in kept if i is None]) == 2
    assert {(2, "")} & set(kept) or {(1, None)} & set(kept)

    mixed = pipeline.mix_sources(spark, near, sf_dir)
    times = pairs(mixed)
    assert mixed.columns == docs.columns and all(times.count(x) <= 3 for x in times) and set(times) <= set(kept)

    out = pipeline.tokenize(spark, mixed, sf_dir).collect()
    assert len(out) == len(times) and {r.decoded_sha256 for r in out} == {hashlib.sha256((t or "").encode()).hexdigest() for _, t in times}


def test_run_of_an_empty_table(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(sf_dir + "/documents.parquet")
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(sf_dir + "/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0
