"""A training corpus from ``documents``: five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from svweave.llm import exact_dedup, jaccard_join, mixing, sentence_pieces, toxicity
from svweave.llm.common import new_folder, stored, text_table
from svweave.llm.queries import table, tokenizer_path, with_quality


def free_name(name: str, docs: DataFrame) -> str:
    """``name``, or with underscores where ``docs`` has such a column."""
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5. Empty and null texts score low and stay; each row of a repeated or null id is judged
    by its own text. An empty table stays empty."""
    network = toxicity.fit(text_table(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels"))
    score = free_name("toxicity_score", docs)
    return toxicity.annotate(docs, network, "text", score).filter(F.col(score) < 0.5).drop(score)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row, with the smallest id; any one of the rows that repeat this id. Null ids come last, null and
    empty texts are equal. An empty table stays empty."""
    judged = exact_dedup.exact_dedup(docs, keep="smallest").filter("kept")
    keys = stored(judged.groupBy("id", "text_sha256").agg(F.count("*").alias("rows")), "kept")
    sha = F.sha2(F.coalesce(docs["text"], F.lit("")), 256)
    out = docs.join(keys.filter("rows = 1"), docs["doc_id"].eqNullSafe(keys["id"]) & (sha == keys["text_sha256"]), "left_semi")
    repeated = keys.filter("rows > 1")
    if not repeated.isEmpty():
        name = free_name("text_sha256", docs)
        again = docs.join(repeated, docs["doc_id"].eqNullSafe(repeated["id"]) & (sha == repeated["text_sha256"]), "left_semi")
        again = again.withColumn(name, F.sha2(F.coalesce("text", F.lit("")), 256)).dropDuplicates(["doc_id", name]).drop(name)
        out = out.unionByName(again)
    return out


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each component of five-word shingle similarity of 0.8 or more.

    Null ids come last. Documents without words are components of their own and stay. Rows that repeat both id and text, which
    the exact stage leaves none of, stay or go together. An empty table stays empty.
    """
    judged = jaccard_join.jaccard_join(text_table(docs), shingle=5, percent=80).filter("kept").select(F.col("doc_id").alias("keep_id"), F.lower(F.hex("text_md5")).alias("keep_md5"))
    return docs.join(judged, docs["doc_id"].eqNullSafe(judged["keep_id"]) & (F.md5(F.coalesce(docs["text"], F.lit(""))) == judged["keep_md5"]), "left_semi")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, or up to three times.

    Rows of a repeated or null id are taken by their own texts; of rows that repeat both, which the exact stage leaves none
    of, each is taken as often as the one that is taken most. Null and empty texts have no words and are taken as their
    source's epochs say. An empty table stays empty.
    """
    weighed = with_quality(spark, mixing.measure(docs), sf_dir)
    taken = mixing.mix(weighed, quality_col="quality_weight").groupBy("id", "text_md5").agg(F.max("epochs").alias("epochs")).filter("epochs > 0")
    copies = taken.select("id", "text_md5", F.explode(F.sequence(F.lit(1), "epochs")))
    same = docs["doc_id"].eqNullSafe(copies["id"]) & (F.md5(F.coalesce(docs["text"], F.lit(""))) == copies["text_md5"])
    return docs.join(copies, same).select(*(docs[c] for c in docs.columns))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids' number and digest and the digest of the text they decode to, for each row; null and empty texts have no ids,
    null ids stay null. An empty table stays empty."""
    return sentence_pieces.encode_digests(text_table(docs), tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing", mix_sources),
    ("SentencePiece", tokenize),
]

#: The first stage has a trained model, so no SQL says what is kept.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all of ``documents``; an empty table gives an empty result."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
