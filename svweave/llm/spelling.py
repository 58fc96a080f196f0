"""Operator 13, spelling variants grouped by reduced-alphabet generation.

Letters are hashed to a few symbols. Each distinct reduced word generates its full one-edit neighbourhood as 64-bit keys,
which meet the keys of the reduced vocabulary in a join: words one edit apart have reduced words at most one edit apart, so
nothing is lost, and the original strings are compared afterwards. A word's form is its most frequent near word; roots follow
forms by pointer jumping, whose rounds grow with the logarithm of a chain, and a chain with that of the largest count.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

LETTERS = r"a-zA-ZÀ-ÿ"
#: Fewest symbols of the reduced alphabet; there are more as the vocabulary's eighth root grows.
LEAST_SYMBOLS = 4
#: Words that a task holds before it hands its counts on, and keys it makes at once.
HELD_WORDS, KEYS_AT_ONCE = 400_000, 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_DOWN = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def word_counts(docs: DataFrame, min_chars: int = 5, min_count: int = 3, typo_modulus: int = 0) -> DataFrame:
    """``word, n``: runs of letters, A-Z lower-cased, of at least ``min_chars`` code points found ``min_count`` times or more.

    With ``typo_modulus``, runs of a document whose crc32 of ``<doc_id>:<run>`` it divides lose a letter first.
    """
    runs = re.compile(f"[{LETTERS}]{{{min_chars},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hand_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        held: Counter = Counter()
        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary())):
                own = Counter(runs.findall((text.as_py() or b"").lower().decode()))
                if typo_modulus:
                    start = zlib.crc32(f"{'' if i is None else i}:".encode())
                    for w, n in own.items():
                        h = zlib.crc32(w.encode(), start)
                        if h % typo_modulus == 0:
                            w = w[: h % len(w)] + w[h % len(w) + 1 :]
                            if len(w) < min_chars:
                                continue
                        held[w] += n
                else:
                    held.update(own)
                if len(held) >= HELD_WORDS:
                    yield hand_on()
        if held:
            yield hand_on()

    counts = docs.select("doc_id", "text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= min_count)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the words of one length and their code points, a row each; few enough at a time."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        size = int(lengths[part[0]]) if len(part) else 0
        step = max(1, KEYS_AT_ONCE // max(1, 32 * size))
        for at in range(0, len(part), step):
            some = part[at : at + step]
            yield some, np.frombuffer("".join([words[k] for k in some.tolist()]).encode("utf-32-le"), "<u4").reshape(len(some), size)


def _symbols(letters: np.ndarray, symbols: int) -> np.ndarray:
    """1 to ``symbols`` for each code point."""
    return ((letters.astype(np.uint64) * np.uint64(2654435761) >> np.uint64(13)) % np.uint64(symbols)) + np.uint64(1)


def _powers(n: int) -> np.ndarray:
    p = np.full(n + 1, _BASE)
    p[0] = 1
    return np.multiply.accumulate(p)


def reduced_keys(words: list[str], symbols: int) -> np.ndarray:
    """Polynomial of each reduced word's symbols modulo 2^64."""
    out = np.zeros(len(words), np.uint64)
    for at, letters in _by_length(words):
        out[at] = (_symbols(letters, symbols) * _powers(letters.shape[1])[:-1]).sum(1, dtype=np.uint64)
    return out


def neighbourhoods(words: list[str], symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(key, neighbour)`` for each reduced word's full one-edit neighbourhood, the word itself included."""
    every = np.arange(1, symbols + 1, dtype=np.uint64)
    for _, letters in _by_length(words):
        s, up = _symbols(letters, symbols), _powers(letters.shape[1] + 1)
        size = s.shape[1]
        terms = s * up[:size]
        key = terms.sum(1, dtype=np.uint64)
        before = np.concatenate([np.zeros((len(s), 1), np.uint64), np.cumsum(terms, 1, dtype=np.uint64)], 1)
        after = key[:, None] - before
        replaced = (key[:, None] - terms)[:, :, None] + every * up[:size, None]
        deleted = before[:, :-1] + after[:, 1:] * _DOWN
        inserted = (before + after * _BASE)[:, :, None] + every * up[: size + 1, None]
        near = np.concatenate([key[:, None], replaced.reshape(len(s), -1), deleted, inserted.reshape(len(s), -1)], 1)
        near.sort(1)
        new = np.concatenate([np.ones((len(s), 1), bool), near[:, 1:] != near[:, :-1]], 1)
        yield np.repeat(key, new.sum(1)), near[new]


def near_words(vocabulary: DataFrame, symbols: int | None = None) -> DataFrame:
    """``word, n, near, near_n``: each ordered pair of ``vocabulary`` (``word, n``) one inserted, deleted or replaced code point apart."""
    words = stored(vocabulary, "words")
    r = symbols or max(LEAST_SYMBOLS, int(np.ceil(words.count() ** 0.125)))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = reduced_keys(b.column(0).to_pylist(), r).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key), b.column(0), b.column(1)], ["key", "word", "n"])

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, near in neighbourhoods(b.column(0).to_pylist(), r):
                # the relation is symmetric: the smaller key of two reports their pair
                own = key <= near
                yield pa.RecordBatch.from_arrays([pa.array(key[own].view(np.int64)), pa.array(near[own].view(np.int64))], ["key", "near_key"])

    by_key = stored(words.select("word", "n").mapInArrow(keyed, "key long, word string, n long"), "reduced")
    classes = by_key.groupBy("key").agg(F.min("word").alias("word"))
    wanted = classes.select("word").mapInArrow(neighbours, "key long, near_key long")
    # Spark sizes what a Python step gives by what it takes: without a hint it may broadcast whole neighbourhoods or vocabularies
    pairs = stored(wanted.join(classes.select(F.col("key").alias("near_key")).hint("merge"), "near_key"), "classes")
    ours = by_key.select("key", F.col("word").alias("a"), F.col("n").alias("an"))
    theirs = by_key.select(F.col("key").alias("near_key"), F.col("word").alias("b"), F.col("n").alias("bn"))
    once = (F.col("key") != F.col("near_key")) | (F.col("a") < F.col("b"))
    fits = F.abs(F.length("a") - F.length("b")) <= 1
    met = pairs.join(ours.hint("merge"), "key").join(theirs.hint("merge"), "near_key").filter(once & fits).filter(F.levenshtein("a", "b", 1) == 1)
    there = met.select(F.col("a").alias("word"), F.col("an").alias("n"), F.col("b").alias("near"), F.col("bn").alias("near_n"))
    ways = [F.struct(*(F.col(c).alias(name) for c, name in zip(order, there.columns))) for order in (there.columns, ["near", "near_n", "word", "n"])]
    return there.select(F.explode(F.array(*ways)).alias("p")).select("p.*")


def follow(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``forms`` (``word, form``) by pointer jumping; forms must not run in a circle."""
    roots, left = stored(forms.select("word", F.col("form").alias("root")), "roots"), 1
    while left:
        on = roots.select(F.col("word").alias("at"), F.col("root").alias("beyond"))
        step = roots.join(on.hint("merge"), roots["root"] == on["at"], "left")
        roots = stored(step.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        left = roots.filter("moved").count()
    return roots.select("word", "root")


def group_variants(vocabulary: DataFrame, ratio: int = 2, symbols: int | None = None) -> DataFrame:
    """``word, n, form, root, n_near, form_n`` for each row of ``vocabulary`` (distinct ``word``, its count ``n``).

    A word's form is the near word of largest count (ties: smallest in code-point order) if that count is at least ``ratio``
    (above 1) times the word's; its root is where forms lead, the word itself if it has none. Words of any length take part; an
    empty vocabulary gives no rows.
    """
    vocabulary = stored(vocabulary.select("word", "n"), "vocabulary")
    best = F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), "near"))
    found = stored(near_words(vocabulary, symbols).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best")).select("word", "n_near", "best.*"), "near")
    judged = vocabulary.join(found.hint("merge"), "word", "left").withColumn("fits", F.coalesce(F.col("near_n") >= ratio * F.col("n"), F.lit(False)))
    judged = stored(judged.select("word", "n", F.expr("IF(fits, near, NULL)").alias("form"), F.coalesce("n_near", F.lit(0)).alias("n_near"), F.expr("IF(fits, near_n, NULL)").alias("form_n")), "judged")
    roots = follow(judged.filter("form IS NOT NULL").select("word", "form"))
    return judged.join(roots.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, min_chars: int = 5, min_count: int = 3, ratio: int = 2, typo_modulus: int = 0, symbols: int | None = None) -> DataFrame:
    """:func:`group_variants` over the words of whole texts (:func:`word_counts`) of ``docs`` (``doc_id, text``).

    Null and empty texts have no words; a null id counts as an empty one; rows that repeat an id or a text count each. An empty
    table gives no rows.
    """
    return group_variants(word_counts(docs, min_chars, min_count, typo_modulus), ratio, symbols)
