"""Operator 4, toxicity: a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word enters as two halves: an embedding of its hashed form and the mean embedding of its hashed character trigrams. The
network reads windows of ``WINDOW`` words, ``STRIDE`` apart, so that neighbours overlap and together cover the whole text;
a document's score is its highest window's. Only the text is an input. What a word adds to the gates is computed once a
distinct word and kept.

Training takes at most ``TRAIN_TOXIC`` and ``TRAIN_CLEAN`` documents of the two classes (smallest hashes of their ids), by
multiple-instance learning: a toxic document teaches with its highest window, a clean one with its highest and a random
one, and ``REPEATS`` windows of a clean word over and over are added, so that repetition alone is no sign.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_values, doc_batches, hand_back_memory, range_hashes, window_hashes

WINDOW, STRIDE = 64, 32
TRAIN_TOXIC, TRAIN_CLEAN, EPOCHS, BATCH, RATE, SEED = 800, 1600, 7, 64, 0.01, 11
#: Made-up clean windows in each epoch: one word of a clean document over and over.
REPEATS = 256
#: Steps of the optimiser at least: a small sample is passed more often.
MIN_STEPS = 300
HIDDEN, WORD_DIM, CHAR_DIM, ATTEND = 8, 6, 6, 8
BUCKETS = 1 << 14
CACHED_WORDS = 150_000


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each word, and the buckets of its character trigrams with the end of each word's run of them."""
    framed = [b"<" + w + b">" for w in words]
    body = b"".join(framed)
    ends = np.cumsum([len(f) for f in framed])
    starts = ends - np.array([len(f) for f in framed])
    values = byte_values(body)
    word = (range_hashes(values, starts, ends) % np.uint64(BUCKETS)).astype(np.int64)
    grams = (window_hashes(values, 3) % np.uint64(BUCKETS)).astype(np.int64)
    inside = np.ones(len(body), bool)
    inside[ends - 1] = inside[ends - 2] = False
    return word, grams[inside[: len(grams)]], np.cumsum(ends - starts - 2)


class Network:
    """Weights, and what the words seen so far add to the gates."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = {k: v.astype(np.float32) for k, v in weights.items()}
        self.row_of: dict[bytes, int] = {}
        self.rows = np.zeros((1024, 6 * HIDDEN), np.float32)

    def inputs(self, words: list[bytes]) -> np.ndarray:
        word, gram, ends = word_features(words)
        chars = np.add.reduceat(self.w["char"][gram], np.concatenate([[0], ends[:-1]]), axis=0)
        return np.concatenate([self.w["word"][word], chars / np.diff(ends, prepend=0)[:, None].astype(np.float32)], 1)

    def numbers(self, texts: list[bytes]) -> list[np.ndarray]:
        """Rows of each text's words in ``self.rows``; row 0 is padding."""
        parts = [t.lower().split() for t in texts]
        while len(self.row_of) > CACHED_WORDS:  # those seen first stay, mostly the frequent ones
            self.row_of.popitem()
        new = list(set().union(*parts).difference(self.row_of))
        if new:
            at = len(self.row_of) + 1
            x = self.inputs(new)
            if at + len(new) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros((max(len(self.rows), len(new)), 6 * HIDDEN), np.float32)])
            self.rows[at : at + len(new), : 3 * HIDDEN] = x @ self.w["fx"] + self.w["fb"]
            self.rows[at : at + len(new), 3 * HIDDEN :] = x @ self.w["bx"] + self.w["bb"]
            self.row_of.update(zip(new, range(at, at + len(new))))
        return [np.fromiter(map(self.row_of.__getitem__, p), np.int64, len(p)) for p in parts]

    def window_logits(self, windows: np.ndarray) -> np.ndarray:
        """Logit of each row of word numbers (0: padding at the end)."""
        out = np.empty(len(windows), np.float32)
        order = np.argsort((windows > 0).sum(1), kind="stable")  # windows of one length together: little padding
        for at in range(0, len(windows), 2048):
            some = order[at : at + 2048]
            own = windows[some]
            length = int((own > 0).sum(1).max())
            out[some] = self._forward(np.ascontiguousarray(own[:, :length].T))
        return out

    def _forward(self, t: np.ndarray) -> np.ndarray:
        steps, n = t.shape
        states = np.empty((steps, n, 2 * HIDDEN), np.float32)
        live = (t > 0)[:, :, None]
        ragged = ~live.all()
        for name, cols, steps_ in (("f", slice(0, 3 * HIDDEN), range(steps)), ("b", slice(3 * HIDDEN, None), range(steps - 1, -1, -1))):
            u, un = self.w[name + "u"], self.w[name + "n"]
            h, rows = np.zeros((n, HIDDEN), np.float32), np.ascontiguousarray(self.rows[:, cols][: len(self.row_of) + 1]) if n * steps > len(self.row_of) else self.rows[:, cols]
            at = slice(0, HIDDEN) if name == "f" else slice(HIDDEN, None)
            for k in steps_:
                x = rows[t[k]]
                zr = x[:, : 2 * HIDDEN] + h @ u
                np.clip(zr, -30, 30, out=zr)
                np.negative(zr, out=zr)
                np.exp(zr, out=zr)
                zr += 1
                np.reciprocal(zr, out=zr)
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                m = np.tanh(x[:, 2 * HIDDEN :] + (r * h) @ un)
                h = m + z * (h - m)
                if ragged:
                    h = h * live[k]
                states[k, :, at] = h
        s = np.tanh(states @ self.w["aw"] + self.w["ab"]) @ self.w["av"]
        s = np.where(live[:, :, 0], s, -1e9)
        a = np.exp(s - s.max(0))
        a /= a.sum(0)
        return np.einsum("tn,tnh->nh", a, states) @ self.w["ow"] + self.w["ob"][0]

    def document_scores(self, texts: list[bytes]) -> np.ndarray:
        numbers = self.numbers(texts)
        windows, owner = cut_windows(numbers)
        logits = np.full(len(texts), float(self.w["empty"][0]))
        if len(windows):
            first = np.searchsorted(owner, np.unique(owner))
            logits[np.unique(owner)] = np.maximum.reduceat(self.window_logits(windows), first)
        return _sigmoid(logits)


def cut_windows(numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All overlapping windows of each document (padded with 0) and the document of each."""
    lens = np.array([len(x) for x in numbers], np.int64)
    count = np.where(lens > 0, 1 + np.maximum(0, -(-(lens - WINDOW) // STRIDE)), 0)
    owner = np.repeat(np.arange(len(lens)), count)
    start = (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * STRIDE
    flat = np.concatenate([*numbers, np.zeros(WINDOW, np.int64)])
    base = (np.cumsum(lens) - lens)[owner]
    at = start[:, None] + np.arange(WINDOW)
    return np.where(at < lens[owner][:, None], flat[np.minimum(base[:, None] + at, len(flat) - 1)], 0), owner


# --- training ---------------------------------------------------------------------------------------------------------


def first_weights(words: list[bytes], present: list[tuple[np.ndarray, int]], rng: np.random.Generator) -> dict[str, np.ndarray]:
    """Random weights; one coordinate of each embedding starts as the training documents' smoothed log-odds."""
    h, d = HIDDEN, WORD_DIM + CHAR_DIM
    w = {"word": rng.normal(0, 0.1, (BUCKETS, WORD_DIM)), "char": rng.normal(0, 0.1, (BUCKETS, CHAR_DIM))}
    word, gram, ends = word_features(words)
    starts = np.concatenate([[0], ends[:-1]])
    counts = {"word": np.zeros((2, BUCKETS)), "char": np.zeros((2, BUCKETS))}
    total = [0, 0]
    for numbers, label in present:
        own = np.unique(numbers) - 1
        total[label] += 1
        counts["word"][label][np.unique(word[own])] += 1
        counts["char"][label][np.unique(np.concatenate([gram[starts[i] : ends[i]] for i in own] or [gram[:0]]))] += 1
    for name in ("word", "char"):
        no, yes = (counts[name][k] + 0.5 for k in (0, 1))
        odds = np.log(yes / (total[1] + 1.0)) - np.log(no / (total[0] + 1.0))
        seen = counts[name].sum(0) > 0
        w[name][seen, 0] = np.clip(odds[seen], -4, 4) / 2
    for a in "fb":
        w |= {a + "x": rng.normal(0, d**-0.5, (d, 3 * h)), a + "b": np.zeros(3 * h), a + "u": rng.normal(0, h**-0.5, (h, 2 * h)), a + "n": rng.normal(0, h**-0.5, (h, h))}
    w |= {"aw": rng.normal(0, (2 * h) ** -0.5, (2 * h, ATTEND)), "ab": np.zeros(ATTEND), "av": rng.normal(0, ATTEND**-0.5, ATTEND), "ow": rng.normal(0, (2 * h) ** -0.5, 2 * h), "ob": np.zeros(1)}
    return w


def step(w: dict[str, np.ndarray], x: np.ndarray, live: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
    """Loss, gradients of the dense weights and of the inputs ``x`` (steps, windows, features)."""
    steps, n, _ = x.shape
    h_ = HIDDEN
    states, kept = np.zeros((steps, n, 2 * h_)), {}
    for a, at, order in (("f", slice(0, h_), range(steps)), ("b", slice(h_, None), range(steps - 1, -1, -1))):
        h, gx = np.zeros((n, h_)), x @ w[a + "x"] + w[a + "b"]
        for k in order:
            zr = _sigmoid(gx[k][:, : 2 * h_] + h @ w[a + "u"])
            z, r = zr[:, :h_], zr[:, h_:]
            m = np.tanh(gx[k][:, 2 * h_ :] + (r * h) @ w[a + "n"])
            kept[a, k] = (h, z, r, m)
            h = ((1 - z) * m + z * h) * live[k][:, None]
            states[k][:, at] = h
    t = np.tanh(states @ w["aw"] + w["ab"])
    s = np.where(live > 0, t @ w["av"], -1e9)
    p = np.exp(s - s.max(0))
    p /= p.sum(0)
    pooled = np.einsum("tn,tnh->nh", p, states)
    prob = _sigmoid(pooled @ w["ow"] + w["ob"][0])
    loss = -np.mean(y * np.log(prob + 1e-9) + (1 - y) * np.log(1 - prob + 1e-9))
    g = {k: np.zeros_like(v) for k, v in w.items() if k not in ("word", "char", "empty")}
    do = (prob - y) / n
    g["ow"], g["ob"] = pooled.T @ do, np.array([do.sum()])
    dpooled = do[:, None] * w["ow"]
    dstates = p[:, :, None] * dpooled[None]
    dp = np.einsum("tnh,nh->tn", states, dpooled)
    ds = p * (dp - (p * dp).sum(0))
    dt = ds[:, :, None] * w["av"] * (1 - t * t)
    g["av"], g["aw"], g["ab"] = np.einsum("tn,tna->a", ds, t), np.einsum("tnh,tna->ha", states, dt), dt.sum((0, 1))
    dstates += dt @ w["aw"].T
    dx = np.zeros_like(x)
    for a, at, order in (("f", slice(0, h_), range(steps - 1, -1, -1)), ("b", slice(h_, None), range(steps))):
        carry, dgx = np.zeros((n, h_)), np.zeros((steps, n, 3 * h_))
        for k in order:
            h, z, r, m = kept[a, k]
            dh = (dstates[k][:, at] + carry) * live[k][:, None]
            dm = dh * (1 - z) * (1 - m * m)
            drh = dm @ w[a + "n"].T
            dz, dr = dh * (h - m) * z * (1 - z), drh * h * r * (1 - r)
            dzr = np.concatenate([dz, dr], 1)
            g[a + "u"] += h.T @ dzr
            g[a + "n"] += (r * h).T @ dm
            carry = dh * z + drh * r + dzr @ w[a + "u"].T
            dgx[k] = np.concatenate([dzr, dm], 1)
        g[a + "x"], g[a + "b"] = np.einsum("tnd,tng->dg", x, dgx), dgx.sum((0, 1))
        dx += dgx @ w[a + "x"].T
    return float(loss), g, dx


def train(texts: list[bytes], labels: list[int], epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """A network for the labelled texts; with one class alone, or none, one whose scores are constant."""
    rng = np.random.default_rng(seed)
    y = np.array(labels, np.int64)
    vocabulary = {w: k + 1 for k, w in enumerate(sorted({w for t in texts for w in t.lower().split()}))}
    words = list(vocabulary)
    numbers = [np.array([vocabulary[w] for w in t.lower().split()], np.int64) for t in texts]
    some = [k for k, x in enumerate(numbers) if len(x)]
    numbers, y = [numbers[k] for k in some], y[some]
    w = first_weights(words or [b"-"], list(zip(numbers, y.tolist())), rng)
    if len(set(y.tolist())) < 2:
        w["ow"][:] = 0
        w["ob"][:] = w_empty = 3.0 if len(y) and y[0] else -3.0
        return Network(w | {"empty": np.array([w_empty])})
    word, gram, ends = word_features(words)
    starts = np.concatenate([[0], ends[:-1]])
    windows, owner = cut_windows(numbers)
    lead = np.searchsorted(owner, np.arange(len(y)))
    odds = np.append(0.0, w["word"][word, 0] + 2 * np.maximum.reduceat(w["char"][gram, 0], starts))
    value = odds[windows].max(1)  # the first choice of windows, before the network knows anything
    running = np.concatenate([x for x, label in zip(numbers, y) if not label])
    clean = np.unique(running)
    clean = clean[odds[clean] <= np.quantile(odds[clean], 0.99)]
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in w.items()}
    count = 0
    steps = -(-(len(y) + int((y == 0).sum())) // BATCH)
    for _ in range(max(epochs, -(-MIN_STEPS // steps))):
        pick = [int(a + value[a:b].argmax()) for a, b in zip(lead, np.append(lead[1:], len(owner)))]
        extra = [int(rng.integers(a, b)) for k, (a, b) in enumerate(zip(lead, np.append(lead[1:], len(owner)))) if not y[k]]
        chosen = np.array(pick + extra)
        chosen = chosen[rng.permutation(len(chosen))]
        repeats = np.where(np.arange(WINDOW) < rng.integers(8, WINDOW + 1, REPEATS)[:, None], np.concatenate([rng.choice(clean, REPEATS // 2), rng.choice(running, REPEATS - REPEATS // 2)])[:, None], 0)
        batches = -(-len(chosen) // BATCH)
        for part, more in zip(np.array_split(chosen, batches), np.array_split(repeats, batches)):
            own = np.concatenate([windows[part], more]).T
            target = np.concatenate([y[owner[part]], np.zeros(len(more))]).astype(np.float64)
            live = (own > 0).astype(np.float64)
            flat, place = np.unique(own, return_inverse=True)
            used = np.maximum(flat - 1, 0)
            lens = ends[used] - starts[used]
            grams = np.concatenate([gram[starts[i] : ends[i]] for i in used])
            bounds = np.cumsum(lens) - lens
            vec = np.concatenate([w["word"][word[used]], np.add.reduceat(w["char"][grams], bounds, axis=0) / lens[:, None]], 1)
            _, g, dx = step(w, vec[place.reshape(own.shape)], live, target)
            dvec = np.zeros_like(vec)
            np.add.at(dvec, place.ravel(), (dx * live[:, :, None]).reshape(-1, dx.shape[2]))
            g["word"], g["char"] = np.zeros_like(w["word"]), np.zeros_like(w["char"])
            np.add.at(g["word"], word[used], dvec[:, :WORD_DIM])
            np.add.at(g["char"], grams, np.repeat(dvec[:, WORD_DIM:] / lens[:, None], lens, axis=0))
            count += 1
            norm = np.sqrt(sum((v * v).sum() for v in g.values()))
            for k, v in g.items():
                v = v * min(1.0, 5.0 / (norm + 1e-12))
                m = moment[k]
                m[0] = 0.9 * m[0] + 0.1 * v
                m[1] = 0.999 * m[1] + 0.001 * v * v
                w[k] = w[k] - RATE * (m[0] / (1 - 0.9**count)) / (np.sqrt(m[1] / (1 - 0.999**count)) + 1e-8)
        net = Network(w | {"empty": w["ob"]})
        net.row_of = {b"": 0} | vocabulary  # numbers stand as they are
        x = net.inputs(words)
        net.rows = np.concatenate([np.zeros((1, 6 * HIDDEN), np.float32), np.concatenate([x @ net.w["fx"] + net.w["fb"], x @ net.w["bx"] + net.w["bb"]], 1)])
        value = net.window_logits(windows)
    return Network(w | {"empty": np.minimum(w["ob"], -1.0)})


def held_out(id_: F.Column) -> F.Column:
    """The fold that no training sees: crc32 of the id as text divides by 5."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, most_toxic: int = TRAIN_TOXIC, most_clean: int = TRAIN_CLEAN) -> Network:
    """Train on at most so many documents of each class outside the held-out fold, as ``labels.toxic`` marks them."""
    marked = labels.select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic")).filter("label_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("label_id")))
    marked = marked.groupBy("label_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    order = [F.xxhash64("label_id"), "label_id"]
    chosen = marked.filter("toxic = 1").orderBy(*order).limit(most_toxic).union(marked.filter("toxic = 0").orderBy(*order).limit(most_clean))
    rows = docs.join(F.broadcast(chosen), docs["doc_id"] == F.col("label_id")).select("doc_id", "text", "toxic").toArrow()
    rows = sorted({(i, t or "", y) for i, t, y in zip(*(rows.column(c).to_pylist() for c in range(3)))})
    network = train([t.encode() for _, t, _ in rows], [y for _, _, y in rows])
    del rows
    hand_back_memory()
    return network


def score(df: DataFrame, network: Network) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``doc_id, text``.

    Null and empty texts, and those of spaces alone, get one low score. Null ids and repeated rows are scored like others.
    """
    scored = annotate(df.select("doc_id", "text"), network, "text", "score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def annotate(df: DataFrame, network: Network, text_col: str, score_col: str) -> DataFrame:
    """All columns of ``df`` and ``score_col``, which must be a name of its own."""
    weights, at = network.w, df.columns.index(text_col)
    if score_col in df.columns:
        raise ValueError(f"the input has a column {score_col} already")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(weights)
        for b in batches:
            if len(b):
                rows = pa.RecordBatch.from_arrays([pa.array(range(len(b)), pa.int64()), b.column(at)], ["row", "text"])
                scores = np.concatenate([net.document_scores(texts) for _, texts in doc_batches([rows])])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores.astype(np.float64))], [*b.schema.names, score_col])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(score_col, T.DoubleType())]))
