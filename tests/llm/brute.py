"""Plain versions of the operators, for small inputs."""

import hashlib
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def substring_dedup(rows, length):
    """``{row number: (n_words, n_removed, sha)}`` for (doc_id, text) rows; a null id comes last."""
    key = lambda i: (i is None, i or 0)
    words = [WORDS.findall(t or "") for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words):
        for s in range(len(w) - length + 1):
            g = tuple(w[s : s + length])
            first[g] = min(first.get(g, (key(i), s)), (key(i), s))
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for s in range(len(w) - length + 1):
            if first[tuple(w[s : s + length])] < (key(i), s):
                gone.update(range(s, s + length))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone).encode())))
    return out


def byte_dedup(rows, length):
    key = lambda i: (i is None, i or 0)
    first = {}
    texts = [(t or "").encode() for _, t in rows]
    for (i, _), b in zip(rows, texts):
        for s in range(len(b) - length + 1):
            g = b[s : s + length]
            first[g] = min(first.get(g, key(i)), key(i))
    out = []
    for (i, _), b in zip(rows, texts):
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            if first[b[s : s + length]] < key(i):
                gone[s : s + length] = [True] * length
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def jaccard_join(rows, shingle=3, percent=90):
    """``{doc_id: (n_shingles, component_id)}`` for rows with distinct ids."""
    sets = {}
    for i, t in rows:
        w = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def line_dedup(rows, min_docs, min_chars=1):
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    lines = [(t or "").split("\n") for _, t in rows]
    held = {}
    for k, own in enumerate(lines):
        for line in own:
            held.setdefault(key(line), set()).add(k)
    gone = {k for k, docs in held.items() if len(k) >= min_chars and len(docs) >= min_docs}
    kept = [[line for line in own if key(line) not in gone] for own in lines]
    return [(i, len(a), len(a) - len(b), "\n".join(b)) for (i, _), a, b in zip(rows, lines, kept)]


def hard_negatives(rows, every=100, positives=5, negatives=5):
    """``rows`` are (id, label, integer vector) with distinct ids."""
    out = []
    for a, label, q in rows:
        if a % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(q, v)), i, other) for i, other, v in rows if i != a)
            for ps, p, _ in [r for r in scored if r[2] == label][:positives]:
                found = [(s, i) for s, i, other in scored if other != label and -80 * ps <= -100 * s <= -100 * ps][:negatives]
                out += [(a, p, k + 1, i, -ps, -s) for k, (s, i) in enumerate(found)]
    return out


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def vocabulary(rows, modulus=97, min_chars=5, min_count=3):
    import zlib

    counts = {}
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % modulus == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] = counts.get(w, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= min_chars and n >= min_count}


def variants(counts, near=one_edit):
    """``(word, form, root, n, n_near, form_n)`` by comparing all pairs."""
    forms, rows = {}, []
    for w in counts:
        others = [x for x in counts if near(w, x)]
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        forms[w] = (len(others), best if best is not None and counts[best] >= 2 * counts[w] else None)
    for w, n in counts.items():
        root = w
        while forms[root][1] is not None:
            root = forms[root][1]
        form = forms[w][1]
        rows.append((w, form, root, n, forms[w][0], counts.get(form)))
    return rows
