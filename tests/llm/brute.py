"""Plain versions of the operators, for small tables."""

import hashlib
import math
import re
from collections import Counter

import numpy as np


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def in_order(rows):
    """(doc_id, text) pairs, null identifiers last."""
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def covered(n, starts, length):
    gone = [False] * n
    for s in starts:
        gone[s : s + length] = [True] * length
    return gone


def repeated_words(rows, window=20):
    """(doc_id, n_words, n_removed, kept_sha256)."""
    seen, out = set(), []
    for doc_id, text in in_order(rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        later = []
        for s in range(len(words) - window + 1):
            run = tuple(words[s : s + window])
            if run in seen:
                later.append(s)
            seen.add(run)
        gone = covered(len(words), later, window)
        out.append((doc_id, len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone) if not g))))
    return out


def repeated_bytes(rows, length=100):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    seen, out = set(), []
    for doc_id, text in in_order(rows):
        data = (text or "").encode()
        later = []
        for s in range(len(data) - length + 1):
            string = hash(data[s : s + length]) if length > 16 else data[s : s + length]
            if string in seen:
                later.append(s)
            seen.add(string)
        gone = covered(len(data), later, length)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(data), sum(gone), spans, sha(bytes(b for b, g in zip(data, gone) if not g))))
    return out


def shingles(text, size=5):
    text = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def similar_groups(rows, size=5, percent=75):
    """(doc_id, n_shingles, component_id)."""
    sets = [shingles(text, size) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        common = {}
        for x in s:
            for j in holders.setdefault(x, []):
                common[j] = common.get(j, 0) + 1
            holders[x].append(i)
        for j, both in common.items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return [(doc_id, len(s), least.get(root(i))) for i, ((doc_id, _), s) in enumerate(zip(rows, sets))]


def common_lines(rows, min_docs=10, min_chars=1):
    """(doc_id, n_lines, n_dropped, kept_sha256)."""
    white = " \t\n\v\f\r"
    lower = {i: i + 32 for i in range(65, 91)}
    lines = [[(line, line.strip(white).translate(lower)) for line in (text or "").split("\n")] for _, text in rows]
    holders = {}
    for i, own in enumerate(lines):
        for _, key in own:
            holders.setdefault(key, set()).add(i)
    out = []
    for (doc_id, _), own in zip(rows, lines):
        kept = [line for line, key in own if len(key) < min_chars or len(holders[key]) < min_docs]
        out.append((doc_id, len(own), len(own) - len(kept), sha("\n".join(kept))))
    return out


def likelier_toxic(rows, labels, bucket_of, domains=("good", "low", "toxic"), buckets=1 << 14, smoothing=0.5, least=0.3):
    """Which (doc_id, text) rows a naive Bayes classifier of all labelled ones takes for toxic rather than anything else."""
    def words(text):
        return "".join(" " if c in "\n\t\r.,;:!?" else c for c in (text or "").lower()).split(" ")

    texts = {i: [bucket_of[w] for w in words(t) if w] for i, t in rows}
    seen = [Counter() for _ in domains]
    for i, d in labels:
        if i in texts:
            seen[domains.index(d)].update(texts[i])
    every = sum(seen, Counter())
    total = [sum(c.values()) + smoothing * buckets for c in seen]
    n = [sum(d == x for _, x in labels) for d in domains]
    out = set()
    for i, own in texts.items():
        score = [math.log((k + 1) / (sum(n) + len(domains))) for k in n]
        for b in own:
            for k, c in enumerate(seen):
                w = math.log((c[b] + smoothing) / total[k]) - math.log((every[b] + smoothing * len(domains)) / sum(total))
                if abs(w) >= least and every[b] >= 5:
                    score[k] += float(np.float32(f"{w:.4g}"))
        if score[2] > max(score[:2]):
            out.add(i)
    return out
