"""Brute-force versions and odd tables shared by the tests of this folder."""

import re
from collections import Counter

import numpy as np
import xxhash

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=""):
    """A documents frame from (doc_id, text[, lang[, source]]) rows."""
    full = [(*r, *(None, "en", "s")[len(r) - 1 :]) for r in rows]
    return spark.createDataFrame([(i, t, la, s, len(t) if t is not None else None) for i, t, la, s in full], SHAPE)


def odd_rows():
    """NULLs in any column, empty and very long texts, ties, repeated rows."""
    long_ = " ".join(f"w{k % 997}" for k in range(40_000))
    return [(1, None, None, None), (2, "", "en", "s"), (3, " \t\n", "en", None), (4, "a", "en", "s"), (5, "a", None, "s"), (5, "a", None, "s"),
            (None, "a  b", "en", "s"), (None, None, None, None), (6, "a b", "en", "s"), (7, long_, "en", "s"), (8, long_ + " end", "en", "s"), (9, "ß é 漢字 \x00 \x0b x", "de", "s")]


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))


def simhash(text, width=3):
    w = words(text)
    shingles = [b" ".join(w[k : k + width]) for k in range(len(w) - width + 1)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def components(ids, prints, tau=3):
    """Smallest id reachable over links of at most tau bits; ids without None."""
    up = list(range(len(prints)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= tau:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return [least.get(root(k)) for k in range(len(prints))]


def repeats(texts, length):
    """Masks of removed bytes, from all windows of all texts."""
    count = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for t in texts:
        mask = np.zeros(len(t), bool)
        for k in range(len(t) - length + 1):
            if count[t[k : k + length]] > 1:
                mask[k : k + length] = True
        out.append(mask)
    return out
