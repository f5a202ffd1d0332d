"""Toxicity by a weighted lexicon.

Texts are folded first: lower case, compatibility forms, invisible characters
removed, look-alike letters of other scripts and digits or signs written for
letters mapped back.  Those at the end of a word may also be punctuation: such
a word is matched with its last run mapped back (to any length) and with it cut
off, and counts once, as the heavier of the two.  An Aho-Corasick automaton then finds the lexicon's
entries (words, and stems at the start of a word) and exception phrases; a
match inside an exception phrase does not count.  The summed weights, plain and
normalised by the text's length, go through a fitted logistic function.

Entries, weights, exception phrases and the function are learned from a bounded
sample of labelled rows, without near copies, which would bring in all words of
one text.  A stem's known words carry weights of their own (nothing if they are
harmless); the stem's weight is for words not seen before.

Defined results: NULL and empty texts have no match and get the score of a text
without matches; NULL labels are not learned from; without toxic labels every
score is next to 0 (the logistic function at -30); repeated rows get equal
results; a score of exactly 0.5 counts as toxic; very long texts are scored
whole; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, in_fold, pieces

PER_CLASS = 4000  # bound of the labelled sample: toxic rows, and half of the clean ones
TERM_DOCS = 5  # sample texts that a term must occur in
LEAST_ODDS = 1.5  # log odds of an entry
STRONG = 40.0  # least likelihood-ratio statistic of an entry (chance: about 1 in 4 billion)
MAX_ENTRIES = 2000
STEMS = (3, 4, 5, 6, 7)  # letters of a stem

# Look-alikes of Latin letters, and digits and signs written for letters.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
    "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x", "ӏ": "l", "ё": "e",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x", "γ": "y", "ω": "w",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "ℓ": "l", "ꜱ": "s", "ʟ": "l", "ɪ": "i", "ᴏ": "o",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i"}

_LOOK = str.maketrans(LOOKALIKES)
_DIGIT = str.maketrans(DIGITS)
_HAS_LOOK = re.compile("[" + "".join(LOOKALIKES) + "]")
_INVISIBLE = re.compile("[­​-‏⁠-⁤﻿]")
_SIGNS = re.compile(r"[0134578@$!|]+(?=[^\W\d_])")  # a run right before a letter
_LAST_SIGNS = re.compile(r"(?<=[^\W\d_])[0134578@$!|]+")  # a run at the end of a word, in a folded text
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str | None) -> str:
    """The text as the automaton sees it."""
    t = (text or "").lower()
    if not t.isascii():
        if not unicodedata.is_normalized("NFKC", t):
            t = unicodedata.normalize("NFKC", t).lower()
        t = _INVISIBLE.sub("", t)
        if _HAS_LOOK.search(t):
            t = t.translate(_LOOK)
    return _SIGNS.sub(lambda m: m.group().translate(_DIGIT), t)


def fold_ends(folded: str) -> str:
    """The folded text with digits and signs at the ends of words as letters too, at the same places."""
    return _LAST_SIGNS.sub(lambda m: m.group().translate(_DIGIT), folded)


def _terms(folded: str) -> set[str]:
    """Words as ``word$`` and their stems as ``stem``."""
    words = set(_WORD.findall(folded))
    return {w + "$" for w in words if len(w) > 2} | {w[:n] for w in words for n in STEMS if len(w) > n}


def _automaton(words):
    a = ahocorasick.Automaton()
    for w, value in words:
        a.add_word(w, value)
    if len(a):
        a.make_automaton()
    return a


class Matcher:
    """The lexicon ``{term: weight}`` and exception phrases, ready to search."""

    def __init__(self, lexicon: dict[str, float], exceptions: list[str] = ()):
        by_word: dict[str, list[str]] = {}
        for term in lexicon:
            by_word.setdefault(term.rstrip("$"), []).append(term)
        self.lexicon = lexicon
        self.automaton = _automaton([(w, (w, terms)) for w, terms in by_word.items()])
        self.phrases = _automaton([(fold(p), len(fold(p))) for p in exceptions])

    def find(self, folded: str) -> list[tuple[int, int, str]]:
        """(start, end, term) of the longest entry at each word start, exceptions taken out."""
        if not len(self.automaton):
            return []
        ends = fold_ends(folded)
        cut: dict[int, tuple[int, int, str]] = {}
        run: dict[int, tuple[int, int, str]] = {}  # entries that end in digits or signs
        for last, (word, terms) in self.automaton.iter(ends):
            start, end = last - len(word) + 1, last + 1
            if start and ends[start - 1].isalpha():
                continue
            out = cut if folded[last] == ends[last] else run
            whole = end == len(folded) or not folded[end].isalpha()
            for term in terms:
                if (whole or not term.endswith("$")) and (start not in out or end >= out[start][1]):
                    out[start] = (start, end, term)
        out = cut
        for start, m in run.items():
            if start not in out or self.lexicon[m[2]] >= self.lexicon[out[start][2]]:
                out[start] = m
        if out and len(self.phrases):
            spans = [(last - n + 1, last + 1) for t in {folded, ends} for last, n in self.phrases.iter(t)]
            out = {s: m for s, m in out.items() if not any(a <= m[0] and m[1] <= b for a, b in spans)}
        return list(out.values())

    def measure(self, folded: str) -> tuple[int, float, int]:
        """Matches, summed weight, words."""
        found = self.find(folded)
        return len(found), sum(self.lexicon[t] for _, _, t in found), folded.count(" ") + folded.count("\n") + 1


def _features(weight, words) -> np.ndarray:
    """Summed weight, and the same by length (a hundred words)."""
    weight = np.maximum(np.asarray(weight, float), 0)
    return np.stack([np.ones_like(weight), np.log1p(weight), np.log1p(weight / (1 + np.asarray(words, float) / 100))], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Newton's method with a small ridge; classes count alike."""
    beta = np.zeros(x.shape[1])
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (share * (y - p)) - ridge * beta
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(curve, slope)
        beta += step
        if abs(step).max() < 1e-9:
            break
    return beta


def _count_terms(batches):
    """(term, toxic texts, clean texts) of every batch."""
    for b in pieces(batches, 1):
        counts = {0: Counter(), 1: Counter()}
        for toxic, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            counts[toxic].update(_terms(fold(text)))
        keys = sorted(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([counts[c][k] for k in keys], pa.int64()) for c in (1, 0))], ["term", "toxic", "clean"])


def _copy_keys(batches):
    """Rows with three minimum hashes of their word shingles, which near copies mostly share."""
    for b in pieces(batches, 1):
        keys = []
        for text in b.column(1).to_pylist():
            words = text.split()
            shingles = [" ".join(words[k : k + 3]).encode() for k in range(max(1, len(words) - 2))]
            keys.append([min(zlib.crc32(s, salt) for s in shingles) for salt in (1, 2, 3)])
        yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array([k[j] for k in keys], pa.int64()) for j in range(3))], [*b.schema.names, "k1", "k2", "k3"])


def _strength(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    """Likelihood-ratio statistic of the term's two counts against the classes' sizes."""
    n, share = toxic + clean, n_toxic / (n_toxic + n_clean)
    part = lambda k, expected: k * math.log(k / expected) if k else 0.0
    return 2 * (part(toxic, n * share) + part(clean, n * (1 - share)))


def _choose(counts: dict[str, tuple[int, int]], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Strong words and stems with their log odds.  Of stems that begin with
    one another the strongest stays (of equals the longest)."""
    odds = lambda t: math.log((counts[t][0] + 0.5) / (n_toxic + 1)) - math.log((counts[t][1] + 0.5) / (n_clean + 1))
    strong = sorted((t for t, c in counts.items() if odds(t) >= LEAST_ODDS and _strength(*c, n_toxic, n_clean) >= STRONG),
                    key=lambda t: (-_strength(*counts[t], n_toxic, n_clean), -len(t), t))
    stems: list[str] = []
    for t in strong:
        if not t.endswith("$") and not any(t.startswith(s) or s.startswith(t) for s in stems):
            stems.append(t)
    words = [t for t in strong if t.endswith("$")]
    # a stem that only one word brings in is that word
    stems = [s for s in stems if not any(w.startswith(s) and counts[w] == counts[s] for w in words)]
    return {t: odds(t) for t in (stems + words)[:MAX_ENTRIES]}


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = PER_CLASS) -> dict | None:
    """Lexicon, exceptions and logistic function from at most ``per_class``
    toxic and twice as many clean labelled rows (smallest id hashes); None
    without toxic ones."""
    hashed = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).withColumn("_h", F.xxhash64(F.lit(3), "_id"))
    drawn = [hashed.where(F.col("label") == c).orderBy("_h", "_id").limit(n) for c, n in ((0, 2 * per_class), (1, per_class))]
    few = drawn[0].unionByName(drawn[1])  # at most 3 * per_class rows of a few numbers: a bounded broadcast
    named = documents.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = named.join(F.broadcast(few), "_id").select("label", "text")
    keyed = texts.mapInArrow(_copy_keys, "label int, text string, k1 bigint, k2 bigint, k3 bigint")
    for k in ("k1", "k2", "k3"):
        one = F.min(F.struct("text", "k1", "k2", "k3")).alias("one")  # the same on every run
        keyed = keyed.groupBy("label", F.col(k).alias("k")).agg(one).select("label", "one.*")
    sample = cut(keyed.select("label", "text"))
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not n_toxic:
        return None
    counted = sample.mapInArrow(_count_terms, "term string, toxic bigint, clean bigint").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counted = cut(counted.where(F.col("toxic") + F.col("clean") >= TERM_DOCS))
    take = lambda rows: {r["term"]: (r["toxic"], r["clean"]) for r in rows.limit(40_000).collect()}
    counts = take(counted.where((F.col("toxic") >= TERM_DOCS) & ((F.col("toxic") + 0.5) * (n_clean + 1) > math.exp(LEAST_ODDS) * (F.col("clean") + 0.5) * (n_toxic + 1))).orderBy(F.desc("toxic"), "term"))
    lexicon = _choose(counts, n_toxic, n_clean)
    stems = [t for t in lexicon if not t.endswith("$")]
    if stems:  # known words of a stem weigh by their own counts, harmless ones nothing
        known = take(counted.where(F.col("term").endswith("$") & F.col("term").rlike("^(" + "|".join(stems) + ")")).orderBy(F.desc(F.col("toxic") + F.col("clean")), "term"))
        for t, (x, y) in known.items():
            lexicon.setdefault(t, max(0.0, math.log((x + 0.5) / (n_toxic + 1)) - math.log((y + 0.5) / (n_clean + 1))))
    exceptions = _exceptions(sample, lexicon, n_clean, n_toxic)
    measured = _measured(sample, lexicon, exceptions).select("label", "weight", "words").toPandas().sort_values(["label", "weight", "words"])
    beta = _logistic(_features(measured.weight, measured.words), measured.label.to_numpy())
    return {"lexicon": lexicon, "exceptions": exceptions, "beta": beta.tolist()}


def _exceptions(sample: DataFrame, lexicon: dict, n_clean: int, n_toxic: int) -> list[str]:
    """Two-word phrases around a match that speak for a clean text."""

    def around(batches):
        matcher = Matcher(lexicon)
        for b in batches:
            out = []
            for label, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                folded, phrases = fold(text), set()
                for start, end, _ in matcher.find(folded):
                    word = _WORD.match(folded, start)
                    before = re.search(r"[^\W\d_]+ $", folded[max(0, start - 40) : start])
                    after = re.match(r" [^\W\d_]+", folded[word.end() : word.end() + 40]) if word else None
                    phrases |= {before.group() + word.group()} if before and word else set()
                    phrases |= {word.group() + after.group()} if after else set()
                out += [(p, label) for p in sorted(phrases)]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.string()), pa.array([n for _, n in out], pa.int32())], ["phrase", "label"])

    counted = sample.mapInArrow(around, "phrase string, label int").groupBy("phrase").agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n"))
    clean = F.col("n") - F.col("toxic")
    benign = counted.where((clean >= 5) & (clean * n_toxic > 4 * F.col("toxic") * n_clean))
    return sorted(r["phrase"] for r in benign.orderBy(F.desc("n"), "phrase").limit(MAX_ENTRIES).collect())


def _measured(df: DataFrame, lexicon: dict, exceptions: list[str]) -> DataFrame:
    """First column kept; matches, weight and words of the second."""
    first = df.columns[0]

    def run(batches):
        matcher = Matcher(lexicon, exceptions)
        for b in pieces(batches, 1):
            out = [matcher.measure(fold(t)) for t in b.column(1).to_pylist()]
            n, weight, words = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(weight, pa.float64()), pa.array(words, pa.int64())], [first, "matches", "weight", "words"])

    return df.mapInArrow(run, f"`{first}` {df.schema[0].dataType.simpleString()}, matches bigint, weight double, words bigint")


def score(df: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``score`` (0 to 1), ``matches``, ``weight``, ``words``."""
    model = model or {"lexicon": {}, "exceptions": [], "beta": [-30.0, 0.0, 0.0]}
    rows = _measured(df.select(F.col(id_col), F.col(text_col).cast("string")), model["lexicon"], model["exceptions"])
    b0, b1, b2 = (F.lit(float(b)) for b in model["beta"])
    z = b0 + b1 * F.log1p("weight") + b2 * F.log1p(F.col("weight") / (1 + F.col("words") / 100))
    return rows.select(F.col(id_col), (1 / (1 + F.exp(-z))).alias("score"), "matches", "weight", "words")


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn outside the held-out fold, score every document."""
    model = fit(documents, labels.where(~in_fold(F.col("doc_id"), 5, 0)))
    done = score(documents, model)
    return done.select("doc_id", in_fold(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "matches", "words")
