"""Secret scan: fixed patterns plus character Markov models.

Two first-order character models, of random strings and of ordinary
identifiers, are trained on labelled samples: the values that the fixed
patterns find in a bounded sample of documents, and the other words of those
documents.  Every run of ``[A-Za-z0-9+/_=-]`` of ``SHORTEST`` characters or more
that no pattern has taken is a secret when its mean log-likelihood ratio per
character exceeds a threshold set between the two samples.

Defined results: NULL text counts as empty; positions are code points of the
whole text, end exclusive; very long texts are scanned whole; repeated rows give
equal results; documents are sampled by their text, so NULL and repeated ids
teach like others; other columns are ignored; an empty table gives no rows; without samples the
models fall back to a uniform prior and add nothing.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, cut, pieces

# Fixed values of the scan's contract: kinds in their order, and patterns.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}

RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")  # holds every access and hex match that is long enough
SHORTEST = 20  # characters of a run that the models judge
SAMPLE_DOCS = 8000  # bound of the documents that the models are trained on, ...
RANDOM_WORDS, PLAIN_WORDS = 20_000, 50_000  # ... and of the different words of either sample that the driver gets, the most frequent ones
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_INDEX = {c: k for k, c in enumerate(ALPHABET)}
_WORD = re.compile(r"[A-Za-z0-9+/_=-]{6,}")
_KEYWORDS = ("passw", "secret", "token", "api_key", "apikey")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, ordered by start, then kind."""
    out = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    for run in RUN.finditer(text):
        if run.end() - run.start() >= LEAST["hex"]:
            out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text, run.start(), run.end()) if m.end() - m.start() >= LEAST["hex"]]
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text, run.start(), run.end()) if m.end() - m.start() >= LEAST["access"]]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def _values(text: str, spans) -> list[str]:
    """The secrets themselves: an assignment's value, other spans whole."""
    out = []
    for start, end, kind in spans:
        m = ASSIGN.match(text, start) if kind == "assign" else None
        out.append(m.group(2) if m else text[start:end])
    return out


def _overlaps(start: int, end: int, spans) -> bool:
    return any(a < end and start < b for a, b, _ in spans)


class Markov:
    """Counts of transitions; start state is the last row."""

    def __init__(self, counts: np.ndarray | None = None):
        n = len(ALPHABET)
        self.counts = np.zeros((n + 1, n)) if counts is None else counts

    def learn(self, word: str, times: int = 1) -> None:
        before = len(ALPHABET)
        for c in word:
            k = _INDEX.get(c)
            if k is None:
                before = len(ALPHABET)
                continue
            self.counts[before, k] += times
            before = k

    def logs(self) -> np.ndarray:
        """Log probabilities: each row leans on the overall frequencies, those on the uniform distribution."""
        n = len(ALPHABET)
        overall = (self.counts.sum(0) + 1) / (self.counts.sum() + n)
        return np.log((self.counts + 8 * overall) / (self.counts.sum(1, keepdims=True) + 8))


def mean_ratio(table: np.ndarray, word: str) -> float:
    k = [_INDEX[c] for c in word]
    return float(table[[len(ALPHABET), *k[:-1]], k].sum() / len(k))


def train(random_strings: dict[str, int], identifiers: dict[str, int]) -> dict:
    """The table of log-likelihood ratios and the threshold.

    Uniformly random strings of the alphabet belong to the random class by
    definition; the prior of its model stands for them."""
    strange, plain = Markov(), Markov()
    for w, n in random_strings.items():
        strange.learn(w, n)
    strange.counts += strange.counts.sum() / strange.counts.size  # half of the mass: uniform strings
    for w, n in identifiers.items():
        plain.learn(w, n)
    table = strange.logs() - plain.logs()
    low = [mean_ratio(table, w) for w in identifiers if len(w) >= 12]
    high = [mean_ratio(table, w) for w in random_strings if len(w) >= 12 and all(c in _INDEX for c in w)]
    ceiling = float(np.quantile(low, 0.9999)) if low else 0.0
    floor = float(np.quantile(high, 0.05)) if high else math.inf
    # between the classes where they part, else just above the ordinary words
    threshold = max(0.0, ceiling + 0.5 * max(0.0, floor - ceiling) if math.isfinite(floor) else math.inf)
    return {"table": table, "threshold": threshold}


def markov_spans(text: str, spans, model: dict) -> list[tuple[int, int, str]]:
    out = []
    for m in RUN.finditer(text):
        if m.end() - m.start() >= SHORTEST and not _overlaps(m.start(), m.end(), spans) and mean_ratio(model["table"], m.group()) > model["threshold"]:
            out.append((m.start(), m.end(), "markov"))
    return out


def _samples(batches):
    """Labelled words of a batch with their counts."""
    for b in pieces(batches, 0):
        found: dict[tuple[int, str], int] = {}
        for text in b.column(0).to_pylist():
            spans = base_spans(text)
            for v in _values(text, spans):
                found[1, v] = found.get((1, v), 0) + 1
            for m in _WORD.finditer(text):
                if not _overlaps(m.start(), m.end(), spans):
                    key = (0, m.group())
                    found[key] = found.get(key, 0) + 1
        keys = sorted(found)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.string()), pa.array([found[k] for k in keys], pa.int64())], ["label", "word", "n"])


def fit(df: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> dict:
    """Models from the ``sample_docs`` different texts of smallest hash; the
    driver gets ``RANDOM_WORDS`` and ``PLAIN_WORDS`` counted words at most."""
    drawn = bounded_sample(df.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("text")), "text", sample_docs, 4)
    counted = cut(drawn.select("text").mapInArrow(_samples, "label int, word string, n bigint").groupBy("label", "word").agg(F.sum("n").alias("n")))
    take = lambda label, most: {r["word"]: r["n"] for r in counted.where(F.col("label") == label).orderBy(F.desc("n"), "word").limit(most).collect()}
    return train(take(1, RANDOM_WORDS), take(0, PLAIN_WORDS))


def _text_of(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, counts and digest of the pattern spans, ``spans`` (all of
    them as text) and ``secrets`` (the spans' own text)."""
    order = {k: n for n, k in enumerate((*KINDS, "markov"))}

    def run(batches):
        for b in pieces(batches, 1):
            out = []
            for text in b.column(1).to_pylist():
                base = base_spans(text)
                every = sorted(base + markov_spans(text, base, model), key=lambda s: (s[0], order[s[2]]))
                kinds = [k for _, _, k in base]
                out.append((*(kinds.count(k) for k in KINDS), hashlib.sha256(_text_of(base).encode()).hexdigest(), _text_of(every), [text[s:e] for s, e, _ in every]))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()))
            columns = zip(*out, strict=True) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], ["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "secrets"])

    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    done = rows.mapInArrow(run, "id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, secrets array<string>")
    return done.withColumnRenamed("id", id_col)


def scan_documents(documents: DataFrame) -> DataFrame:
    """Fit on a bounded sample, scan every whole text."""
    return scan(documents, fit(documents)).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")
