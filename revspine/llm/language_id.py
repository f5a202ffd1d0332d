"""Language identification with string kernels.

A text is the set of its n-grams of one to three UTF-8 bytes (lower case): the
presence form of the blended spectrum.  The kernel of two texts counts the
n-grams they share, over those that occur in the landmarks, divided by the
square root of the product of their own counts.  Landmarks, a bounded sample of
labelled texts, give Nystroem features; one-versus-rest kernel ridge regression
is solved on them, and texts are scored by batched matrix products (presence
matrix times landmarks, times coefficients).  Both products are sums of whole
numbers that floats hold exactly (coefficients are rounded to a binary grid for
that), so a score does not depend on the batch a text is in; it is rounded to ``DIGITS`` digits.

The model is fitted on the ``PER_LANGUAGE`` different texts of each language
with the smallest hash (``SAMPLE_TEXTS`` in all; the ``LANGUAGES`` most frequent
languages), whatever their ids; of a longer text a stretch of ``SAMPLE_CHARS``
characters teaches.  Everything is scored from its whole text.

Defined results: a NULL text and one without a letter (Unicode category L) are
``und`` with score 0; with no labelled row at all every text is ``und``; rows
with NULL lang are scored but not learned from; rows with a NULL id are in no
fold, so they are learned from; repeated rows get equal results; of equal scores
the language that comes first by name is taken; columns of any names are kept, also those named like the results; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, chunks, in_fold, pieces

PER_LANGUAGE = 300  # bound of a language's training texts, and ...
SAMPLE_TEXTS = 2400  # ... of all of them
LANGUAGES = 600  # bound of the languages that are learned
SAMPLE_CHARS = 20_000  # of a training text
LANDMARKS = 32  # per language
SHORT_WORDS = 6  # every training text also teaches a span of so many words
RIDGE = 1e-2
SHARPNESS = 4.0  # of the scores' softmax
ORDERS = (1, 2, 3)
DIGITS = 9  # of a score
_LETTER = regex.compile(r"\p{L}")
_WORK_BYTES = 1 << 20


def _bytes(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def _codes(data: np.ndarray, n: int) -> np.ndarray:
    """Each n-gram of bytes as one number; n-grams of different n never meet."""
    out = np.zeros(max(0, len(data) - n + 1), np.uint32)
    for k in range(n):
        out = (out << np.uint32(8)) | data[k : len(data) - n + 1 + k]
    return out


class Spectrum:
    """Presence vectors over the n-grams of the landmarks."""

    def __init__(self, vocabulary: dict[int, np.ndarray]):
        self.vocabulary = vocabulary
        self.size = sum(map(len, vocabulary.values()))
        self.tables, at = {}, 0
        for n, codes in vocabulary.items():
            table = np.full(256**n, -1, np.int16 if self.size < 32768 else np.int32)
            table[codes] = np.arange(at, at + len(codes))
            self.tables[n] = table
            at += len(codes)

    @classmethod
    def of(cls, texts: list[str]) -> "Spectrum":
        arrays = [np.frombuffer(_bytes(t), np.uint8) for t in texts]
        return cls({n: np.unique(np.concatenate([_codes(a, n) for a in arrays] or [np.zeros(0, np.uint32)])) for n in ORDERS})

    def presence(self, texts: list[str]) -> np.ndarray:
        """Rows of zeros and ones, divided by the square root of their sum."""
        out = self.bits(texts)
        return out / np.sqrt(np.maximum(out.sum(1, keepdims=True), 1))

    def bits(self, texts: list[str]) -> np.ndarray:
        """Rows of zeros and ones: which n-grams of the vocabulary a text has."""
        coded = [_bytes(t) for t in texts]
        data = np.frombuffer(b"\0\0".join(coded), np.uint8)  # no n-gram of a landmark holds two NULs of a seam
        lengths = np.array([len(c) for c in coded])
        owner = np.repeat(np.arange(len(texts), dtype=np.int64) * self.size, lengths + np.append(np.full(len(texts) - 1, 2), 0))
        out = np.zeros(len(texts) * self.size, np.float32)
        for n, table in self.tables.items():
            at = table[_codes(data, n)]
            hit = np.flatnonzero(at >= 0)
            out[owner[hit] + at[hit]] = 1
        return out.reshape(len(texts), self.size)


def _short(text: str) -> str:
    words = text.split()
    at = len(words) // 3
    return " ".join(words[at : at + SHORT_WORDS])


def train(sample: list[tuple[str, str]]) -> dict:
    """Fit on (text, language) pairs, ordered; a plain dict of arrays."""
    languages = sorted({lang for _, lang in sample})
    marks: list[str] = []
    for lang in languages:
        marks += [t for t, x in sample if x == lang][:LANDMARKS]
    spectrum = Spectrum.of(marks)
    z = spectrum.presence(marks)
    texts = [t for t, _ in sample] + [_short(t) for t, _ in sample]
    labels = [lang for _, lang in sample] * 2
    k = np.concatenate([spectrum.presence(texts[lo : lo + 256]) @ z.T for lo in range(0, len(texts), 256)]).astype(np.float64)
    values, vectors = np.linalg.eigh((z @ z.T).astype(np.float64))
    root = vectors / np.sqrt(np.maximum(values, 1e-6 * values.max()))  # Nystroem: features k @ root
    features = np.hstack([k @ root, np.ones((len(k), 1))])
    targets = np.where(np.array(labels)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    weight = 1 / np.array([labels.count(lang) for lang in labels])[:, None]  # languages count alike
    penalty = RIDGE * np.eye(features.shape[1]) * len(languages) / features.shape[1]
    penalty[-1, -1] = 0
    w = np.linalg.solve(features.T @ (features * weight) + penalty, features.T @ (targets * weight))
    bits = spectrum.bits(marks)
    shared = bits.sum(1)[:, None].astype(np.float64)  # most n-grams that a text can share with each landmark
    coefficients = (root @ w[:-1]) / np.sqrt(np.maximum(shared, 1))
    # on a grid so fine that no sum over landmarks needs more than the 53 bits of a float
    grid = 2.0 ** (51 - np.ceil(np.log2(max(1.0, float((shared * np.abs(coefficients)).sum(0).max())))))
    return {"languages": languages, "vocabulary": spectrum.vocabulary, "landmarks": bits, "coefficients": np.rint(coefficients * grid), "grid": grid, "bias": w[-1]}


def predict(model: dict, spectrum: Spectrum, texts: list[str | None]) -> tuple[list[str], list[float]]:
    lang, score = ["und"] * len(texts), [0.0] * len(texts)
    known = [k for k, t in enumerate(texts) if t and _LETTER.search(t)]
    own = [texts[k] for k in known]
    for lo, hi in chunks(own, lambda t: len(t) + 4096, _WORK_BYTES):
        bits = spectrum.bits(own[lo:hi])
        common = (bits @ model["landmarks"].T).astype(np.float64)
        s = (common @ model["coefficients"]) / model["grid"] / np.sqrt(np.maximum(bits.sum(1, keepdims=True), 1)) + model["bias"]
        p = np.exp(SHARPNESS * (s - s.max(1, keepdims=True)))
        p = np.round(p / p.sum(1, keepdims=True), DIGITS)
        for k, row in zip(known[lo:hi], p, strict=True):
            best = int(row.argmax())
            lang[k], score[k] = model["languages"][best], float(min(row[best], 1.0))
    return lang, score


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> dict | None:
    """A model from labelled rows of ``df``; None when there are none.  The
    driver gets ``per_language`` texts of each language at most."""
    usable = F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")
    rows = df.where(usable).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    known = [r["lang"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()]
    if not known:
        return None
    per_language = max(4, min(per_language, SAMPLE_TEXTS // len(known)))
    drawn = bounded_sample(rows.where(F.col("lang").isin(known)), "text", per_language, 5, ("lang",))
    room = F.length("text") - SAMPLE_CHARS
    stretch = F.when(room > 0, F.substring("text", F.pmod("_h", room).cast("int") + 1, F.lit(SAMPLE_CHARS))).otherwise(F.col("text"))
    return train([(r["text"], r["lang"]) for r in drawn.select("lang", "_h", stretch.alias("text")).orderBy("lang", "_h").collect()])


def _scored(df: DataFrame, model: dict | None, text_col: str) -> DataFrame:
    """The columns of ``df`` as c0, c1, ... with ``_lang`` and ``_score``."""
    names = df.columns
    rows = df.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)], F.col(f"`{text_col}`").cast("string").alias("_text"))
    scored = rows.drop("_text").withColumns({"_lang": F.lit("und"), "_score": F.lit(0.0)})
    if model is None:
        return scored
    shared = df.sparkSession.sparkContext.broadcast(model)  # landmarks x vocabulary: bounded by the sample

    def run(batches):
        model = shared.value
        spectrum = Spectrum(model["vocabulary"])
        for b in pieces(batches, len(names)):
            lang, score = predict(model, spectrum, b.column(len(names)).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(lang, pa.string()), pa.array(score, pa.float64())], [*b.schema.names[: len(names)], "_lang", "_score"])

    return rows.mapInArrow(run, scored.schema)


def identify(df: DataFrame, model: dict | None, text_col: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``df`` with the language and its score behind its columns."""
    return _scored(df, model, text_col).select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(df.columns)], F.col("_lang").alias(lang), F.col("_score").alias(score))


def confident(df: DataFrame, model: dict | None, least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose language has a score of ``least`` or more."""
    return _scored(df, model, text_col).where(F.col("_score") >= least).select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(df.columns)])


def classify(documents: DataFrame) -> DataFrame:
    """Fit on the documents outside the held-out fold, predict all of them."""
    held = in_fold(F.col("doc_id"), 4, 2)
    model = fit(documents.where(~held))
    done = identify(documents.select("doc_id", "text"), model)
    return done.select("doc_id", held.alias("held_out"), "lang_pred", "score")
