"""Benchmark decontamination.

Words are lower case (A-Z), with ASCII punctuation as white space; shingles are
five words.  Each benchmark item and every item-sized window of a document has a
64-bit SimHash of its shingle multiset.  Window sizes are the items' own,
rounded to the stride; strides grow with the size (1, 2 or 4 shingles), and
sums over strides are shared by all sizes, so windows cost little each.
Multi-index Hamming tables over four blocks of 16 bits name, for every window,
all items within ``RADIUS`` bits (one block then differs in at most a quarter of
them); the full distance is checked, and what remains is verified exactly: the
weighted Jaccard similarity (shingles weighted by their counts) of the item and
the best item-sized span there must reach ``SIMILARITY``.

A document shorter than the window has no window of its own, wherever it lies
in a batch.  It is one span, compared as a whole with every item that holds
enough of its shingles; a sorted list of the items' shingles names those.

Items go to the workers in blocks of bounded size; with more items the
documents are read once per block.  Documents are never shuffled.

Defined results: NULL or empty texts match nothing; items with fewer than five
words have no shingle and match nothing; equal items all match; every text of
an item_id that has several is searched for, NULL ids included, and a document
gets one row per item_id, with the best span of any of them; repeated rows get
equal results; an empty benchmark leaves all documents, and an empty table gives
no rows; very long texts are searched whole; other columns, of any name, are kept or ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, hot_join, pieces, stored, text_bytes
from .hashing import xxh64_slices

WIDTH = 5
SIMILARITY = 0.8
RADIUS = 18
BLOCKS = 4  # of 16 bits
BLOCK_ITEMS = 1024  # items sent to the workers at once
BLOCK_BYTES = 16 << 20
_WORK_BYTES = 1 << 19
_CLEAN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_CLEAN).split()


def shingle_hashes(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of several word lists, one after the other, and
    the number of shingles of each list."""
    counts = np.array([len(w) for w in words], np.int64)
    flat = b" ".join(b" ".join(w) for w in words if w)
    shingles = np.maximum(counts - WIDTH + 1, 0)
    if not shingles.sum():
        return np.zeros(0, np.uint64), shingles
    gaps = np.flatnonzero(np.frombuffer(flat, np.uint8) == 32)
    starts, ends = np.append(0, gaps + 1), np.append(gaps, len(flat))
    own = xxh64_slices(flat, starts, ends - starts, 42)
    first = np.cumsum(counts) - counts
    word = np.arange(shingles.sum()) + np.repeat(first - (np.cumsum(shingles) - shingles), shingles)
    with np.errstate(over="ignore"):
        h = np.zeros(len(word), np.uint64)
        for k in range(WIDTH):
            x = own[word + k] * _ODD[k]
            h += x ^ (x >> np.uint64(29))
        h = (h ^ (h >> np.uint64(32))) * _ODD[0]
        h = (h ^ (h >> np.uint64(29))) * _ODD[1]
    return h ^ (h >> np.uint64(32)), shingles


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def simhash(hashes: np.ndarray) -> np.uint64:
    return np.packbits(2 * _bits(hashes).sum(0, dtype=np.int64) > len(hashes), bitorder="little").view("<u8")[0]


def stride_of(size: int) -> int:
    return 1 if size < 8 else 2 if size < 24 else 4


class Items:
    """Benchmark items with their tables, grouped by rounded window size."""

    def __init__(self, texts: dict[int, bytes], radius: int = RADIUS):
        self.radius = radius
        self.shingles: dict[int, np.ndarray] = {}
        words = [(k, words_of(t)) for k, t in sorted(texts.items())]
        hashes, sizes = shingle_hashes([w for _, w in words])
        for (k, _), own in zip(words, np.split(hashes, np.cumsum(sizes)[:-1]) if words else [], strict=True):
            if len(own):
                self.shingles[k] = own
        by_size: dict[int, list[int]] = {}
        for k, own in self.shingles.items():
            s = stride_of(len(own))
            by_size.setdefault(max(s, round(len(own) / s) * s), []).append(k)
        self.groups = []
        for size, keys in sorted(by_size.items()):
            for lo in range(0, len(keys), 64):  # one bit of a mask word each
                part = keys[lo : lo + 64]
                prints = np.array([simhash(self.shingles[k]) for k in part], np.uint64)
                self.groups.append((size, part, prints, self._tables(prints)))
        self.counts = {k: Counter(own.tolist()) for k, own in self.shingles.items()}
        # up to so many shingles a document is compared as a whole: it has no more than the item, or than its window
        self.whole = {k: max(len(self.shingles[k]), size - 1) for size, part, *_ in self.groups for k in part}
        distinct = [(k, np.unique(own)) for k, own in self.shingles.items()]
        held = np.concatenate([own for _, own in distinct]) if distinct else np.zeros(0, np.uint64)
        order = np.argsort(held, kind="stable")
        self.held, self.holder = held[order], np.repeat([k for k, _ in distinct], [len(own) for _, own in distinct])[order]

    def _tables(self, prints: np.ndarray) -> np.ndarray:
        """For each block and each of its values, the mask of items near it."""
        values = np.arange(1 << 16, dtype=np.uint16)
        out = np.zeros((BLOCKS, 1 << 16), np.uint64)
        for b in range(BLOCKS):
            for n, fp in enumerate(prints.tolist()):
                near = np.bitwise_count(values ^ np.uint16(fp >> (16 * b) & 0xFFFF)) <= self.radius // BLOCKS
                out[b] |= near.astype(np.uint64) << np.uint64(n)
        return out

    def candidates(self, prints: np.ndarray, group) -> tuple[np.ndarray, np.ndarray]:
        """(window, item of the group) within the radius."""
        _, part, own, tables = group
        blocks = prints.view("<u2").reshape(-1, BLOCKS)
        mask = tables[0][blocks[:, 0]]
        for b in range(1, BLOCKS):
            mask |= tables[b][blocks[:, b]]
        at, which = [], []
        for n in range(len(part)):
            some = np.flatnonzero((mask & np.uint64(1 << n)) != 0)
            some = some[np.bitwise_count(prints[some] ^ own[n]) <= self.radius]
            at.append(some)
            which.append(np.full(len(some), n))
        return np.concatenate(at), np.concatenate(which)

    def search(self, texts: list[bytes], similarity: float = SIMILARITY) -> list[dict[int, tuple[float, int, int]]]:
        """For each text, item -> (similarity, first word, words) of its best span."""
        found: list[dict] = [{} for _ in texts]
        hashes, sizes = shingle_hashes([words_of(t) for t in texts])
        if not len(hashes) or not self.groups:
            return found
        ends = np.cumsum(sizes)
        self._compare_short(hashes, sizes, ends, similarity, found)
        longest = self.groups[-1][0]
        small = np.uint8 if longest < 256 else np.uint16 if longest < 65536 else np.uint32
        bits = _bits(np.concatenate([hashes, np.zeros(-len(hashes) % 4, np.uint64)]))
        sums: dict[int, np.ndarray] = {}
        for group in self.groups:
            size, part = group[0], group[1]
            s = stride_of(size)
            if s not in sums:  # running sums that wrap around; differences of up to `longest` stay exact
                per = bits if s == 1 else bits.reshape(-1, s, 64).sum(1, dtype=small)
                sums[s] = np.concatenate([np.zeros((1, 64), small), np.cumsum(per, axis=0, dtype=small)])
            run, m = sums[s], size // s
            if len(run) - 1 < m:  # only documents shorter than the window
                continue
            windows = run[m:] - run[:-m]
            prints = np.packbits(windows > size // 2, axis=1, bitorder="little").view("<u8")[:, 0]
            at, which = self.candidates(prints, group)
            self._verify(at * s, which, part, size, s, hashes, ends, similarity, found)
        return found

    def _compare_short(self, hashes, sizes, ends, similarity, found) -> None:
        """Documents that are one span: those with at most ``whole`` shingles of an item."""
        short = np.flatnonzero((sizes > 0) & (sizes <= max(self.whole.values())))
        if not len(short):
            return
        doc = np.repeat(np.arange(len(short)), sizes[short])
        own = hashes[np.repeat(ends[short] - np.cumsum(sizes[short]), sizes[short]) + np.arange(len(doc))]
        first, last = np.searchsorted(self.held, own, "left"), np.searchsorted(self.held, own, "right")
        enough = np.bincount(doc, last > first) >= similarity * (sizes[short] - 1)  # `whole` is at most one above the item's length
        start = np.cumsum(sizes[short]) - sizes[short]
        for n in np.flatnonzero(enough).tolist():
            here = slice(int(start[n]), int(start[n] + sizes[short[n]]))
            keys, met = np.unique(np.concatenate([self.holder[a:e] for a, e in zip(first[here].tolist(), last[here].tolist(), strict=True)]), return_counts=True)
            region = own[here].tolist()
            for key, m in zip(keys.tolist(), met.tolist(), strict=True):
                length = len(self.shingles[key])
                if len(region) <= self.whole[key] and m >= similarity * length:
                    best = self._best(region, self.counts[key], length)
                    if best[0] >= similarity:
                        found[short[n]][key] = (best[0], best[1], best[2] + WIDTH - 1)

    def _verify(self, starts, which, part, size, s, hashes, ends, similarity, found) -> None:
        for n in np.unique(which).tolist():
            key = part[n]
            own, counts = self.shingles[key], self.counts[key]
            begin = starts[which == n]
            length = len(own)
            reach = 2 * s + length // 4 + 1  # of the span around its window, from misalignment and changed words
            # enough of the item's shingles must lie in reach, for any span there to be similar enough
            span = np.arange(-reach, size + reach)
            near = np.zeros(len(begin), np.int64)
            member = np.sort(own)
            for lo in range(0, len(begin), 4096):
                at = np.clip(begin[lo : lo + 4096, None] + span, 0, len(hashes) - 1)
                h = hashes[at]
                k = np.minimum(np.searchsorted(member, h), length - 1)
                near[lo : lo + 4096] = (member[k] == h).sum(1)
            for a in begin[near >= similarity * len(counts)].tolist():
                # the documents that the window touches
                for doc in range(int(np.searchsorted(ends, max(0, a), "right")), int(np.searchsorted(ends, min(len(hashes) - 1, a + size - 1), "right")) + 1):
                    first = 0 if doc == 0 else int(ends[doc - 1])
                    last = int(ends[doc])
                    if last - first <= self.whole[key]:  # compared as a whole
                        continue
                    lo, hi = max(first, a - reach), min(last, a + size + reach)
                    lo, hi = max(first, min(lo, hi - length)), min(last, max(hi, lo + length))  # no span is shorter than the item
                    best = self._best(hashes[lo:hi].tolist(), counts, length)
                    if best and best[0] >= similarity and best[0] > found[doc].get(key, (0.0,))[0]:
                        found[doc][key] = (best[0], lo + best[1] - first, best[2] + WIDTH - 1)

    @staticmethod
    def _best(region: list[int], counts: Counter, length: int) -> tuple[float, int, int] | None:
        """The span of at most the item's length with the greatest weighted Jaccard similarity."""
        n = min(length, len(region))
        if not n:
            return None
        here = Counter(region[:n])
        common = sum(min(c, here[h]) for h, c in counts.items())
        best = (common / (length + n - common), 0, n)
        for a in range(1, len(region) - n + 1):
            out, new = region[a - 1], region[a + n - 1]
            if out != new:
                common -= here[out] <= counts.get(out, 0)
                here[out] -= 1
                here[new] += 1
                common += here[new] <= counts.get(new, 0)
            if (value := common / (length + n - common)) > best[0]:
                best = (value, a, n)
        return best


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[list[tuple[int | None, bytes]]]:
    """The items as (id, text) in blocks of bounded number and size.  A benchmark is a stated
    query set; the driver reads it once and holds one block at a time."""
    now, size = [], 0
    rows = benchmark.select(F.col(id_col).cast("bigint").alias("id"), text_bytes(text_col).alias("text")).orderBy(F.col("id").asc_nulls_last(), "text")
    for r in rows.toLocalIterator():
        item = (r["id"], bytes(r["text"]))
        if now and now[-1] == item:  # a repeated row
            continue
        if now and (len(now) >= BLOCK_ITEMS or size + len(item[1]) > BLOCK_BYTES):
            yield now
            now, size = [], 0
        now.append(item)
        size += len(item[1])
    if now:
        yield now


_SHAPE = "doc_id bigint, item_id bigint, similarity double, start_word bigint, n_words bigint"
_TEXT_SHAPE = _SHAPE.replace("doc_id bigint", "h1 bigint, h2 bigint")


def _text_key(text) -> list:
    """128 bits that name a text: what is found in it depends on nothing else."""
    return [F.xxhash64(F.lit(seed), text).alias(name) for seed, name in ((6, "h1"), (60, "h2"))]


def leaks(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """One row per document and item found in it: ``doc_id, item_id,
    similarity, start_word, n_words``."""
    rows = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), text_bytes(text_col).alias("text"))
    one, several = _single_block(documents, benchmark)
    if one is not None:
        return rows.mapInArrow(_find(one, radius, similarity, 1), _SHAPE)
    if several is None:
        return rows.limit(0).selectExpr("doc_id", "0L item_id", "0D similarity", "0L start_word", "0L n_words")
    best = F.row_number().over(Window.partitionBy("h1", "h2", "item_id").orderBy(F.desc("similarity"), "start_word", "n_words"))
    found = _by_block(rows, several, radius, similarity).withColumn("_rank", best).where("_rank = 1").drop("_rank")
    return hot_join(rows.select("doc_id", *_text_key(F.col("text"))), found, ["h1", "h2"]).select("doc_id", "item_id", "similarity", "start_word", "n_words")


def _single_block(documents: DataFrame, benchmark: DataFrame):
    """The broadcast of the only block, or all blocks one after the other; (None, None) without items."""
    blocks = item_blocks(benchmark)
    first, second = next(blocks, None), next(blocks, None)
    if first is None:
        return None, None
    if second is None:
        return documents.sparkSession.sparkContext.broadcast(first), None  # BLOCK_ITEMS items of BLOCK_BYTES at most
    return None, chain([first, second], blocks)


def _by_block(rows: DataFrame, blocks, radius: int, similarity: float) -> DataFrame:
    """What the texts of ``rows`` hold of a benchmark of many blocks: one job per
    block, whose hits are written before the next block is read, so that driver,
    executors and workers hold the items and tables of one block at a time."""
    spark, found = rows.sparkSession, []
    keyed = rows.select(*_text_key(F.col("text")), "text")
    for block in blocks:
        shared = spark.sparkContext.broadcast(block)
        found.append(stored(keyed.mapInArrow(_find(shared, radius, similarity, 2), _TEXT_SHAPE).distinct()))
        shared.unpersist()
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _hits(shared, radius: int, similarity: float, columns: int, batches):
    """(batch, for each row its hits by item id); the text is behind ``columns`` others."""
    items = ids = None
    for b in pieces(batches, columns):
        if items is None:
            ids = [i for i, _ in shared.value]
            items = Items({k: t for k, (_, t) in enumerate(shared.value)}, radius)
        texts = b.column(columns).to_pylist()
        yield b, [_best_of((ids[k], *hit) for k, hit in f.items()) for lo, hi in chunks(texts, len, _WORK_BYTES) for f in items.search(texts[lo:hi], similarity)]


def _best_of(hits) -> dict:
    """Of hits (item id, similarity, start, words) the best of each id, the first of equal ones."""
    out: dict = {}
    for item, *hit in hits:
        if item not in out or (-hit[0], *hit[1:]) < (-out[item][0], *out[item][1:]):
            out[item] = tuple(hit)
    return out


def _find(shared, radius: int, similarity: float, columns: int):
    """mapInArrow function: the first ``columns`` columns of a row with each item found, in order of the items (NULL last)."""

    def run(batches):
        for b, found in _hits(shared, radius, similarity, columns, batches):
            which = [(k, (i, *hits[i])) for k, hits in enumerate(found) for i in sorted(hits, key=lambda i: (i is None, i or 0))]
            if which:
                types = (pa.int64(), pa.float64(), pa.int64(), pa.int64())
                own = [c.take(pa.array([k for k, _ in which])) for c in b.columns[:columns]]
                hits = [pa.array(c, t) for c, t in zip(zip(*(h for _, h in which), strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([*own, *hits], [*b.schema.names[:columns], "item_id", "similarity", "start_word", "n_words"])

    return run


def _drop(shared, radius: int, similarity: float, columns: int):
    def run(batches):
        for b, found in _hits(shared, radius, similarity, columns, batches):
            yield b.filter(pa.array([not f for f in found], pa.bool_()))

    return run


def decontaminate(documents: DataFrame, benchmark: DataFrame, text_col: str = "text", similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """The documents (all columns) in which no item is found."""
    names = documents.columns
    rows = documents.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)], text_bytes(F.col(f"`{text_col}`")).alias("_text"))
    one, several = _single_block(documents, benchmark)
    if one is not None:
        rows = rows.mapInArrow(_drop(one, radius, similarity, len(names)), T.StructType(rows.schema.fields))
    elif several is not None:
        found = _by_block(rows.select(F.col("_text").alias("text")), several, radius, similarity).select("h1", "h2").distinct()
        keyed = rows.withColumns(dict(zip(("h1", "h2"), _text_key(F.col("_text")), strict=True)))
        rows = hot_join(keyed, found, ["h1", "h2"], "left_anti")
    return rows.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(names)])
