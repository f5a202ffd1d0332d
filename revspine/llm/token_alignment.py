"""Alignment of two tokenizers by merge-path partitioning.

Both tokenizers cut the same bytes, so a text gives two ascending lists of end
offsets, A's and B's.  Merging them walks through all pairs of tokens that
overlap: each step emits the two open tokens and closes the one that ends
first; where both end together a group ends.

1. *Partition*: the merge of a batch of texts (their offsets continue each
   other) is cut by equally spaced diagonals.  A binary search on each diagonal
   finds where the merge crosses it, so the pieces between diagonals have equal
   work and need nothing of each other, whatever the lengths of texts and tokens.
2. *Pieces* run side by side, one step of all of them at a time, and emit their
   overlaps and the common ends they pass.
3. *Stitch*: a running count of the common ends over all pieces numbers the
   groups; a group that spans pieces gets one number.

Texts are encoded once; their ids are kept in the shared checkpoint folder for
the two passes over them, counts and documents.
Corpus-wide counts of id pairs are summed in every task and combined before the
shuffle.  The ``FREQUENT`` most frequent pairs are shared with all tasks, a
bound that does not grow with the corpus, and cover nearly all links; links of
other pairs leave the document pass as (document, pair) rows and are joined
with the whole table of counts, so every link gets its exact count.  The best
count of each B id is a table of the size of B's vocabulary.

Defined results: NULL and empty texts have no tokens, nor have texts that one
of the tokenizers does not give back byte by byte (such as those that hold
U+2581); special tokens' strings are plain text; repeated rows and rows with a NULL id
are aligned and counted each; ties for the best count all count; very long texts are whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import chunks, cut, hot_join, pieces, release, stored
from .packing import _BYTE_SYMBOLS, _UNCOMMON, PATTERN

WORK = 256  # steps of a piece
LANES = 4096  # pieces that run side by side
FREQUENT = 1 << 18  # pairs that all tasks share
COUNTED_PAIRS = 1 << 20  # distinct pairs a task counts before it hands them on
_WORK_CHARS = 1 << 19
_LONG_RUN = re.compile(r"\s{2000}|\S{20000}")
_SYMBOL_BYTES = {v: k for k, v in _BYTE_SYMBOLS.items()}
_SIDES: dict[tuple[str, str], "Sides"] = {}
_NONE = 1 << 62  # beyond every offset


class Sides:
    """Ids of both tokenizers: A, a byte-level BPE file, for ' ' + text, and B, a
    sentencepiece model, which puts the space there itself.

    Where A's ids are in the order of its merges, as in such files, its tokens
    are their own ranks and ``tiktoken`` gives the same ids in less time.  Texts of other
    characters, whose classes differ between Unicode versions, and texts with a
    very long run go to the file's own library."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tiktoken import Encoding

        self.library = Tokenizer.from_file(a_path)
        self.library.encode_special_tokens = True
        with open(a_path, encoding="utf-8") as f:
            merges = json.load(f)["model"]["merges"]
        ids = {t: i for t, i in self.library.get_vocab().items() if t not in {x.content for x in self.library.get_added_tokens_decoder().values()}}
        if not all(chr(c) in ids for c in _BYTE_SYMBOLS.values()):
            raise ValueError("not every byte has a token")  # else every text is given back as it is
        self.sizes_a = np.zeros(max(ids.values()) + 1, np.int64)
        self.sizes_a[list(ids.values())] = [len(t) for t in ids]  # a symbol a byte
        joined = ("".join(m if isinstance(m, list) else m.split(" ")) for m in merges)
        ranked = len(ids) == 256 + len(merges) and all(ids.get(t) == 256 + k for k, t in enumerate(joined))
        ranks = {bytes(_SYMBOL_BYTES[ord(c)] for c in t): i for t, i in ids.items()}
        self.fast = Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if ranked else None
        self.model = SentencePieceProcessor(model_file=b_path)
        own = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(own)]
        self.sizes_b = np.array([len(b) for b in self.bytes_b], np.int64)
        self.width = np.dtype("<u2" if max(len(self.sizes_a), len(own)) <= 1 << 16 else "<u4")

    def _ids_a(self, text: str) -> list[int]:
        if self.fast is None or _UNCOMMON.search(text) or _LONG_RUN.search(text):
            return self.library.encode(" " + text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(" " + text)

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """Of each text the ids of A and B, as arrays of ``width``; none where it
        is empty or not given back byte by byte."""
        out_a, out_b = [b""] * len(texts), [b""] * len(texts)
        full = [k for k, t in enumerate(texts) if t]
        for k, ids in zip(full, self.model.encode([texts[k] for k in full], num_threads=1), strict=True):
            if b"".join([self.bytes_b[i] for i in ids]) == (" " + texts[k]).encode():
                out_a[k], out_b[k] = (np.array(x, self.width).tobytes() for x in (self._ids_a(texts[k]), ids))
        return out_a, out_b


def sides(a_path: str, b_path: str) -> Sides:
    """One per worker process and pair of files."""
    if (a_path, b_path) not in _SIDES:
        _SIDES[a_path, b_path] = Sides(a_path, b_path)
    return _SIDES[a_path, b_path]


def crossings(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of A's ends come before each diagonal of the merge of two
    ascending arrays (of equal ends A's comes first): a binary search on each."""
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        before = open_ & (a[np.minimum(mid, len(a) - 1)] <= b[np.clip(diagonals - 1 - mid, 0, len(b) - 1)])
        low = np.where(before, mid + 1, low)
        high = np.where(open_ & ~before, mid, high)
    return low


def align(a: np.ndarray, b: np.ndarray, work: int = WORK, lanes: int = LANES):
    """Of two ascending arrays of end offsets with equal last ends: the pairs of
    overlapping tokens in order, as two arrays of places, and a mask of A's and
    one of B's tokens that end where the other side ends too."""
    a_common, b_common = np.zeros(len(a), bool), np.zeros(len(b), bool)
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), a_common, b_common
    starts = np.arange(0, len(a) + len(b), work)
    first_a = crossings(a, b, starts)
    first_b = starts - first_a
    a_end, b_end, a_before = np.append(a, _NONE + 1), np.append(b, _NONE), np.append(-1, a)
    out_a, out_b = [], []
    for lo in range(0, len(starts), lanes):
        i, j = first_a[lo : lo + lanes].copy(), first_b[lo : lo + lanes].copy()
        at_a, at_b = np.empty((2, work, len(i)), np.int64)
        kind = np.empty((work, len(i)), np.int8)
        for step in range(work):
            end = b_end[j]
            common = a_before[i] == end  # B's token ends where A's token before ended
            at_a[step], at_b[step] = i, j
            kind[step] = np.where(common, 2, j < len(b))
            a_first = a_end[i] <= end
            i = i + a_first
            j = np.minimum(j + ~a_first, len(b))
        link, closed = (kind == 1).T, kind == 2
        out_a.append(at_a.T[link])
        out_b.append(at_b.T[link])
        a_common[at_a[closed] - 1] = True
        b_common[at_b[closed]] = True
    return np.concatenate(out_a), np.concatenate(out_b), a_common, b_common


def _decimals(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The digits of 0 to size - 1 from the left, with room for a separator, and their lengths."""
    text = [b"%d" % i for i in range(size)]
    width = len(text[-1]) + 1
    return np.frombuffer(b"".join(t.ljust(width) for t in text), np.uint8).reshape(size, width), np.array([len(t) for t in text])


class Aligned:
    """A batch of texts: ids, ends, links and groups of all of them."""

    def __init__(self, ids_a: list[bytes], ids_b: list[bytes], own: Sides):
        self.n_a, self.n_b = (np.array([len(x) // own.width.itemsize for x in side], np.int64) for side in (ids_a, ids_b))
        self.a, self.b = (np.frombuffer(b"".join(side), own.width).astype(np.int64) for side in (ids_a, ids_b))
        self.at_a, self.at_b, self.a_last, self.b_last = align(np.cumsum(own.sizes_a[self.a]), np.cumsum(own.sizes_b[self.b]))
        self.pairs = self.a[self.at_a] << 32 | self.b[self.at_b]
        docs = len(ids_a)
        owner_a = np.repeat(np.arange(docs), self.n_a)
        self.owner = owner_a[self.at_a]  # of each link
        self.n_links = np.bincount(self.owner, minlength=docs)
        self.n_groups = np.bincount(owner_a[self.a_last], minlength=docs)

    def group_texts(self, decimals) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        digits, sizes = decimals
        group_a, group_b = (np.cumsum(last) - last for last in (self.a_last, self.b_last))  # stitched: one count over all pieces
        groups = int(self.a_last.sum())
        ahead_b = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=groups))])
        through_a = np.cumsum(np.bincount(group_a, minlength=groups))
        place_a, place_b = np.arange(len(self.a)) + ahead_b[group_a], np.arange(len(self.b)) + (through_a[group_b] if groups else 0)
        ids, mark = np.empty(len(self.a) + len(self.b), np.int64), np.empty(len(self.a) + len(self.b), np.uint8)
        ids[place_a], ids[place_b] = self.a, self.b
        mark[place_a] = np.where(self.a_last, ord("|"), ord(","))
        mark[place_b] = np.where(self.b_last, ord(";"), ord(","))
        text, size = digits[ids], sizes[ids]
        text[np.arange(len(ids)), size] = mark
        text = text[np.arange(text.shape[1]) <= size[:, None]].tobytes()
        ends = np.append(0, np.cumsum(size + 1))[np.append(0, np.cumsum(self.n_a + self.n_b))].tolist()
        return [text[lo : max(lo, hi - 1)] for lo, hi in zip(ends, ends[1:])]


def tokens(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (a number of its own for each row), ``doc_id``, ``a`` and ``b``: the ids of both sides."""

    def run(batches):
        own, row = sides(a_path, b_path), TaskContext.get().partitionId() << 33
        for batch in pieces(batches, 1):
            texts = batch.column(1).to_pylist()
            for lo, hi in chunks(texts, lambda t: len(t or "") + 64, _WORK_CHARS):
                a, b = own.encode([t or "" for t in texts[lo:hi]])
                yield pa.RecordBatch.from_arrays([pa.array(row + np.arange(hi - lo)), batch.column(0).slice(lo, hi - lo), pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["row", "doc_id", "a", "b"])
                row += hi - lo

    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, "row bigint, doc_id bigint, a binary, b binary")


def _aligned(batch, a_path: str, b_path: str):
    """Ranges of a batch of tokens, aligned."""
    own = sides(a_path, b_path)
    a, b = (batch.column(name).to_pylist() for name in ("a", "b"))
    for lo, hi in chunks(a, lambda x: len(x) + 64, _WORK_CHARS):
        yield lo, hi, Aligned(a[lo:hi], b[lo:hi], own)


def pair_counts(encoded: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``pair`` (A's id times 2^32 plus B's) and ``n``, its links in all rows of :func:`tokens`."""

    def run(batches):
        held: list[tuple] = []
        size = 0

        def combine():
            codes, which = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
            n = np.zeros(len(codes), np.int64)
            np.add.at(n, which, np.concatenate([n for _, n in held]))
            return codes, n

        def batch(codes, n):
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], ["pair", "n"])

        for b in batches:
            for _, _, found in _aligned(b, a_path, b_path):
                held.append(np.unique(found.pairs, return_counts=True))
                size += len(held[-1][0])
                if size > 2 * COUNTED_PAIRS:
                    held[:] = [combine()]
                    size = len(held[0][0])
                    if size > COUNTED_PAIRS:
                        yield batch(*held.pop())
                        size = 0
        if held:
            yield batch(*combine())
        release()

    return encoded.select("a", "b").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def _documents(a_path: str, b_path: str, shared):
    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "rare"]

    def sums(values, counts):
        ends = np.append(0, np.cumsum(values))
        edges = np.append(0, np.cumsum(counts))
        return ends[edges[1:]] - ends[edges[:-1]]

    def run(batches):
        codes, counts, best = shared.value
        own = sides(a_path, b_path)
        decimals = _decimals(max(len(own.sizes_a), len(own.sizes_b)))
        for batch in batches:
            for lo, hi, found in _aligned(batch, a_path, b_path):
                pairs, which = np.unique(found.pairs, return_inverse=True)
                at = np.minimum(np.searchsorted(codes, pairs), max(len(codes) - 1, 0))
                known = codes[at] == pairs if len(codes) else np.zeros(len(pairs), bool)
                n = np.where(known, counts[at], 0) if len(codes) else np.zeros(len(pairs), np.int64)
                is_best = known & (n == best[pairs & 0xFFFFFFFF])
                rare = ~known[which]
                owner, code = found.owner[rare], which[rare]
                each, m = np.unique(owner * (len(pairs) + 1) + code, return_counts=True)
                owner, code = each // (len(pairs) + 1), each % (len(pairs) + 1)
                offsets = np.append(0, np.cumsum(np.bincount(owner, minlength=hi - lo)))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(pairs[code]), pa.array(m.astype(np.int64))], ["pair", "m"]))
                digests = [hashlib.sha256(t).hexdigest() if t else "" for t in found.group_texts(decimals)]
                columns = [*(batch.column(name).slice(lo, hi - lo) for name in ("row", "doc_id")), *(pa.array(x.astype(np.int64)) for x in (found.n_a, found.n_b, found.n_groups, found.n_links,
                           sums(is_best[which], found.n_links), sums(n[which], found.n_links))), pa.array(digests, pa.string()), lists]
                yield pa.RecordBatch.from_arrays(columns, names)
        release()

    return run


def digest(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    encoded = stored(tokens(df, a_path, b_path, id_col, text_col))
    counts = cut(pair_counts(encoded, a_path, b_path))
    b_id = F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b")
    best = cut(counts.groupBy(b_id).agg(F.max("n").alias("best")))  # B's vocabulary at most
    top = counts.orderBy(F.col("n").desc(), "pair").limit(frequent).orderBy("pair").toArrow()
    ids = best.toArrow()
    most = np.zeros(max(ids.column("b").to_pylist(), default=0) + 1, np.int64)
    most[ids.column("b").to_numpy()] = ids.column("best").to_numpy()
    shared = df.sparkSession.sparkContext.broadcast((top.column("pair").to_numpy(), top.column("n").to_numpy(), most))
    shape = "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string, rare array<struct<pair:bigint,m:bigint>>"
    found = cut(encoded.mapInArrow(_documents(a_path, b_path, shared), shape))
    rare = found.select("row", F.inline("rare")).withColumn("b", b_id)
    rare = hot_join(rare, counts, ["pair"]).join(F.broadcast(best), "b")
    more = rare.groupBy("row").agg(F.sum(F.when(F.col("n") == F.col("best"), F.col("m")).otherwise(0)).alias("_best"), F.sum(F.col("m") * F.col("n")).alias("_sum"))
    return found.join(more, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"), "groups_sha256")


def alignments(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per group: ``doc_id, group_no, a_ids, b_ids``."""

    def run(batches):
        for batch in batches:
            for lo, hi, found in _aligned(batch, a_path, b_path):
                def lists(ids, last):
                    return pa.ListArray.from_arrays(pa.array(np.append(0, np.flatnonzero(last) + 1), pa.int32()), pa.array(ids))

                first = np.cumsum(found.n_groups) - found.n_groups
                number = np.arange(found.n_groups.sum()) - np.repeat(first, found.n_groups)
                owner = pa.array(np.repeat(np.arange(lo, hi), found.n_groups))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(owner), pa.array(number), lists(found.a, found.a_last), lists(found.b, found.b_last)], ["doc_id", "group_no", "a_ids", "b_ids"])

    return tokens(df, a_path, b_path, id_col, text_col).mapInArrow(run, "doc_id bigint, group_no bigint, a_ids array<bigint>, b_ids array<bigint>")
