"""Removal of long repeated substrings by prefix-free parsing.

Every byte covered by a string of ``LENGTH`` bytes that also starts at another
position of the corpus (same document or another) is removed; matches never
cross documents and are judged on the input.

A window is a string of ``LENGTH`` bytes.  Its trigger is the least rolling
hash of eight bytes in it (the first of equal ones), so equal windows have
their trigger at the same place, and successive windows mostly share it: the
windows of one trigger form a phrase, cut into stretches of ``REACH`` starts.

1. *Parse*: a stretch has a core, the bytes all its windows share.  Equal
   windows have equal cores, so a stretch whose core occurs once in the corpus
   holds no repeat; counting cores (combined before the shuffle) drops nearly
   all of ordinary text.
2. *Dictionary*: the distinct contexts (all bytes of a stretch's windows) with
   their counts.  A context that occurs twice is repeated as a whole, however
   many copies there are; copies go no further than this count.
3. *Order*: contexts that occur once but share their core with another one lie
   at the ends of matches.  For those that share a core, the parts before it
   are put into order by their suffixes and the parts from it on by their
   prefixes, with the lengths that neighbours share.  A window is a suffix of
   the one and a prefix of the other, so the two orders together give the
   corpus order of all windows, in which equal ones are adjacent.

Cores with more than ``GROUP`` distinct contexts are not brought together:
there the windows themselves are counted, one row each, which combines before
the shuffle and has no group at all.  Both ways are exact.  Contexts are told
apart by two 64-bit hashes, windows of step 3 by their bytes.

Defined results: NULL text counts as empty; texts shorter than ``LENGTH`` keep
all bytes; rows that repeat id and text are documents like others, so their
long texts are repeats of each other; rows with a NULL id are kept apart by
128 hash bits of their texts, rows that repeat an id by 64; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, cut, hot_join, pieces, text_bytes

LENGTH = 400
TRIGGER = 8  # bytes of the rolling hash
REACH = 128  # window starts of a stretch, 256 at most
GROUP = 16384  # distinct contexts of one core that a task takes together
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_WORK_BYTES = 1 << 20
_digest = xxhash.xxh3_64_intdigest
_CORE, _CONTEXT = 1, 1 << 20  # hash seeds


def triggers(data: bytes, length: int) -> np.ndarray:
    """For every window of ``data``, the position of its least 8-byte hash.

    Sliding minima from running minima within blocks, forward and backward."""
    width, n = length - TRIGGER + 1, len(data) - length + 1
    eight = np.ndarray((len(data) - TRIGGER + 1,), "<u8", data, strides=(1,))
    with np.errstate(over="ignore"):
        value = ((eight * _FACTOR) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(eight), dtype=np.uint64)
    blocks = np.append(value, np.full(-len(value) % width, 0xFFFFFFFFFFFFFFFF, np.uint64)).reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(backward[:n], forward[width - 1 : width - 1 + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def stretches(data: bytes, begin: np.ndarray, stop: np.ndarray, length: int, reach: int = REACH):
    """Stretches of documents laid end to end in ``data`` (document i is
    ``begin[i]:stop[i]``, at least ``length`` bytes each): arrays of document,
    first and last window start, core start and core end."""
    parts = []
    for lo in range(0, len(data) - length + 1, _WORK_BYTES):  # a very long text in pieces of as many windows
        trigger = triggers(data[lo : lo + _WORK_BYTES + length - 1], length) + lo
        start = np.arange(lo, lo + len(trigger))
        doc = np.searchsorted(begin, start, "right") - 1
        whole = start + length <= stop[doc]
        trigger, start, doc = trigger[whole], start[whole], doc[whole]
        if not len(start):
            continue
        fresh = np.append(True, (trigger[1:] != trigger[:-1]) | (doc[1:] != doc[:-1]))
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(start)) - 1
        parts.append((doc[first], start[first], start[last], trigger[first]))
    if not parts:
        return (np.zeros(0, np.int64),) * 5
    doc, low, high, trigger = (np.concatenate(a) for a in zip(*parts, strict=True))
    # distance of a window start before its trigger, cut at multiples of REACH counted from the trigger
    k0, k1 = (trigger - high) // reach, (trigger - low) // reach
    n = k1 - k0 + 1
    k = np.repeat(k0, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    doc, low, high, trigger = (np.repeat(a, n) for a in (doc, low, high, trigger))
    core = trigger - reach * k
    far = np.minimum(reach * (k + 1) - 1, length - TRIGGER)
    return doc, np.maximum(low, trigger - far), np.minimum(high, core), core, trigger - far + length


def _parse(length: int, reach: int):
    """mapInArrow function: documents (d, t, text) to rows (d, t, pos, k, c)."""

    def run(batches):
        for b in pieces(batches, 2):
            ids, prints, texts = (c.to_pylist() for c in b.columns)
            long_ = [i for i, t in enumerate(texts) if len(t) >= length]
            ids, prints, texts = ([a[i] for i in long_] for a in (ids, prints, texts))
            for lo, hi in chunks(texts, len, _WORK_BYTES):
                data = b"".join(texts[lo:hi])
                stop = np.cumsum([len(t) for t in texts[lo:hi]])
                begin = np.append(0, stop[:-1])
                doc, low, high, core, end = stretches(data, begin, stop, length, reach)
                shape = ((core - low) * 512 + (high - low)).tolist()  # where the windows lie around the core
                k = [_digest(data[a:e], _CORE) for a, e in zip(core.tolist(), end.tolist(), strict=True)]
                c = [_digest(data[a : e + length], _CONTEXT + s) for a, e, s in zip(low.tolist(), high.tolist(), shape, strict=True)]
                pos = low - begin[doc] << 8 | high - low
                yield pa.RecordBatch.from_arrays([pa.array(np.array(ids[lo:hi], np.int64)[doc]), pa.array(np.array(prints[lo:hi], np.int64)[doc]), pa.array(pos), pa.array(np.array(k, np.uint64).view(np.int64)), pa.array(np.array(c, np.uint64).view(np.int64))], ["d", "t", "pos", "k", "c"])

    return run


def _once(batches):
    """(d, t, text, wanted) of each document the first time its name comes: copies hold nothing else."""
    seen = set()
    for b in pieces(batches, 2):
        yield [r[:4] for r in zip(*(c.to_pylist() for c in b.columns), strict=True) if r[:2] not in seen and not seen.add(r[:2])]


def _contexts(length: int, reach: int):
    """mapInArrow function: (d, t, text, wanted) to rows (k, d, t, pos, w, before, after):
    the bytes of the windows before the core's start and from it on."""

    def run(batches):
        for docs in _once(batches):
            out = []
            for d, t, text, wanted in docs:
                for x in wanted:
                    first, size = x["pos"] >> 8, x["pos"] & 0xFF
                    trigger = int(triggers(text[first : first + length], length)[0])  # of the first window, so of all of them
                    core = trigger - trigger // reach * reach
                    out.append((x["k"], d, t, x["pos"], x["w"], text[first : first + core], text[first + core : first + size + length]))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
            columns = zip(*out, strict=True) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["k", "d", "t", "pos", "w", "before", "after"])

    return run


def _shared_lengths(strings: list[bytes], width: int) -> np.ndarray:
    """How many leading bytes each string shares with the one before it."""
    padded = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(-1, width)
    differ = padded[1:] != padded[:-1]
    return np.append(0, np.where(differ.any(1), differ.argmax(1), width)) if width else np.zeros(len(strings), np.int64)


def _ordered(keys: list, strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of (key, string), and the length shared with the string before (-1 where the key changes)."""
    order = sorted(range(len(strings)), key=lambda i: (keys[i], strings[i].ljust(width, b"\0")))
    shared = _shared_lengths([strings[i] for i in order], width)
    group = np.array([keys[i] for i in order])
    shared[np.append(True, group[1:] != group[:-1])] = -1
    return np.array(order), shared


def equal_windows(rows: list[tuple], length: int, reach: int = REACH) -> list[tuple[int, int, int]]:
    """Repeated windows of contexts (k, d, t, pos, w, before, after), whole groups
    of equal k: rows (d, t, pos) of the contexts with w = 1.

    Window y of a context is the last y bytes of ``before`` and the first
    ``length - y`` of ``after``: one class in the order of the reversed parts
    before the core, one in that of the parts from it on."""
    keys = [r[0] for r in rows]
    left, left_shared = _ordered(keys, [r[5][::-1] for r in rows], reach)
    right, right_shared = _ordered(keys, [r[6] for r in rows], length)
    size = np.array([r[3] & 0xFF for r in rows])
    most = np.array([len(r[5]) for r in rows])  # y of the first window; the last one's is smaller by size
    weight = np.array([r[4] for r in rows])
    hit = np.zeros((len(rows), reach), bool)
    before, after = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
    for y in range(min(reach, int(most.max()) + 1)):
        own = np.flatnonzero((most - size <= y) & (y <= most))
        if len(own) < 2 and not (weight[own] > 1).any():
            continue
        before[left] = np.cumsum(left_shared < y)
        after[right] = np.cumsum(right_shared < length - y)
        _, which = np.unique(before[own] * (len(rows) + 1) + after[own], return_inverse=True)
        hit[own, y] = np.bincount(which, weight[own])[which] > 1
    out = []
    for i in np.flatnonzero((weight == 1) & hit.any(1)).tolist():
        first = (rows[i][3] >> 8) + int(most[i])  # start of window y is this less y
        starts = np.sort(first - np.flatnonzero(hit[i]))
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
            out.append((rows[i][1], rows[i][2], int(run[0]) << 8 | len(run) - 1))
    return out


def _resolve(length: int, reach: int):
    """mapInArrow function: contexts sorted by k and name to repeated windows (d, t, pos)."""

    def run(batches):
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        held: list[tuple] = []

        def out():
            found = equal_windows(held, length, reach)
            return pa.RecordBatch.from_arrays([pa.array([f[n] for f in found], pa.int64()) for n in range(3)], ["d", "t", "pos"])

        for _, group in groupby(rows, key=lambda r: r[0]):
            held += (next(same) for _, same in groupby(group, key=lambda r: r[:4]))  # at most GROUP contexts; copies of a document lie side by side
            if len(held) >= GROUP:
                yield out()
                held = []
        if held:
            yield out()

    return run


def _window_rows(length: int):
    """mapInArrow function: (d, t, text, wanted [(pos, w)]) to rows (h1, h2, w, d, t, pos) of single windows."""

    def run(batches):
        for docs in _once(batches):
            for d, t, text, wanted in docs:
                h1, h2, w, pos = [], [], [], []
                for x in wanted:
                    first, size = x["pos"] >> 8, x["pos"] & 0xFF
                    for p in range(first, first + size + 1):
                        h1.append(_digest(text[p : p + length], 1))
                        h2.append(_digest(text[p : p + length], 2))
                        w.append(x["w"])
                        pos.append(p << 8)
                yield pa.RecordBatch.from_arrays([pa.array(np.array(h1, np.uint64).view(np.int64)), pa.array(np.array(h2, np.uint64).view(np.int64)), pa.array(w, pa.int32()), pa.array([d] * len(w), pa.int64()), pa.array([t] * len(w), pa.int64()), pa.array(pos, pa.int64())], ["h1", "h2", "w", "d", "t", "pos"])

    return run


def documents_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, d, t, text``: d (the id; without one, a second hash of the text) and t (a hash of the text) name a document."""
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), text_bytes(text_col).alias("text"))
    return rows.select("id", F.coalesce("id", F.xxhash64(F.lit(1), "text")).alias("d"), F.xxhash64("text").alias("t"), "text")


def repeated_windows(docs: DataFrame, length: int = LENGTH, reach: int = REACH, group: int = GROUP) -> DataFrame:
    """``d, t, pos``: starts of windows that occur more than once; pos holds the
    first start and how many more follow it."""
    parsed = docs.select("d", "t", "text").mapInArrow(_parse(length, reach), "d bigint, t bigint, pos bigint, k bigint, c bigint")
    shared = parsed.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k")
    # dealt out once more: the join left a hot core's entries side by side, where later joins could not split them
    open_ = cut(hot_join(parsed, shared, ["k"], "left_semi").repartition("d", "t", "pos"))

    dictionary = open_.groupBy("k", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("d", "t", "pos")).alias("one"))
    whole = hot_join(open_, dictionary.where("n > 1").select("k", "c"), ["k", "c"], "left_semi").select("d", "t", "pos")
    torn = dictionary.groupBy("k").agg(F.max(F.col("n") == 1).alias("some"), F.count(F.lit(1)).alias("contexts")).where("some").select("k", "contexts")
    wanted = cut(hot_join(dictionary, torn, ["k"]).select("k", "contexts", "one.d", "one.t", "one.pos", F.least("n", F.lit(2)).cast("int").alias("w")))

    def at_texts(rows):
        """The entries of each document with its text.  All of a document's
        columns stay, so that these joins and the last one share one shuffle of the texts."""
        by_doc = rows.groupBy("d", "t").agg(F.collect_list(F.struct("k", "pos", "w")).alias("wanted"))
        return docs.join(by_doc, ["d", "t"]).select("d", "t", "text", "wanted", "id")

    together = at_texts(wanted.where(F.col("contexts") <= group)).mapInArrow(_contexts(length, reach), "k bigint, d bigint, t bigint, pos bigint, w int, before binary, after binary")
    ordered = together.repartition("k").sortWithinPartitions("k", "d", "t", "pos").mapInArrow(_resolve(length, reach), "d bigint, t bigint, pos bigint")

    single = at_texts(wanted.where(F.col("contexts") > group)).mapInArrow(_window_rows(length), "h1 bigint, h2 bigint, w int, d bigint, t bigint, pos bigint")
    twice = single.groupBy("h1", "h2").agg(F.sum("w").alias("n")).where("n > 1").select("h1", "h2")
    counted = hot_join(single.where("w = 1"), twice, ["h1", "h2"], "left_semi").select("d", "t", "pos")
    return whole.unionByName(ordered).unionByName(counted)


def covered(positions: list[int], length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the windows cover."""
    out: list[list[int]] = []
    for first, size in sorted((p >> 8, p & 0xFF) for p in positions):
        end = first + size + length
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return [(a, b) for a, b in out]


def _remove(length: int, with_text: bool):
    def run(batches):
        for b in pieces(batches, 1):
            out = []
            for ident, text, positions in zip(*(c.to_pylist() for c in b.columns), strict=True):
                runs = covered(positions or [], length)
                kept, at = [], 0
                for a, e in runs:
                    kept.append(text[at:a])
                    at = e
                kept = b"".join([*kept, text[at:]])
                out.append((ident, len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept if with_text else None, [x for r in runs for x in r] if with_text else None))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64()))
            columns = zip(*out, strict=True) if out else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])

    return run


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, with_text: bool = True, reach: int = REACH, group: int = GROUP) -> DataFrame:
    """Per row: id, ``n_bytes, n_removed, n_spans, kept_sha256`` and, if asked
    for, ``kept`` (remaining bytes) and ``spans`` (starts and ends of the removed runs)."""
    docs = documents_of(df, id_col, text_col)
    found = repeated_windows(docs, length, reach, group).groupBy("d", "t").agg(F.collect_set("pos").alias("positions"))  # of one document; those of its copies are one, before the shuffle too
    joined = docs.join(found, ["d", "t"], "left").select("id", "text", "positions")
    done = joined.mapInArrow(_remove(length, with_text), "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary, spans array<bigint>")
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept", "spans"] * with_text
    return done.select(F.col("id").alias(id_col), *names)
