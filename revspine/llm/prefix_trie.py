"""Prefix trie of conversations as node tables with minimal perfect hashing.

A node is a distinct sequence of first turns.  It is named by a 128-bit digest
chained over its turns, so a conversation becomes one narrow row per prefix and
texts are hashed where they are read, never shuffled.

1. *Paths*: rows of a conversation family meet in turn order and are streamed;
   each prefix gives one row of longs.  A conversation may start with the first
   turns of its family's base conversation (``splice``).
2. *Heavy nodes* have more than ``LIGHT`` members (more on huge inputs: paths
   over 2^20).  There are at most paths / limit of them, so 2^20 at most, however
   the conversations are spread.  Every other node lies below a *top*, the first
   light node of its conversations; the nodes below one top are a shard's.
   So a first turn that opens a third of all conversations is divided at the
   depth where they part, and copies of one conversation collapse to counts.
3. *Shards*: the distinct nodes of a pack of tops get slots from a minimal
   perfect hash function.  A slot keeps its digest and every look-up is compared
   with it, so a digest that is not of the shard finds nothing.  Counts are
   scattered into flat arrays by slot, and leaves and saved tokens are added up
   through the array of parent slots, deepest level first.
4. The tops' totals are summed by parent, and the heavy nodes are one more
   shard that starts from these sums.

The digest of a node's ends is a hash of a list of ids in order, which only a
sequential pass can make.  Ids are put in order over all partitions by (node,
id), written as text in blocks there, and only the blocks of a node meet, as a
stream: nothing is held but one block.

Defined results: NULL role and NULL text are empty; equal turn numbers are
ordered by role, the first ``HEAD`` characters of the text and its digest; rows
that repeat each other are turns of their own; rows with a NULL conv_id belong to no conversation
and are left out; remainders have the sign of the id, as in SQL; an empty table has no node, not even the root;
other columns are ignored.  The rows of one family are read by one task, as a sorted stream.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, release

LIGHT = 1024  # members of a node that is not heavy
HEAVY_NODES = 1 << 20  # bound of the heavy nodes
PACK = 1 << 16  # nodes of the tops that are put into one table together
BLOCK = 1 << 16  # bytes of ids in one piece of text
HEAD = 64
SPARE = 2  # positions per key of a level of the hash function
_ROOT = hashlib.blake2b(digest_size=16).digest()
_BATCH = 1 << 16
_PATH = "conv_id bigint, depth bigint, hi bigint, lo bigint, up_hi bigint, up_lo bigint, bytes bigint, ends bigint"
_NODE = "conv_id bigint, depth bigint, hi bigint, lo bigint, up_hi bigint, up_lo bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, parent_conv_id bigint"


def _mix(hi: np.ndarray, lo: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = hi.view(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x + lo.view(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


class SlotTable:
    """A minimal perfect hash function over distinct digests: keys that are
    alone at a position of a level get the next slots, the others go on to the
    next level.  Slots keep their digests, against which look-ups are verified."""

    def __init__(self, hi: np.ndarray, lo: np.ndarray):
        self.levels: list[np.ndarray] = []
        self.hi, self.lo = np.empty_like(hi), np.empty_like(lo)
        at = 0
        while len(hi):
            if len(self.levels) > 64:
                raise ValueError("digests repeat")
            place = self._place(hi, lo, len(self.levels), SPARE * len(hi))
            alone = np.bincount(place, minlength=SPARE * len(hi)) == 1
            slots = np.where(alone, at + np.cumsum(alone) - 1, -1)
            mine = slots[place]
            done = mine >= 0
            self.hi[mine[done]], self.lo[mine[done]] = hi[done], lo[done]
            self.levels.append(slots)
            at += int(alone.sum())
            hi, lo = hi[~done], lo[~done]

    @staticmethod
    def _place(hi, lo, level: int, size: int) -> np.ndarray:
        return (_mix(hi, lo, level + 1) % np.uint64(size)).astype(np.int64)

    def slots(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 where the table does not hold it."""
        out, open_ = np.full(len(hi), -1, np.int64), np.arange(len(hi))
        for level, slots in enumerate(self.levels):
            found = slots[self._place(hi[open_], lo[open_], level, len(slots))]
            out[open_] = found
            open_ = open_[found < 0]
        held = out >= 0
        held[held] = (self.hi[out[held]] == hi[held]) & (self.lo[out[held]] == lo[held])
        return np.where(held, out, -1)


def accumulate(node: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The rows of a shard (in slot order) with their subtree totals.

    ``node`` has arrays conv_id, depth, hi, lo, up_hi, up_lo, n_convs, bytes and
    what is known of subtrees outside the shard: n_children, n_leaves, saved_tokens."""
    table = SlotTable(node["hi"], node["lo"])
    slot = table.slots(node["hi"], node["lo"])
    if len(slot) and (slot < 0).any() or len(np.unique(slot)) != len(slot):
        raise ValueError("two digests in one slot")
    flat = {}
    for name, values in node.items():  # scatter
        flat[name] = np.empty_like(values)
        flat[name][slot] = values
    parent = table.slots(flat["up_hi"], flat["up_lo"])
    parent[flat["depth"] == 0] = -1
    inside = np.flatnonzero(parent >= 0)
    np.add.at(flat["n_children"], parent[inside], 1)
    leaves, saved = flat["n_leaves"], flat["saved_tokens"]
    leaves[flat["n_children"] == 0] = 1
    saved += (flat["n_convs"] - 1) * flat.pop("bytes")
    order = inside[np.argsort(flat["depth"][inside], kind="stable")]
    for level in np.split(order, np.flatnonzero(np.diff(flat["depth"][order])) + 1)[::-1]:
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    flat["parent"] = parent
    return flat


def _columns(batch, names) -> dict[str, np.ndarray]:
    return {n: batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names}


def _emit(node: dict[str, np.ndarray]) -> pa.RecordBatch:
    flat = accumulate(node)
    parent = flat.pop("parent")
    flat["parent_conv_id"] = pa.array(flat["conv_id"][parent], mask=parent < 0)
    names = [c.split()[0] for c in _NODE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(flat[n]) for n in names], names)


def _shards(batches):
    """mapInArrow function over node rows sorted by top: packs of whole tops."""
    names = ["conv_id", "depth", "hi", "lo", "up_hi", "up_lo", "n_convs", "bytes", "n_children", "n_leaves", "saved_tokens"]
    held: list[dict] = []
    size, last = 0, None

    def flush():
        whole = {n: np.concatenate([h[n] for h in held]) for n in names}
        held.clear()
        return _emit(whole)

    for b in batches:
        if not b.num_rows:
            continue
        rows, hi, lo = _columns(b, names), *(_columns(b, ["top_hi", "top_lo"]).values())
        new = np.append(last is not None and (hi[0], lo[0]) != last, (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]))
        at = 0
        for start in np.flatnonzero(new).tolist():
            if size + start - at >= PACK:
                held.append({n: v[at:start] for n, v in rows.items()})
                yield flush()
                size, at = 0, start
        held.append({n: v[at:] for n, v in rows.items()})
        size += b.num_rows - at
        last = (hi[-1], lo[-1])
    if size:
        yield flush()
    release()


def _paths(splice: int | None):
    """mapInArrow function over turns sorted by family, base first, conversation and turn."""

    def run(batches):
        out: list[tuple] = []
        family = conv = None
        base: list[tuple] = []  # the first turns of the family's base conversation
        digest, depth, seen, take, row = _ROOT, 0, 0, 0, None

        def step(key: bytes, size: int):
            nonlocal digest, depth, row
            if row:
                out.append((*row, 0))
            up, digest, depth = digest, hashlib.blake2b(digest + key, digest_size=16).digest(), depth + 1
            row = (conv, depth, *struct.unpack("<qq", digest), *struct.unpack("<qq", up), size)

        def batch():
            made = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], [c.split()[0] for c in _PATH.split(", ")])
            out.clear()
            return made

        for b in batches:
            for f, c, key, size in zip(*(b.column(n).to_pylist() for n in ("family", "conv_id", "key", "bytes")), strict=True):
                if c != conv:
                    if row:
                        out.append((*row, 1))
                    if f != family:
                        family, base = f, []
                    conv, digest, depth, seen = c, _ROOT, 0, 0
                    row = (c, 0, *struct.unpack("<qq", _ROOT), *struct.unpack("<qq", _ROOT), 0)
                    take = zlib.crc32(str(c).encode()) % splice if splice and c != f else 0
                    for turn in base[:take]:
                        step(*turn)
                if splice and c == f and len(base) < splice - 1:
                    base.append((key, size))
                if seen >= take:
                    step(key, size)
                seen += 1
                if len(out) >= _BATCH:
                    yield batch()
        if row:
            out.append((*row, 1))
        if out:
            yield batch()

    return run


def paths(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
          family: int | None = None, splice: int | None = None) -> DataFrame:
    """One row per conversation and prefix, the root included.

    With ``family`` and ``splice``, conversation c starts with the first
    crc32(c) mod ``splice`` turns of conversation c - c % ``family``, in place of
    as many of its own."""
    c = F.col(f"`{conv_col}`").cast("bigint")
    role, text = (F.coalesce(F.col(f"`{x}`").cast("string"), F.lit("")) for x in (role_col, text_col))
    key = F.substring(F.unhex(F.sha2(F.concat_ws(":", F.octet_length(role).cast("string"), F.concat(role, text)).cast("binary"), 256)), 1, 16)
    turns = df.where(c.isNotNull()).select((c - c % family if family else c).alias("family"), c.alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
                                           role.alias("role"), F.substring(text, 1, HEAD).alias("head"), key.alias("key"), F.octet_length(text).cast("bigint").alias("bytes"))
    first = (F.col("conv_id") != F.col("family")).alias("own")
    ordered = turns.repartition("family").sortWithinPartitions("family", first, "conv_id", F.col("turn").asc_nulls_first(), "role", "head", "key")
    return ordered.select("family", "conv_id", "key", "bytes").mapInArrow(_paths(splice), _PATH)


def _tops(table: SlotTable):
    """mapInArrow function over path rows: adds the digest of the top, NULL on heavy nodes."""

    def run(batches):
        before, top = True, (0, 0)  # of the row before: was it heavy, and its top
        for b in batches:
            if not b.num_rows:
                continue
            x = _columns(b, ["depth", "hi", "lo"])
            heavy = table.slots(x["hi"], x["lo"]) >= 0
            start = ~heavy & (np.append(before, heavy[:-1]) | (x["depth"] == 0))
            since = np.maximum.accumulate(np.where(start, np.arange(len(heavy)), -1))
            hi, lo = (np.where(since >= 0, x[n][since], t) for n, t in zip(("hi", "lo"), top, strict=True))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(hi, mask=heavy), pa.array(lo, mask=heavy)], [*b.schema.names, "top_hi", "top_lo"])
            before, top = bool(heavy[-1]), (hi[-1], lo[-1])

    return run


def _blocks(batches):
    """mapInArrow function over ends in order: comma-joined ids in blocks."""
    node, first, ids, size = None, None, [], 0

    def block():
        return pa.RecordBatch.from_pylist([{"hi": node[0], "lo": node[1], "first": first, "ids": ",".join(ids)}])

    for b in batches:
        for hi, lo, c in zip(*(b.column(n).to_pylist() for n in ("hi", "lo", "conv_id")), strict=True):
            if (hi, lo) != node or size > BLOCK:
                if ids:
                    yield block()
                node, first, ids, size = (hi, lo), c, [], 0
            ids.append(str(c))
            size += len(ids[-1]) + 1
    if ids:
        yield block()


def _hashed(batches):
    """mapInArrow function over blocks in order: one digest per node."""
    node, state = None, None
    out: list[tuple] = []
    for b in batches:
        for hi, lo, ids in zip(*(b.column(n).to_pylist() for n in ("hi", "lo", "ids")), strict=True):
            if (hi, lo) == node:
                state.update(b",")
            else:
                if node:
                    out.append((*node, state.hexdigest()))
                node, state = (hi, lo), hashlib.sha256()
            state.update(ids.encode())
        if len(out) >= _BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["hi", "lo", "ends_sha256"])
            out = []
    if node:
        out.append((*node, state.hexdigest()))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["hi", "lo", "ends_sha256"])


def end_digests(rows: DataFrame) -> DataFrame:
    """``hi, lo, ends_sha256`` of the nodes at which conversations end."""
    ends = rows.where("ends = 1").select("hi", "lo", "conv_id")
    text = ends.repartitionByRange("hi", "lo", "conv_id").sortWithinPartitions("hi", "lo", "conv_id").mapInArrow(_blocks, "hi bigint, lo bigint, first bigint, ids string")
    return text.repartition("hi", "lo").sortWithinPartitions("hi", "lo", "first").mapInArrow(_hashed, "hi bigint, lo bigint, ends_sha256 string")


def trie(rows: DataFrame, light: int = LIGHT) -> DataFrame:
    """One row per node of the trie of the path rows ``rows``: conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = cut(rows)
    limit = max(light, rows.count() // HEAVY_NODES)
    heavy = rows.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select("hi", "lo")
    found = heavy.toArrow()  # HEAVY_NODES rows at most: each holds more than `limit` of the rows
    table = SlotTable(*(np.array(found.column(n).to_numpy(), np.int64) for n in ("hi", "lo")))
    placed = rows.mapInArrow(_tops(table), _PATH + ", top_hi bigint, top_lo bigint")
    zero = F.lit(0).cast("bigint")
    nodes = (placed.groupBy("top_hi", "top_lo", "hi", "lo")
             .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), *[F.max(c).alias(c) for c in ("depth", "up_hi", "up_lo", "bytes")]))
    nodes = cut(nodes)
    below = nodes.where("top_hi IS NOT NULL").withColumns({c: zero for c in ("n_children", "n_leaves", "saved_tokens")})
    below = cut(below.repartition("top_hi", "top_lo").sortWithinPartitions("top_hi", "top_lo").mapInArrow(_shards, _NODE))

    above = nodes.where("top_hi IS NULL")
    parents = F.broadcast(above.select(F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), F.col("conv_id").alias("_parent")))  # HEAVY_NODES rows at most
    below = below.join(parents, ["up_hi", "up_lo"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_parent")).drop("_parent")
    totals = (below.join(parents, ["up_hi", "up_lo"], "left_semi").groupBy(F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo"))
              .agg(F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")))
    above = above.join(totals, ["hi", "lo"], "left").fillna(0, ["n_children", "n_leaves", "saved_tokens"])
    above = above.withColumns({"top_hi": zero, "top_lo": zero}).repartition(1).mapInArrow(_shards, _NODE)  # HEAVY_NODES rows at most

    every = below.select(*above.columns).unionByName(above)
    empty = hashlib.sha256().hexdigest()
    return every.join(end_digests(rows), ["hi", "lo"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))
