"""Exact deduplication by Grace hashing.

Two texts are equal when they are identical after every run of ASCII white
space is replaced by one space (NULL counts as empty).  Records stream into an
open-addressing table that compares complete contents.  When a table outgrows
its budget, its entries and the records that follow are partitioned by a hash
with another seed into spill files, and every file is treated in the same way,
recursively, until its distinct contents fit.

The job runs that table twice: within every input partition, which collapses
copies before anything is shuffled (a text that makes up a third of all rows
leaves at most one record per partition), and, after a shuffle by content
hash, over the surviving records.

Defined results: an empty table gives an empty result; a NULL text equals an
empty or all-space one only if their normalised texts are identical ("" and " "
differ); a NULL id never wins against an id; rows that repeat the smallest id
are all marked as kept by :func:`membership`, while :func:`drop_duplicates`
returns exactly one row per text (of rows with that id the same one on every run).
"""

from __future__ import annotations

import os
import pickle
import tempfile
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ASCII_SPACE, pieces

TABLE_BYTES = 32 << 20  # contents held by one table before it spills
FANOUT = 16  # spill files per level
_ENTRY_BYTES = 200  # bookkeeping of one entry, beside its content


class OpenTable:
    """Linear probing over content hashes; equal hashes compare contents."""

    def __init__(self):
        self.slots = np.full(1024, -1, np.int64)
        self.hashes: list[int] = []
        self.entries: list[list] = []  # [content, id, copies, rest]
        self.bytes = 0

    def _grow(self):
        self.slots = np.full(len(self.slots) * 4, -1, np.int64)
        mask = len(self.slots) - 1
        for k, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = k

    def add(self, h: int, content: bytes, ident, copies: int, rest) -> None:
        mask = len(self.slots) - 1
        at = h & mask
        while (k := self.slots[at]) >= 0:
            entry = self.entries[k]
            if self.hashes[k] == h and entry[0] == content:
                entry[2] += copies
                if ident == entry[1]:
                    smaller = rest is not None and repr(rest) < repr(entry[3])  # any fixed choice
                else:
                    smaller = entry[1] is None or ident is not None and ident < entry[1]
                if smaller:
                    entry[1], entry[3] = ident, rest
                return
            at = (at + 1) & mask
        self.slots[at] = len(self.entries)
        self.hashes.append(h)
        self.entries.append([content, ident, copies, rest])
        # a whole row holds its text once more
        self.bytes += (len(content) if rest is None else 2 * len(content)) + _ENTRY_BYTES
        if 3 * len(self.entries) > 2 * len(self.slots):
            self._grow()


def grace(records: Iterator[tuple], budget: int = TABLE_BYTES, fanout: int = FANOUT, level: int = 0) -> Iterator[list]:
    """``(content, id, copies, rest)`` records to one entry per content:
    smallest id (its ``rest``), copies summed.  Memory stays near ``budget``
    plus the largest content; spill files live in the task's temp folder."""
    table = OpenTable()
    for record in records:
        table.add(xxhash.xxh64_intdigest(record[0], level), *record)
        if table.bytes > budget and len(table.entries) > 1:
            break
    else:
        yield from table.entries
        return
    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        names = [os.path.join(folder, str(k)) for k in range(fanout)]
        files = [open(name, "wb", buffering=1 << 16) for name in names]
        try:
            def spill(record):
                # another seed than the table's, so that a level really splits what the one above put together
                pickle.dump(tuple(record), files[xxhash.xxh64_intdigest(record[0], 1_000_003 + level) % fanout], pickle.HIGHEST_PROTOCOL)
            for entry in table.entries:
                spill(entry)
            del table
            for record in records:
                spill(record)
        finally:
            for f in files:
                f.close()
        for name in names:
            with open(name, "rb") as f:
                yield from grace(_read(f), budget, fanout, level + 1)
            os.unlink(name)


def _read(f) -> Iterator[tuple]:
    while True:
        try:
            yield pickle.load(f)
        except EOFError:
            return


def normalised(text: str = "text"):
    """The text with each run of ASCII white space as one space; NULL as empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), ASCII_SPACE, " ")


def _batches(rows: Iterator[list], schema: pa.Schema, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    out, held = [], 0
    for row in rows:
        out.append(row)
        held += sum(len(x) for x in row if isinstance(x, (bytes, str))) + 64
        if held > size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema)], schema=schema)
            out, held = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema)], schema=schema)


def _collapse(budget: int):
    """mapInArrow function over (content, id, copies, rest)."""
    schema = pa.schema([("_content", pa.binary()), ("_id", pa.int64()), ("_copies", pa.int64()), ("_rest", pa.binary())])

    def run(batches):
        def records():
            for b in pieces(batches, 0):
                yield from zip(*(c.to_pylist() for c in b.columns))
        yield from _batches(grace(records(), budget), schema)

    return run


_COLLAPSED = "_content binary, _id bigint, _copies bigint, _rest binary"


def distinct_contents(df: DataFrame, content, ident, rest=None, budget: int = TABLE_BYTES) -> DataFrame:
    """One row per distinct binary ``content``: ``_content, _id`` (smallest),
    ``_copies``, ``_rest`` (the binary payload of the row with that id)."""
    rows = df.select(content.alias("_content"), ident.cast("bigint").alias("_id"), F.lit(1).cast("bigint").alias("_copies"),
                     (rest if rest is not None else F.lit(None)).cast(T.BinaryType()).alias("_rest"))
    local = rows.mapInArrow(_collapse(budget), _COLLAPSED)
    dealt = local.repartition(F.xxhash64("_content"))
    return dealt.mapInArrow(_collapse(budget), _COLLAPSED)


def membership(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = TABLE_BYTES) -> DataFrame:
    """Per row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    The members meet their group over the digest of the normalised text (a
    join whose skewed side Spark splits); only groups of two or more take part.
    The groups themselves are told apart by complete contents.
    """
    content = normalised(text_col)
    members = df.select(F.col(id_col).alias("_m_id"), F.sha2(content.cast("binary"), 256).alias("_m_sha"))
    groups = (distinct_contents(df, content.cast("binary"), F.col(id_col), budget=budget)
              .where("_copies > 1")
              .select(F.sha2("_content", 256).alias("_g_sha"), F.col("_id").alias("_g_id"), F.col("_copies").alias("_g_size")))
    joined = members.join(groups, F.col("_m_sha") == F.col("_g_sha"), "left")
    keep = F.when(F.col("_g_size").isNull(), F.col("_m_id").cast("bigint")).otherwise(F.col("_g_id"))
    return joined.select(F.col("_m_id").alias(id_col), keep.alias("keep_id"), F.coalesce("_g_size", F.lit(1).cast("bigint")).alias("group_size"),
                         F.col("_m_id").cast("bigint").eqNullSafe(keep).alias("kept"), F.col("_m_sha").alias("text_sha256"))


def drop_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = TABLE_BYTES) -> DataFrame:
    """The rows of ``df`` (all its columns), one per text: that with the smallest id.

    Whole rows ride through the tables, so texts are shuffled once and no join
    is needed afterwards.
    """
    names = df.columns
    rows = df.select(normalised(text_col).cast("binary").alias("_content"), F.col(id_col).cast("bigint").alias("_id"), F.lit(1).cast("bigint").alias("_copies"),
                     F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)]).alias("_row"))
    shape = f"_content binary, _id bigint, _copies bigint, _row {rows.schema['_row'].dataType.simpleString()}"

    def run(batches):
        schema = []  # Spark's own Arrow schema, with whatever columns the table has

        def records():
            for b in pieces(batches, 0):
                schema[:] = [b.schema]
                yield from zip(*(c.to_pylist() for c in b.columns))

        entries = grace(records(), budget)
        for first in entries:
            yield from _batches(chain([first], entries), schema[0])
            return

    kept = rows.mapInArrow(run, shape).repartition(F.xxhash64("_content")).mapInArrow(run, shape)
    return kept.select(*[F.col(f"_row.c{k}").alias(c) for k, c in enumerate(names)])
