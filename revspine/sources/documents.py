"""Manifest documents read by many tasks.

A manifest document is one JSON object with a ``customers`` array, often on one
line, so a line reader gives it to one task.  Here Spark splits the file at
every ``}`` instead, a place that a split can find without having read what comes
before, and two facts make the pieces readable on their own:

* a block that begins inside a string, or outside, ends inside or outside,
* and in either case changes the depth by its brackets outside strings.

Both add up over the blocks of the file.  The first pass sums up every
block for either beginning; the driver adds up one row per block (a document of a
terabyte has some thousands); the second pass reads every block from its known
state and cuts it into entries.  Positions are a prefix sum of the blocks'
entry counts.  An entry that a block's end divides is put together again;
what a damaged document leaves open is reported block by block.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.variant import read_fields, unreadable_fields
from ..schemas import CORRUPT, MANIFEST_ENTRY, UNREADABLE
from ..session import ensure_utc
from .files import scratch

_REST_OF_STRING = re.compile(r'(?:[^"\\]|\\.)*("?)', re.DOTALL)
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*("?)|[{}\[\]]|[^\s,:"{}\[\]]+', re.DOTALL)
_BLOCK = "file string, block bigint, pieces bigint, bytes bigint, file_size bigint, end0 boolean, end1 boolean, depth0 bigint, depth1 bigint"
_PART = "file string, block bigint, ordinal bigint, scope string, kind string, text string"
ENTRY_DEPTH = 2  # inside the document's object and its array


def _pieces(spark: SparkSession, path) -> DataFrame:
    meta = F.col("_metadata")
    return spark.read.option("lineSep", "}").text(path).select("value", meta.file_path.alias("file"), meta.file_block_start.alias("block"), meta.file_size.alias("file_size"))


def _scan(text: str, inside: bool, closed: bool):
    """Tokens of a piece outside strings as (token, start, end), with the brace
    that ends it (if ``closed``); whether it ends inside a string; and where the
    string ends in which it begins."""
    at = 0
    if inside:
        m = _REST_OF_STRING.match(text)
        if not m.group(1):
            return [], True, len(text)
        at = m.end()
    tokens = []
    for m in _TOKEN.finditer(text, at):
        if m.group(1) == "":  # a string without its end takes the rest of the piece
            return [*tokens, (m.group(), m.start(), len(text))], True, at
        tokens.append((m.group(), m.start(), m.end()))
    return tokens + [("}", len(text), len(text) + 1)] * closed, False, at


def _rise(tokens) -> int:
    return sum((t in "{[") - (t in "}]") for t, _, _ in tokens if len(t) == 1 and t in "{}[]")


def _summaries(batches):
    """One row per block: its size and, for a beginning outside and inside a string, its end and its change of depth; pieces of a block come in order."""
    now, out = None, []

    def close():
        out.append((*now[0], now[1], now[2], now[3], *now[4], *now[5]))

    for b in batches:
        for text, file, block, size in zip(*(b.column(n).to_pylist() for n in ("value", "file", "block", "file_size")), strict=True):
            if now is None or now[0] != (file, block):
                if now:
                    close()
                now = [(file, block), 0, 0, size, [False, True], [0, 0]]
            now[1] += 1
            now[2] += len(text.encode()) + 1
            for start in (0, 1):
                tokens, now[4][start], _ = _scan(text, now[4][start], True)
                now[5][start] += _rise(tokens)
    if now:
        close()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], [c.split()[0] for c in _BLOCK.split(", ")])


@dataclass
class _Start:
    """The state in which a block begins."""

    inside: bool
    depth: int
    unended: bool  # its last piece is the last of its file, and no brace follows


def _after(r, inside: bool, depth: int) -> tuple[bool, int]:
    """The state behind a block, from its summary and the state before it."""
    return (r["end1"], depth + r["depth1"]) if inside else (r["end0"], depth + r["depth0"])


def _starts(rows, one: bool) -> tuple[dict[tuple[str, int], _Start], dict[str, bool]]:
    """The states of all blocks, from the summaries, and whether each document
    breaks off.  A document is a file, or all files in name order (``one``)."""
    sizes: dict[str, list[int]] = {}
    for r in rows:
        own = sizes.setdefault(r["file"], [0, r["file_size"], 0])
        own[0] += r["bytes"]
        own[2] = max(own[2], r["block"])
    out, broken, seen = {}, {}, None
    inside, depth = False, 0
    for r in sorted(rows, key=lambda r: (r["file"], r["block"])):
        if r["file"] != seen and not one:
            inside, depth = False, 0
        seen = r["file"]
        size, file_size, last = sizes[seen]
        unended = r["block"] == last and size > file_size
        out[seen, r["block"]] = _Start(inside, depth, unended)
        inside, depth = _after(r, inside, depth)
        depth += unended and not inside  # no brace stands behind the last piece
        broken["" if one else seen] = inside or depth != 0
    return out, broken


class _Reader:
    """Cuts one block into entries: whole ones, the end of one begun before
    (``rest``), one that goes on in the next block (``open``).  An entry's
    ordinal counts from the block's start or from the start of its array there."""

    def __init__(self, start: _Start, array: str):
        self.inside, self.depth, self.array = start.inside, start.depth, array
        self.scope = None  # NULL: the array that was open before the block
        self.key, self.ordinal, self.parts, self.found = None, 0, [], False
        self.string = start.inside and start.depth == ENTRY_DEPTH  # an entry that is a string
        self.begun = "rest" if start.depth > ENTRY_DEPTH or self.string else None

    def read(self, text: str, closed: bool):
        began_inside = self.inside
        tokens, self.inside, resumed = _scan(text, self.inside, closed)
        whole = text + "}" * closed
        at = 0  # of the entry that is open in this piece
        if self.string and began_inside and (tokens or not self.inside):
            yield self.done(self.begun, "".join(self.parts) + whole[:resumed])
        for token, start, end in tokens:
            if token in ("{", "["):
                if self.depth == ENTRY_DEPTH and self.begun is None:
                    self.begun, at = "whole", start
                elif self.depth == 1:
                    self.scope, self.ordinal = (self.key if token == "[" else ""), 0
                    self.found |= self.scope == self.array
                self.depth += 1
            elif token in ("}", "]"):
                self.depth -= 1
                if self.depth == ENTRY_DEPTH and self.begun:
                    yield self.done(self.begun, "".join(self.parts) + whole[at:end])
            elif self.depth == 1 and token[0] == '"':
                self.key = token[1:-1]
            elif self.depth == ENTRY_DEPTH and self.begun is None and self.scope != "":
                if self.inside and end == len(text) and token[0] == '"':
                    self.begun, self.string, at = "whole", True, start
                else:
                    yield self.done("whole", token)
        if self.begun:
            self.parts.append(whole[at:])

    def done(self, kind: str, text: str):
        row = (self.ordinal if kind == "whole" else -1, self.scope, kind, text)
        self.ordinal += kind == "whole"
        self.parts, self.begun, self.string = [], None, False
        return row

    def finish(self):
        if self.begun:
            yield (self.ordinal if self.begun == "whole" else -1, self.scope, "open" if self.begun == "whole" else "through", "".join(self.parts))
        yield (self.ordinal, self.scope, "end", "found" if self.found else None)


def _entries(shared, array: str):
    def run(batches):
        starts = shared.value
        now, reader, held, out = None, None, None, []

        def rows(found):
            out.extend((*now, *f) for f in found)

        def batch():
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)], [c.split()[0] for c in _PART.split(", ")])
            out.clear()
            return made

        def end():
            if reader:
                rows(reader.read(held, not starts[now].unended))
                rows(reader.finish())

        for b in batches:
            for text, file, block in zip(*(b.column(n).to_pylist() for n in ("value", "file", "block")), strict=True):
                if now != (file, block):
                    end()
                    now, reader = (file, block), _Reader(starts[file, block], array)
                else:
                    rows(reader.read(held, True))
                held = text  # the last piece of a file may have no brace behind it
                if len(out) >= 10_000:
                    yield batch()
        end()
        if out:
            yield batch()

    return run


def split_documents(spark: SparkSession, path, array: str = "customers", one: bool = False) -> DataFrame:
    """The entries of ``array`` of every document under ``path``: ``document``
    (number of the file in name order), ``place`` (from 0), ``text``, and
    ``damaged``: what a document that breaks off leaves open (no place).  With
    ``one``, the files in name order are the parts of one document."""
    pieces = _pieces(spark, path)
    summaries = [r.asDict() for r in pieces.mapInArrow(_summaries, _BLOCK).collect()]  # a row per block of a file
    starts, breaks = _starts(summaries, one)
    parts = pieces.select("value", "file", "block").mapInArrow(_entries(spark.sparkContext.broadcast(starts), array), _PART)
    folder = scratch(spark)
    parts.write.parquet(folder)
    parts = spark.read.schema(parts.schema).parquet(folder)

    counted = parts.where("kind IN ('whole', 'open')").groupBy("file", "block", "scope").agg(F.count(F.lit(1)).alias("n"))
    ends = {(r["file"], r["block"]): r for r in parts.where("kind = 'end'").collect()}  # a row per block
    opens = {(r["file"], r["block"]): r["kind"] for r in parts.where("kind IN ('open', 'through')").select("file", "block", "kind").collect()}  # one per block at most
    counts: dict[tuple, int] = {(r["file"], r["block"], r["scope"]): r["n"] for r in counted.collect()}
    numbers = {name: n for n, name in enumerate([""] if one else sorted({f for f, _ in starts}))}
    table, found, lost, seen = [], {}, [], None
    scope, place, owner = "", 0, None
    for n, (file, block) in enumerate(sorted(starts)):
        document = "" if one else file
        if document != seen:
            lost += [owner] * (owner is not None)
            seen, scope, place, owner = document, "", 0, None
        before, end = scope, ends[file, block]
        first, named = counts.get((file, block, None), 0), counts.get((file, block, array), 0)
        found[document] = found.get(document, False) or end["text"] is not None
        table.append((file, block, n, numbers[document], place, before == array, first, owner))
        place += (first if before == array else 0) + named
        scope = before if end["scope"] is None else end["scope"]
        kind = opens.get((file, block))
        owner = n if kind == "open" else owner if kind == "through" else None
    lost += [owner] * (owner is not None)  # entries that never end
    shape = "file string, block bigint, turn bigint, document bigint, before bigint, first_counts boolean, first bigint, owner bigint"
    rows = parts.where("kind <> 'end'").join(F.broadcast(spark.createDataFrame(table, shape)), ["file", "block"])  # a row per block

    mine = F.when(F.col("scope").isNull(), F.col("first_counts")).otherwise(F.col("scope") == array)
    ahead = F.when(F.col("scope").isNotNull() & F.col("first_counts"), F.col("first")).otherwise(0)  # the entries of a named array come after those of the one before
    rows = rows.withColumn("place", F.when(mine & F.col("kind").isin("whole", "open"), F.col("before") + F.col("ordinal") + ahead))
    none = F.lit(None).cast("string").alias("damaged")
    whole = rows.where(mine & (F.col("kind") == "whole")).select("document", "place", "text", none)
    key = F.when(F.col("kind") == "open", F.col("turn")).otherwise(F.col("owner"))
    divided = rows.where("kind IN ('open', 'through', 'rest')").withColumn("key", key)
    ended = F.col("key").isNotNull() & ~F.col("key").isin(lost)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "")
    put = divided.where(ended).groupBy("document", "key").agg(F.max("place").alias("place"), text.alias("text")).where("place IS NOT NULL")  # the parts of one entry
    rest = divided.where(~ended).select("document", F.lit(None).cast("bigint").alias("place"), F.lit(None).cast("string").alias("text"), F.col("text").alias("damaged"))
    out = whole.unionByName(put.select("document", "place", "text", none)).unionByName(rest)
    left = {table[n][3] for n in lost}
    bad = [(n, None, None, f"{name.rpartition('/')[2]}: {'breaks off' if breaks[name] else f'no array {array}'}") for name, n in numbers.items()
           if name in breaks and (n not in left if breaks[name] else not found[name])]
    return out.unionByName(spark.createDataFrame(bad, "document bigint, place bigint, text string, damaged string")) if bad else out


def read_split_manifest(spark: SparkSession, path, one: bool = False) -> DataFrame:
    """Manifest documents of any size, each read by many tasks; the columns and positions of
    :func:`~.raw.manifest_entries`.  The entries before the place where a document breaks off are kept."""
    ensure_utc(spark)
    rows = split_documents(spark, path, one=one)
    once = rows.select("document", "place", "text", "damaged", F.inline(F.array(F.struct(F.try_parse_json("text").alias("_e")))))
    columns, unreadable = read_fields(F.col("_e"), MANIFEST_ENTRY), unreadable_fields(F.col("_e"), MANIFEST_ENTRY)
    is_object = F.coalesce(F.schema_of_variant("_e").startswith("OBJECT"), F.lit(False))
    broken = F.when(F.col("damaged").isNotNull(), F.col("damaged")).when(~is_object, F.coalesce(F.col("_e").cast("string"), F.col("text")))
    return once.select((F.col("document") * (1 << 32) + F.col("place")).alias("position"), *columns, broken.alias(CORRUPT), unreadable.alias(UNREADABLE))
