"""Bounded-space online packing of tokenised documents.

Each input partition keeps a fixed number of open windows.  A document gives
whole windows first; its tail goes to the open window with the least room that
still holds it (best fit).  When none fits and all windows are in use, the
fullest one takes as much of the tail as it has room for and is emitted full;
the rest of the tail opens the window that became free.  At the end of a
partition the open windows are merged into full ones, and the last rest of each
partition (under one window) is merged with those of up to ``MERGE`` other
partitions after a shuffle.  So at most one window in ``MERGE`` partitions is
padded, and no task holds more than its open windows or ``MERGE`` rests.

Defined results: a NULL or empty text is the closing id alone; texts longer
than a window are cut; the string of an added token in a text is that token, as
the file's default setting has it; an empty table gives no pieces; repeated rows are packed
once each; a NULL id is carried as NULL.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, pieces

#: Fixed value: the published pre-tokenisation pattern of byte-level BPE (white space as the Unicode property).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: The same for texts of code points below 256, where its classes are short.
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
LATIN_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
_BEYOND_LATIN = re.compile("[^\x00-\xff]")
_UNCOMMON = re.compile("[^\x00-\u024f\u2010-\u2027]")
#: Fixed value: byte-level BPE writes printable bytes as themselves and the others, in order, from code point 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_SYMBOLS = {b: b for b in _PRINTABLE} | {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
WINDOW = 1024
OPEN_WINDOWS = 32
MERGE = 256  # partitions whose rests are merged together
CACHED_WORDS = 200_000  # bound of a worker's word cache, which changes speed only
_ENCODERS: dict[tuple[str, bool], "Encoder"] = {}


class _Words(dict):
    """Ids (bytes) of pre-tokens, computed when first asked for."""

    def __init__(self, tokenize):
        self.tokenize = tokenize

    def __missing__(self, word: str) -> bytes:
        symbols = word.encode("utf-8", "replace").decode("latin-1").translate(_BYTE_SYMBOLS)
        ids = struct.pack(f"<{len(found)}I", *found) if (found := [t.id for t in self.tokenize(symbols)]) else b""
        if len(self) < CACHED_WORDS:  # frequent words come early and stay
            self[word] = ids
        return ids


class Encoder:
    """Ids of texts by a byte-level BPE file of ``tokenizers``.

    BPE never merges across pre-tokens, so the file's model is asked once per
    distinct pre-token, up to a bound of remembered ones.  A text that holds the
    string of an added token goes to the library as a whole, which gives that
    token's id; with ``plain`` such strings are ordinary text.
    """

    def __init__(self, path: str, plain: bool = False):
        from tokenizers import Tokenizer

        self.bpe = Tokenizer.from_file(path)
        self.bpe.encode_special_tokens = plain
        added = [] if plain else [re.escape(t.content) for t in self.bpe.get_added_tokens_decoder().values()]
        self.whole = re.compile("|".join([_UNCOMMON.pattern, *added])).search
        self.words = _Words(self.bpe.model.tokenize)
        self.find, self.find_latin = regex.compile(PATTERN).findall, re.compile(LATIN_PATTERN).findall

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        words = self.words
        out = []
        for t in texts:
            if self.whole(t):  # added tokens, and characters whose classes differ between Unicode versions: ask the library
                out.append(np.array(self.bpe.encode(t, add_special_tokens=False).ids, "<u4").tobytes())
                continue
            find = self.find if _BEYOND_LATIN.search(t) else self.find_latin
            out.append(b"".join([words[w] for w in find(t)]))
        return out


def encoder(path: str, plain: bool = False) -> Encoder:
    """One per worker process, file and setting."""
    if (path, plain) not in _ENCODERS:
        _ENCODERS[path, plain] = Encoder(path, plain)
    return _ENCODERS[path, plain]


class Packer:
    """Bounded-space best fit.  A piece is (doc, start, ids, doc_tokens); ids
    are bytes of 4 a token.  ``add`` and ``finish`` yield full windows as lists
    of pieces; ``rest`` holds what is left after ``finish``."""

    def __init__(self, window: int = WINDOW, open_windows: int = OPEN_WINDOWS):
        self.window, self.limit = window, open_windows
        self.open: list[list] = []
        self.room: list[int] = []
        self.rest: list = []

    def add(self, doc, ids: bytes):
        total, at, size = len(ids) // 4, 0, self.window
        while total - at >= size:
            yield [(doc, at, ids[4 * at : 4 * (at + size)], total)]
            at += size
        while at < total:
            need = total - at
            fits = [k for k, r in enumerate(self.room) if r >= need]
            if not fits and len(self.open) < self.limit:
                self.open.append([])
                self.room.append(size)
                fits = [len(self.open) - 1]
            k = min(fits or range(len(self.open)), key=self.room.__getitem__)
            take = min(need, self.room[k])
            self.open[k].append((doc, at, ids[4 * at : 4 * (at + take)], total))
            self.room[k] -= take
            at += take
            if not self.room[k]:
                self.room.pop(k)
                yield self.open.pop(k)

    def finish(self):
        order = sorted(range(len(self.open)), key=self.room.__getitem__)
        windows, self.rest = pour([p for k in order for p in self.open[k]], self.window)
        self.open, self.room = [], []
        yield from windows


def pour(pieces: list, window: int) -> tuple[list, list]:
    """Pieces in order into full windows, cutting where one is full; and the rest."""
    full, now, room = [], [], window
    for doc, start, ids, total in pieces:
        while ids:
            part, ids = ids[: 4 * room], ids[4 * room :]
            now.append((doc, start, part, total))
            start += len(part) // 4
            room -= len(part) // 4
            if not room:
                full.append(now)
                now, room = [], window
    return full, now


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
                     ("sequence_id", pa.int64()), ("offset", pa.int64()), ("token_ids", pa.binary()), ("merge", pa.int64()), ("turn", pa.int64())])
_DDL = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, token_ids binary, merge bigint, turn bigint"
_MERGED = 1 << 62  # sequence ids of merged rests lie above those of partitions


def _rows(windows, first_id: int, with_ids: bool):
    for n, pieces in enumerate(windows):
        at = 0
        for doc, start, ids, total in pieces:
            yield (doc, start, len(ids) // 4, zlib.crc32(ids), total, first_id + n, at, ids if with_ids else None, None, None)
            at += len(ids) // 4


def _batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)


def _pack_partition(path: str, window: int, open_windows: int, end_id: int, with_ids: bool):
    def run(batches):
        here = TaskContext.get().partitionId()
        bpe, packer, done = encoder(path), Packer(window, open_windows), 0
        end = np.array([end_id], "<u4").tobytes()

        def out(windows):
            nonlocal done
            windows = list(windows)
            rows = list(_rows(windows, (here << 32) + done, with_ids))
            done += len(windows)
            return rows

        for b in pieces(batches, 1):
            docs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo, hi in chunks(texts, len, 1 << 20):
                rows = [r for d, ids in zip(docs[lo:hi], bpe.encode(texts[lo:hi]), strict=True) for r in out(packer.add(d, ids + end))]
                if rows:
                    yield _batch(rows)
        rows = out(packer.finish())
        rows += [(doc, start, len(ids) // 4, None, total, None, None, ids, here // MERGE, (here % MERGE << 32) + n) for n, (doc, start, ids, total) in enumerate(packer.rest)]
        if rows:
            yield _batch(rows)

    return run


def _merge_rests(window: int, with_ids: bool):
    def run(batches):
        rests: dict[int, list] = {}
        for b in batches:
            merge = b.column("merge")
            yield b.filter(merge.is_null())
            for r in b.filter(merge.is_valid()).to_pylist():
                rests.setdefault(r["merge"], []).append((r["turn"], r["doc_id"], r["start"], r["token_ids"], r["doc_tokens"]))
        for group, pieces in rests.items():
            full, last = pour([p[1:] for p in sorted(pieces, key=lambda p: p[0])], window)
            if rows := list(_rows(full + [last] * bool(last), _MERGED + (group << 32), with_ids)):
                yield _batch(rows)

    return run


def pack(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         open_windows: int = OPEN_WINDOWS, end_id: int = 0, with_ids: bool = True) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset`` and, if asked for, ``token_ids`` (little-endian
    unsigned 32-bit)."""
    rows = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    packed = rows.mapInArrow(_pack_partition(tokenizer_path, window, open_windows, end_id, with_ids), _DDL)
    # one shuffle of piece rows: rests meet by group, full windows are only spread
    dealt = packed.repartition("merge", "sequence_id").mapInArrow(_merge_rests(window, with_ids), _DDL)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["token_ids"] * with_ids
    return dealt.select(*names)
