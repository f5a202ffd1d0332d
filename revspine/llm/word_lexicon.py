"""BPE encoding and decoding with a minimal acyclic transducer of frequent words.

BPE never merges across words, so a word's ids depend on the word alone.

1. *Count*: the words of all documents, counted in every task and combined
   before the shuffle; the ``LEXICON_WORDS`` most frequent ones (ties by word)
   of at most ``LONGEST`` bytes make the lexicon.
2. *Compile*: the sorted words go into a minimal acyclic transducer.  Ids are
   outputs on the arcs, as near to the start as they can be; states with the
   same arcs, outputs and ends are one state, so words share their suffixes.
3. *Ship*: the automaton is a file of flat arrays in the shared checkpoint
   folder, handed to the executors as a Spark file; a lost executor's successor
   fetches it again.  Workers map it into memory, so all workers of an executor share its pages.
4. *Encode*: the words of a batch walk the automaton together, one byte a step;
   words it does not hold are merged by rank, leftmost first, as the file says.

The words come from the file's own normaliser and pre-tokeniser.  For texts of
Latin letters and common punctuation these are stated below as a pattern; all
other texts are given to the library for this part.

Defined results: NULL text counts as empty and has no ids, as an empty text or
one of white space; very long texts and words are whole (a long word is merged
in n log n steps); a special token's string in a text is that token; repeated
rows have equal results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re
import struct
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, ensure_checkpoint_dir, pieces
from .packing import _BYTE_SYMBOLS

LEXICON_WORDS = 65_536
LONGEST = 64  # bytes of a word of the lexicon
COUNTED_WORDS = 200_000  # distinct words a task counts before it hands them on
REMEMBERED_WORDS = 200_000  # of a task's batches; changes speed only
SHORT_WORD = 48  # symbols
NO_MERGE = 1 << 62
_WORK_CHARS = 1 << 20
_SYMBOL_BYTES = {v: k for k, v in _BYTE_SYMBOLS.items()}
#: Fixed value: the file's pattern, its classes written out for the texts that get here.
_L, _N, _S = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xffA-Z\xc0-\xd6\xd8-\xde\u0100-\u017f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
_WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")
_UNCOMMON = re.compile("[^\x00-\u012f\u0131-\u017f\u2010-\u2027]")  # lower case stays among these
_CODERS: dict[str, "Coder"] = {}
_NO_OUTPUT = (0, 0)


class Coder:
    """Words and merges of one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.tokens = {i: t.encode() for t, i in self.ids.items()} | {a["id"]: a["content"].encode() for a in spec["added_tokens"]}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.suffix = model["end_of_word_suffix"] or ""
        pairs = [(self.ids[a], self.ids[b], self.ids[a + b]) for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        self.rank = {(a, b): rank for rank, (a, b, _) in enumerate(pairs)}
        self.joined = [both for _, _, both in pairs]  # by rank
        self.inner = [self.ids[chr(_BYTE_SYMBOLS[x])] for x in range(256)]  # of a byte, and of a word's last byte
        self.last = [self.ids[chr(_BYTE_SYMBOLS[x]) + self.suffix] for x in range(256)]
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else None

    def words(self, text: str) -> list[str]:
        """The words of a text in order; special tokens are words of their own."""
        if self.split_special and len(parts := self.split_special(text)) > 1:
            return [w for k, part in enumerate(parts) for w in ([part] if k % 2 else self._plain(part))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if not _UNCOMMON.search(text):
            return _WORD.findall(text.lower())
        found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [w.translate(_SYMBOL_BYTES).encode("latin-1").decode() for w, _ in found]

    def merge(self, word: str) -> list[int]:
        """The ids of a word: the pair of least rank is merged first, of equal ones the leftmost."""
        if word in self.special:
            return [self.special[word]]
        data = word.encode()
        ids = [self.inner[x] for x in data[:-1]] + [self.last[data[-1]]]
        return self._merge_short(ids) if len(ids) <= SHORT_WORD else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        """Pair by pair, over a list of all pairs' ranks."""
        rank, joined = self.rank.get, self.joined
        ranks = [rank(p, NO_MERGE) for p in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < NO_MERGE:
            k = ranks.index(best)  # the leftmost of equal ones
            ids[k : k + 2] = [joined[best]]
            del ranks[k]
            if k:
                ranks[k - 1] = rank((ids[k - 1], ids[k]), NO_MERGE)
            if k < len(ranks):
                ranks[k] = rank((ids[k], ids[k + 1]), NO_MERGE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same over a heap of pairs, for words of any length."""
        rank, n = self.rank.get, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k) for k, p in enumerate(zip(ids, ids[1:])) if (r := rank(p)) is not None]
        heapq.heapify(heap)
        while heap:
            best, k = heapq.heappop(heap)
            right = after[k]
            if ids[k] < 0 or right >= n or rank((ids[k], ids[right])) != best:
                continue  # one of the two is gone or has grown
            ids[k], ids[right] = self.joined[best], -1
            after[k] = after[right]
            if after[k] < n:
                before[after[k]] = k
                if (r := rank((ids[k], ids[after[k]]))) is not None:
                    heapq.heappush(heap, (r, k))
            if (left := before[k]) >= 0 and (r := rank((ids[left], ids[k]))) is not None:
                heapq.heappush(heap, (r, left))
        return [i for i in ids if i >= 0]

    def decode(self, ids) -> bytes:
        """Tokens joined by spaces: what the library does for a file without a decoder."""
        return b" ".join([self.tokens[i] for i in ids])


def coder(path: str) -> Coder:
    """One per worker process and file."""
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def _common(a, b) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def compile_lexicon(entries: list[tuple[bytes, tuple[int, ...]]]) -> bytes:
    """The minimal transducer of sorted, distinct, non-empty words with their ids, as the bytes of :class:`Lexicon`.

    Words are added in order, so only the path of the word before can still
    change: what a new word does not share of it is frozen into the register."""
    register: dict[tuple, int] = {}
    path: list[list] = [[{}, None]]  # of the last word: arcs {byte: [target, output]} and the end's output
    last = b""

    def freeze(down_to: int):
        while len(path) - 1 > down_to:
            arcs, end = path.pop()
            key = (end, tuple((b, t, o) for b, (t, o) in arcs.items()))  # bytes come in ascending order
            path[-1][0][last[len(path) - 1]][0] = register.setdefault(key, len(register))

    for word, ids in entries:
        shared = _common(last, word)
        freeze(shared)
        for k in range(shared):  # ids move down as far as the new word needs
            arc, below = path[k][0][word[k]], path[k + 1]
            same = _common(arc[1], ids)
            rest, arc[1], ids = arc[1][same:], arc[1][:same], ids[same:]
            if rest:
                for a in below[0].values():
                    a[1] = rest + a[1]
                if below[1] is not None:
                    below[1] = rest + below[1]
        for k in range(shared, len(word)):
            path[-1][0][word[k]] = [-1, ids]
            ids = ()
            path.append([{}, None])
        path[-1][1] = ids
        last = word
    freeze(0)
    start, end = path[0][0], path[0][1]
    register[(end, tuple((b, t, o) for b, (t, o) in start.items()))] = first = len(register)

    outputs: dict[tuple, tuple[int, int]] = {(): _NO_OUTPUT}
    pool: list[int] = []

    def place(ids):
        if ids not in outputs:
            outputs[ids] = len(pool), len(ids)
            pool.extend(ids)
        return outputs[ids]

    keys, targets, arc_out, end_out = [], [], [], []
    for state, (end, arcs) in enumerate(register):
        end_out.append((-1, 0) if end is None else place(end))
        for b, target, out in arcs:
            keys.append(state * 256 + b)
            targets.append(target)
            arc_out.append(place(out))
    parts = [np.array(keys, "<i8"), np.array(targets, "<i4"), np.array(arc_out, "<i4").reshape(-1, 2), np.array(end_out, "<i4").reshape(-1, 2), np.array(pool, "<i4")]
    return struct.pack("<4q", first, len(keys), len(end_out), len(pool)) + b"".join(p.tobytes() for p in parts)


class Lexicon:
    """A compiled lexicon over any buffer (a mapped file, or bytes)."""

    def __init__(self, buffer):
        self.start, arcs, states, pool = struct.unpack_from("<4q", buffer)
        at = 32

        def part(kind: str, n: int):
            nonlocal at
            found = np.frombuffer(buffer, kind, n, at)
            at += found.nbytes
            return found

        self.keys, self.targets = part("<i8", arcs), part("<i4", arcs)
        self.arc_out, self.end_out = part("<i4", 2 * arcs).reshape(-1, 2), part("<i4", 2 * states).reshape(-1, 2)
        self.pool = part("<i4", pool)
        self.states = states

    def find(self, words: list[bytes]) -> list[tuple[int, ...] | None]:
        """The ids of each word, None for those that are not in the lexicon."""
        sizes = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        at = np.cumsum(sizes) - sizes
        state = np.where((sizes > 0) & (sizes <= LONGEST) & (len(self.keys) > 0), self.start, -1)
        owners, outs = [], []
        for step in range(min(int(sizes.max(initial=0)), LONGEST)):
            live = np.flatnonzero((state >= 0) & (sizes > step))
            if not len(live):
                break
            key = state[live] * 256 + data[at[live] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[arc] == key
            state[live] = np.where(hit, self.targets[arc], -1)
            said = hit & (self.arc_out[arc, 1] > 0)
            owners.append(live[said])
            outs.append(self.arc_out[arc[said]])
        end = np.where(state >= 0, self.end_out[np.maximum(state, 0), 0], -1) if self.states else state
        known = np.flatnonzero(end >= 0)
        last = self.end_out[state[known]]
        owners.append(known[last[:, 1] > 0])
        outs.append(last[last[:, 1] > 0])
        owner, out = np.concatenate(owners), np.concatenate(outs)
        order = np.argsort(owner, kind="stable")  # outputs of a word in the order of its arcs
        found: list = [None] * len(words)
        for k in known.tolist():
            found[k] = ()
        pool = self.pool
        for k, (a, n) in zip(owner[order].tolist(), out[order].tolist()):
            if found[k] is not None:
                found[k] += tuple(pool[a : a + n].tolist())
        return found


def map_file(name: str) -> Lexicon:
    """The lexicon file that Spark brought here, mapped into memory."""
    with open(SparkFiles.get(name), "rb") as f:
        return Lexicon(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))


def word_counts(df: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """``word, n`` of all words of at most ``LONGEST`` bytes in all rows."""

    def run(batches):
        read, counts = coder(tokenizer_path), Counter()

        def flush():
            rows = [(w, n) for w, n in counts.items() if len(w) <= LONGEST and len(w.encode()) <= LONGEST]
            counts.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], ["word", "n"])

        for b in pieces(batches, 0):
            for text in b.column(0).to_pylist():
                counts.update(read.words(text))
                if len(counts) > COUNTED_WORDS:
                    yield flush()
        if counts:
            yield flush()

    texts = df.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return texts.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(df: DataFrame, tokenizer_path: str, text_col: str = "text", size: int = LEXICON_WORDS) -> str:
    """Compile the lexicon of ``df`` and hand it to the executors; the name of the Spark file."""
    spark = df.sparkSession
    top = word_counts(df, tokenizer_path, text_col).orderBy(F.col("n").desc(), "word").limit(size).select("word").toArrow()  # `size` words of LONGEST bytes at most
    own = coder(tokenizer_path)
    automaton = compile_lexicon([(w, tuple(own.merge(w.decode()))) for w in sorted(w.encode() for w in top.column(0).to_pylist())])
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    place = f"{ensure_checkpoint_dir(spark)}/{name}"
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    out = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(path)
    out.write(automaton)
    out.close()
    spark.sparkContext.addFile(place)
    return name


class Encoder:
    """Encodes texts by a lexicon, and by merging where it has no word."""

    def __init__(self, own: Coder, lexicon: Lexicon):
        self.coder, self.lexicon = own, lexicon
        self.known: dict[str, tuple[bytes, bytes, tuple[int, ...]]] = {}  # decimal ids, decoded text, ids

    def learn(self, words: set[str]) -> None:
        new = sorted(words.difference(self.known))
        if len(self.known) + len(new) > REMEMBERED_WORDS:
            self.known.clear()
            new = sorted(words)
        for w, ids in zip(new, self.lexicon.find([w.encode() for w in new]), strict=True):
            ids = tuple(self.coder.merge(w)) if ids is None else ids
            self.known[w] = b" ".join([b"%d" % i for i in ids]), self.coder.decode(ids), ids

    def encode(self, texts: list[str]):
        """For each text its decimal ids and its decoded text, both as joined by spaces, and its words."""
        for lo, hi in chunks(texts, len, _WORK_CHARS):
            split = [self.coder.words(t) for t in texts[lo:hi]]
            self.learn(set().union(*split))
            known = self.known
            for words in split:
                found = [known[w] for w in words]
                yield b" ".join([f[0] for f in found]), b" ".join([f[1] for f in found]), found


def encode(df: DataFrame, tokenizer_path: str, lexicon: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Per row: ``doc_id, n_tokens, ids_sha256`` (of the decimal ids) and
    ``decoded_sha256`` and, if asked for, ``token_ids`` and ``decoded``."""
    shape = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>, decoded string" * with_ids
    names = [c.split()[0] for c in shape.split(", ")]

    def run(batches):
        work = Encoder(coder(tokenizer_path), map_file(lexicon))
        for b in pieces(batches, 1):
            counts, ids, texts, whole, decoded = [], [], [], [], []
            for decimal, text, found in work.encode(b.column(1).to_pylist()):
                counts.append(decimal.count(b" ") + 1 if decimal else 0)
                ids.append(hashlib.sha256(decimal).hexdigest())
                texts.append(hashlib.sha256(text).hexdigest())
                if with_ids:
                    whole.append([i for f in found for i in f[2]])
                    decoded.append(text.decode())
            columns = [b.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())]
            if with_ids:
                columns += [pa.array(whole, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, shape)


def decode(df: DataFrame, tokenizer_path: str, ids_col: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids (special tokens included)."""

    @F.pandas_udf("string")
    def text(ids):
        own = coder(tokenizer_path)
        return ids.map(lambda x: own.decode(x).decode(), na_action="ignore")

    return df.withColumn(decoded, text(F.col(f"`{ids_col}`")))


def digest(documents: DataFrame, tokenizer_path: str) -> DataFrame:
    return encode(documents, tokenizer_path, build_lexicon(documents, tokenizer_path), with_ids=False)
