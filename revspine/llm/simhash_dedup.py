"""SimHash near-deduplication with pigeonring filtering.

A 64-bit fingerprint is cut into a ring of eight segments.  If two fingerprints
differ in at most ``tau`` bits, some segment starts a chain in which, for every
length l, the first l segments differ in at most floor(l * tau / 8) bits
together (the strong form of the pigeonring principle, Qin and Xiao, PVLDB
2018).  For tau = 3 the first five budgets are 0, 0, 1, 1, 1: two consecutive
segments agree and at most one of the next three differs.  So every
fingerprint is filed under each choice of agreeing segments of such a chain
(24 keys of 32 exact bits), pairs that meet must pass the whole chain test, and
only then comes the full Hamming check.

Only distinct fingerprints are filed (copies collapse first), and a bucket
emits a spanning forest of its links, never its pairs: all links of different
fingerprints are found, their components are exact, and output is linear.

Defined results: NULL text counts as empty; texts without words have
fingerprint zero and are linked like any other; fewer words than a shingle give
one shingle of the whole sequence; a NULL id gets its component's smallest
non-NULL id (NULL if there is none); repeated rows keep their rows (of a
component :func:`drop_near_duplicates` keeps one row); an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, column_bytes, cut, hot_join, pieces, text_bytes
from .components import connected_components
from .hashing import xxh64_slices

SEGMENTS = 8
CHAIN = 5  # segments of a chain that make a key
DIVIDED = 2048  # fingerprints of a bucket that is divided once more
TESTED = 65_536  # fingerprints that the chain test takes together
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_WORK_BYTES = 2 << 20


def _sums(hashes: np.ndarray) -> np.ndarray:
    total = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 65536):
        total += np.unpackbits(hashes[lo : lo + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return total


def fingerprint_texts(texts: list[bytes], width: int = 3, seed: int = 42) -> np.ndarray:
    """The fingerprint of each UTF-8 text: bit j is set when it is set in over
    half of the XXH64 values of its word shingles."""
    out = np.zeros(len(texts), np.uint64)
    for lo, hi in chunks(texts, len, _WORK_BYTES):
        # bytes.split() without arguments splits at exactly space, tab, LF, VT, FF and CR
        words = [t.translate(_LOWER).split() for t in texts[lo:hi]]
        counts = np.array([len(w) for w in words], np.int64)
        buffer = b" ".join(b" ".join(w) for w in words if w)
        if not buffer:
            continue
        gaps = np.flatnonzero(np.frombuffer(buffer, np.uint8) == 32)
        starts, ends = np.append(0, gaps + 1), np.append(gaps, len(buffer))
        first = np.cumsum(counts) - counts
        shingles = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
        at = np.cumsum(shingles) - shingles
        word = np.arange(shingles.sum()) - np.repeat(at - first, shingles)
        last = word + np.repeat(np.minimum(counts, width), shingles) - 1
        hashes = xxh64_slices(buffer, starts[word], ends[last] - starts[word], seed)
        sums = np.array([_sums(hashes[a : a + n]) for a, n in zip(at.tolist(), shingles.tolist())])
        out[lo:hi] = np.packbits(2 * sums > shingles[:, None], axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprints(df: DataFrame, id_col: str, text_col: str, width: int = 3, seed: int = 42, with_hash: bool = False) -> DataFrame:
    """``id, fp`` (the 64 bits as a signed long) for every row and, if asked for,
    ``th``, a hash of the text."""

    def run(batches):
        for b in pieces(batches, 1):
            fp = pa.array(fingerprint_texts(column_bytes(b.column(1)), width, seed).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), fp, *b.columns[2:]], ["id", "fp", "th"][: 2 + with_hash])

    columns = [F.col(f"`{id_col}`").cast("bigint").alias("id"), text_bytes(text_col).alias("text")] + [F.xxhash64(text_bytes(text_col)).alias("th")] * with_hash
    return df.select(*columns).mapInArrow(run, "id bigint, fp bigint" + ", th bigint" * with_hash)


def budgets(tau: int, segments: int = SEGMENTS) -> list[int]:
    return [length * tau // segments for length in range(1, segments + 1)]


def chain_choices(tau: int, chain: int = CHAIN) -> list[tuple[int, ...]]:
    """Segments, counted from the start of a chain, that agree in any chain
    which keeps its budgets: one choice per maximal set of differing ones."""
    limit = budgets(tau)
    if limit[chain - 1] >= chain:
        raise ValueError(f"{tau} bits leave no agreeing segment in a chain of {chain}")
    out = []
    for apart in combinations(range(chain), limit[chain - 1]):
        if all(sum(x < length for x in apart) <= limit[length - 1] for length in range(1, chain + 1)):
            out.append(tuple(x for x in range(chain) if x not in apart))
    return out


def _keys(tau: int):
    """The ring's chain keys of column ``fp`` as an array of longs (built-in functions only)."""
    sets = {tuple(sorted((start + x) % SEGMENTS for x in choice)) for start in range(SEGMENTS) for choice in chain_choices(tau)}
    out = []
    for segments in sorted(sets):
        mask = sum(0xFF << (8 * s) for s in segments)
        mask -= (mask >> 63) << 64
        out.append(F.struct(F.lit(sum(1 << s for s in segments)).alias("s"), F.col("fp").bitwiseAND(F.lit(mask).cast("bigint")).alias("k")))
    return F.array(*out)


def chain_ok(x: np.ndarray, tau: int) -> np.ndarray:
    """Whether some start of the ring keeps every budget, for XORed fingerprints."""
    bits = np.bitwise_count(x.astype("<u8").view(np.uint8).reshape(-1, SEGMENTS)).astype(np.int16)
    sums = np.cumsum(np.concatenate([bits, bits], axis=1), axis=1, dtype=np.int16)
    ok = np.zeros(len(x), bool)
    for start in range(SEGMENTS):
        run = sums[:, start : start + SEGMENTS] - (sums[:, start - 1 : start] if start else 0)
        ok |= (run <= np.array(budgets(tau))).all(1)
    return ok


def linked(x: np.ndarray, tau: int) -> np.ndarray:
    """Pigeonring first, the full Hamming check on what is left."""
    ok = chain_ok(x, tau)
    ok[ok] = np.bitwise_count(x[ok]) <= tau
    return ok


def forest(fps: np.ndarray, tau: int) -> list[tuple[int, int]]:
    """Links among distinct fingerprints, at most SEGMENTS per node, with the
    same components as all links.

    Where a large bucket's fingerprints still differ in more than ``tau``
    segments, linked ones agree in one of those, so the bucket is divided by
    each of them; a bucket that can't be divided is searched as it is."""
    if len(fps) > DIVIDED:
        differ = np.bitwise_or.reduce(fps ^ fps[0])
        apart = [s for s in range(SEGMENTS) if int(differ) >> (8 * s) & 0xFF]
        if len(apart) > tau:
            edges = []
            for s in apart:
                value = (fps >> np.uint64(8 * s)) & np.uint64(0xFF)
                order = np.argsort(value, kind="stable")
                for part in np.split(fps[order], np.flatnonzero(np.diff(value[order])) + 1):
                    edges += _search(part, tau)
            return edges
    return _search(fps, tau)


def _search(rest: np.ndarray, tau: int) -> list[tuple[int, int]]:
    """A spanning forest of the links: every node is compared with those not
    reached yet, so a dense bucket is done in few steps."""
    edges = []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            node = queue.pop()
            near = np.concatenate([linked(rest[lo : lo + TESTED] ^ node, tau) for lo in range(0, len(rest), TESTED)])
            found, rest = rest[near], rest[~near]
            edges += [(int(node), int(f)) for f in found]
            queue += list(found)
    return edges


class _Union:
    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        path = []
        while (y := up.setdefault(x, x)) != x:
            path.append(x)
            x = y
        for p in path:
            up[p] = x
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def _links_in_partition(tau: int):
    """mapInArrow function over rows ``s, k, fp`` sorted by (s, k): a spanning
    forest of all links that the partition's buckets hold, as (a, b)."""

    def run(batches):
        union = _Union()

        def bucket(fps):
            for a, b in forest(np.unique(fps), tau):
                union.join(a, b)

        held = np.empty(0, np.uint64)
        last = None
        for b in batches:
            s, k, fp = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            fp = fp.astype(np.int64).view(np.uint64)
            if not len(fp):
                continue
            new = np.append(True, (s[1:] != s[:-1]) | (k[1:] != k[:-1]))
            if last is not None and (s[0], k[0]) == last:
                new[0] = False
            cuts = np.flatnonzero(new)
            parts = np.split(fp, cuts)
            held = np.concatenate([held, parts[0]])
            if len(cuts):
                if len(held) > 1:
                    bucket(held)
                sizes = np.diff(np.append(cuts, len(fp)))
                two = cuts[:-1][sizes[:-1] == 2]
                x = fp[two] ^ fp[two + 1]
                for i in two[linked(x, tau) & (x != 0)].tolist():
                    union.join(int(fp[i]), int(fp[i + 1]))
                for c, n in zip(cuts[:-1].tolist(), sizes[:-1].tolist()):
                    if n > 2:
                        bucket(fp[c : c + n])
                held = parts[-1]
            last = (s[-1], k[-1])
        if len(held) > 1:
            bucket(held)
        nodes = [x for x in union.up if union.root(x) != x]
        for lo in range(0, len(nodes), 100_000):
            a = np.array(nodes[lo : lo + 100_000], np.uint64).view(np.int64)
            c = np.array([union.root(x) for x in nodes[lo : lo + 100_000]], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(c)], ["a", "b"])

    return run


def links(distinct: DataFrame, tau: int = 3) -> DataFrame:
    """Edges ``a, b`` whose components are those of the link graph of the
    distinct fingerprints in column ``fp``."""
    filed = distinct.select(F.explode(_keys(tau)).alias("x"), "fp").select("x.s", "x.k", "fp")
    return filed.repartition("s", "k").sortWithinPartitions("s", "k").mapInArrow(_links_in_partition(tau), "a bigint, b bigint")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, tau: int = 3, seed: int = 42) -> DataFrame:
    """Per row: id, ``fingerprint`` (hex), ``component_id`` (smallest id of all
    rows reachable over links of at most ``tau`` differing bits)."""
    rows = cut(fingerprints(df, id_col, text_col, width, seed))  # 16 bytes a row; the texts are read once
    distinct = rows.groupBy("fp").agg(F.min("id").alias("low"))
    roots = connected_components(links(distinct.select("fp"), tau)).withColumnRenamed("node", "fp")
    placed = distinct.join(roots, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    named = hot_join(placed, least, ["root"]).select("fp", "component_id")
    return hot_join(rows, named, ["fp"]).select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, tau: int = 3) -> DataFrame:
    """One row of ``df`` per component: the one with the smallest id (NULL ids
    last), of equal ids the one with the smallest text hash, of rows that repeat
    both any one.  Rows are told apart by id and text, never by id alone, so
    different texts that share an id, or have none, are documents of their own.

    Only what goes is joined with the texts: the rows that lose in their
    component, and the few whose id and text are there more than once."""
    named = fingerprints(df, id_col, text_col, width, with_hash=True)
    keys = cut(named.groupBy("id", "th", "fp").agg(F.count(F.lit(1)).alias("copies")))
    distinct = keys.select("fp").distinct()
    roots = connected_components(links(distinct, tau)).withColumnRenamed("node", "fp")
    placed = cut(hot_join(keys, distinct.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root")), ["fp"]))
    first = F.row_number().over(Window.partitionBy("root").orderBy(F.col("id").asc_nulls_last(), "th"))  # limited before the shuffle
    best = placed.select("root", "id", "th", first.alias("_rank")).where("_rank = 1").select("root", F.col("id").alias("_id"), F.col("th").alias("_th"))
    wins = F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))
    marked = cut(hot_join(placed, best, ["root"]).withColumn("_wins", wins).where(~F.col("_wins") | (F.col("copies") > 1)).select("id", "th", "_wins"))

    names = df.columns
    rows = df.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)], F.col(f"`{id_col}`").cast("bigint").alias("_row_id"), F.xxhash64(text_bytes(text_col)).alias("_row_th"))
    same = F.col("_row_id").eqNullSafe(F.col("id")) & (F.col("_row_th") == F.col("th"))
    kept = rows.join(marked, same, "left_anti")
    repeated = marked.where("_wins").select("id", "th")
    if not repeated.isEmpty():
        one = F.row_number().over(Window.partitionBy("_row_id", "_row_th").orderBy("_row_th"))
        kept = kept.unionByName(rows.join(repeated, same, "left_semi").withColumn("_one", one).where("_one = 1").drop("_one"))
    return kept.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(names)])
