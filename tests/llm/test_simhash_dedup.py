import random

import numpy as np
from helpers import SHAPE, components, documents, odd_rows, simhash

from revspine.llm import queries
from revspine.llm.common import table
from revspine.llm.components import connected_components
from revspine.llm.hashing import xxh64_slices
from revspine.llm.simhash_dedup import chain_ok, chain_choices, drop_near_duplicates, fingerprint_texts, forest, links, near_duplicates

import xxhash


def test_xxh64_of_slices():
    r = random.Random(1)
    buffer = bytes(r.randrange(256) for _ in range(3000))
    starts = np.array([r.randrange(2700) for _ in range(600)])
    lengths = np.array([r.choice([0, 1, 3, 4, 7, 8, 15, 31, 32, 33, 64, 95, 96, 97, 300]) for _ in range(600)])
    got = xxh64_slices(buffer, starts, lengths, 42)
    assert got.tolist() == [xxhash.xxh64_intdigest(buffer[a : a + n], 42) for a, n in zip(starts, lengths, strict=True)]


def test_fingerprints_follow_the_contract():
    texts = [t or "" for _, t, *_ in odd_rows()] + ["One two", "ONE TWO three", "İ Ä x\x85y \xa0 z", "a b c a b c a b c"]
    assert fingerprint_texts([t.encode() for t in texts]).tolist() == [simhash(t) for t in texts]


def test_chains_hold_for_every_pair_within_the_distance():
    assert chain_choices(3) == [(0, 1, 2, 3), (0, 1, 2, 4), (0, 1, 3, 4)] or set(chain_choices(3)) == {(0, 1, 2, 3), (0, 1, 2, 4), (0, 1, 3, 4)}
    r = random.Random(2)
    flips = [sum(1 << b for b in r.sample(range(64), n)) for n in (0, 1, 2, 3) for _ in range(3000)]
    assert chain_ok(np.array(flips, np.uint64), 3).all()
    far = np.array([sum(1 << b for b in r.sample(range(64), 32)) for _ in range(1000)], np.uint64)
    assert not chain_ok(far, 3).any()


def test_links_lose_none(spark):
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(60)]
    prints = sorted({b ^ sum(1 << k for k in r.sample(range(64), n)) for b in base for n in (0, 1, 2, 3, 4, 5) for _ in range(3)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = links(spark.createDataFrame([(p,) for p in signed], "fp long"), 3)
    found = {x.node: x.root for x in connected_components(edges).collect()}
    want = components(list(range(len(prints))), prints)
    got_groups, want_groups = {}, {}
    for k, p in enumerate(signed):
        got_groups.setdefault(found.get(p, p), set()).add(k)
        want_groups.setdefault(want[k], set()).add(k)
    assert sorted(map(sorted, got_groups.values())) == sorted(map(sorted, want_groups.values()))


def test_a_dense_bucket_gives_a_forest():
    r = random.Random(4)
    fps = np.unique(np.array([sum(1 << k for k in r.sample(range(24), r.randrange(4))) for _ in range(2000)], np.uint64))
    edges = forest(fps, 3)
    assert len(edges) == len(fps) - 1 and all(bin(a ^ b).count("1") <= 3 for a, b in edges)


def test_a_divided_bucket_has_the_same_components(monkeypatch):
    r = random.Random(5)
    centres = [r.getrandbits(32) for _ in range(40)]
    fps = np.unique(np.array([c ^ sum(1 << k for k in r.sample(range(32), r.randrange(4))) for c in centres for _ in range(12)], np.uint64))

    def groups(edges):
        up = {int(f): int(f) for f in fps}

        def root(x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in edges:
            assert bin(a ^ b).count("1") <= 3
            up[root(a)] = root(b)
        out = {}
        for f in up:
            out.setdefault(root(f), set()).add(f)
        return sorted(map(sorted, out.values()))

    whole = groups(forest(fps, 3))
    monkeypatch.setattr("revspine.llm.simhash_dedup.DIVIDED", 10)
    assert groups(forest(fps, 3)) == whole and len(whole) >= 30


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = {x.node: x.root for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: 0 for k in range(41)} | {k: 100 for k in range(100, 140)} | {k: 200 for k in range(200, 203)}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark):
    rows = odd_rows()
    got = near_duplicates(documents(spark, rows)).collect()
    prints = [simhash(t) for _, t, *_ in rows]
    want = [(i, f"{p:016x}", c) for (i, *_), p, c in zip(rows, prints, components([r[0] for r in rows], prints), strict=True)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert near_duplicates(spark.createDataFrame([], SHAPE)).count() == 0


def test_drop_near_duplicates_keeps_one_of_each_group(spark):
    df = documents(spark, [r for r in odd_rows() if r[0] is not None]).selectExpr("*", "doc_id AS component_id", "lang AS fp")
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {c for c in (x.component_id for x in near_duplicates(df).collect())}


def _texts():
    t = " ".join(f"w{k}" for k in range(60))
    return t, t.upper(), " ".join(f"v{k * k}" for k in range(60)), " ".join(f"u{k * 3}" for k in range(60))


def near_brute(rows):
    """The (id, text) rows that stay: of each component the least by id (None last), then by any fixed order of texts."""
    least = components(list(range(len(rows))), [simhash(t) for _, t in rows])
    groups = {}
    for row, c in zip(rows, least, strict=True):
        groups.setdefault(c, []).append(row)
    return [[r for r in g if (r[0] is None, r[0] or 0) == min((x is None, x or 0) for x, _ in g)] for g in groups.values()]


def test_rows_go_by_id_and_text(spark):
    t, same, u, v = _texts()
    cases = [[(3, t), (5, same), (5, u)], [(None, t), (None, same), (None, u)], [(5, t), (5, same), (5, u), (5, v)], [(1, u), (1, u), (1, u), (2, u), (None, u)],
             [(None, v), (None, v), (7, None), (7, ""), (8, " ")], [(9, t), (None, u), (None, u), (9, t), (4, v)]]
    for rows in cases:
        got = [(r.doc_id, r.text) for r in drop_near_duplicates(documents(spark, rows)).collect()]
        allowed = near_brute(rows)
        assert len(got) == len(allowed), rows  # one row of each component ...
        for group in allowed:
            assert sum(x in group for x in got) >= 1, rows  # ... and it is one of the least
    got = {(r.doc_id, r.text) for r in drop_near_duplicates(documents(spark, cases[0])).collect()}
    assert got == {(3, t), (5, u)}


def test_a_dense_bucket_in_slices(monkeypatch):
    monkeypatch.setattr("revspine.llm.simhash_dedup.TESTED", 7)
    test_a_dense_bucket_gives_a_forest()


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = sorted((r.doc_id, r.text) for r in table(spark, sf, "documents").collect())
    prints = [simhash(t) for _, t in docs]
    want = [(i, f"{p:016x}", c) for (i, _), p, c in zip(docs, prints, components([i for i, _ in docs], prints), strict=True)]
    assert sorted(map(tuple, queries.op10_simhash_dedup(spark, sf).collect())) == want
