import random
from collections import Counter

import numpy as np
import pytest
from helpers import SHAPE, documents, odd_rows

from revspine.llm import queries
from revspine.llm.common import table
from revspine.llm.decontaminate import RADIUS, Items, decontaminate, leaks, simhash, words_of

ITEMS = "item_id long, text string"


def sim(a, b):
    """Weighted Jaccard similarity of two lists."""
    a, b = Counter(a), Counter(b)
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def brute(docs, items):
    """Best item-sized span of every document and item, 0.8 and above."""
    shingles = lambda t: [tuple(w[k : k + 5]) for w in [words_of((t or "").encode())] for k in range(len(w) - 4)]
    out = {}
    for j, item in items:
        own = shingles(item)
        for i, text in docs:
            all_ = shingles(text)
            n = min(len(own), len(all_))
            if not n or not set(own) & set(all_):
                continue
            best = max(sim(own, all_[k : k + n]) for k in range(len(all_) - n + 1))
            if best >= 0.8:
                out[i, j] = best
    return out


def _text(r, n):
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randrange(1, 9))) for _ in range(n))


def test_planted_items_are_found_and_clean_documents_left(spark):
    r = random.Random(11)
    items = [(j, _text(r, n)) for j, n in enumerate([5, 6, 9, 12, 16, 20, 31, 47, 64, 90, 300])]
    docs = []
    for i in range(120):
        body = [_text(r, r.randrange(1, 200)) for _ in range(3)]
        if i % 2 == 0:
            body.insert(1, items[i // 2 % len(items)][1])
        text = " ".join(body)
        docs.append((i, text.upper() if i % 3 == 0 else text.replace(" ", ", ") if i % 5 == 0 else text))
    docs += [(500 + j, t) for j, t in items]  # a document may be just the item
    got = {(x.doc_id, x.item_id): x.similarity for x in leaks(documents(spark, docs), spark.createDataFrame(items, ITEMS)).collect()}
    want = brute(docs, items)
    assert set(got) == set(want) and len(want) == 60 + len(items)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)
    kept = decontaminate(documents(spark, docs), spark.createDataFrame(items, ITEMS))
    assert {x.doc_id for x in kept.collect()} == {i for i, _ in docs} - {i for i, _ in want}


def test_documents_shorter_than_an_item(spark):
    r = random.Random(15)
    items = [(j, _text(r, n)) for j, n in enumerate([9, 10, 14, 20, 29, 31, 35, 36, 60, 100, 200])]
    docs = []
    for j, text in items:
        words = text.split()
        n = len(words) - 4
        for cut in {n - 1, -(-9 * n // 10), -(-17 * n // 20), -(-4 * n // 5), n // 2}:
            docs += [(1000 * j + cut, " ".join(words[: cut + 4])), (1000 * j + 500 + cut, " ".join(words[n - cut :]))]
    docs += [(10**6 + j, t + " more") for j, t in items]
    docs += [(10**7, " ".join(items[9][1].split()[:86]) + " " + _text(r, 8))]  # 0.8 of its head only
    want = brute(docs, items)
    assert len(want) > 60 and (10**7, 9) not in want
    block, (a, b) = Items({j: t.encode() for j, t in items}), (_text(r, 3000).encode() for _ in range(2))
    for around in ([], [a, b]):  # alone, and between longer texts
        got = {}
        for i, t in docs:
            hits = block.search([*around[:1], t.encode(), *around[1:]])[len(around[:1])]
            got |= {(i, j): h[0] for j, h in hits.items()}
        assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    frame = documents(spark, docs[:40]).repartition(40)
    kept = decontaminate(frame, spark.createDataFrame(items, ITEMS))
    assert {x.doc_id for x in kept.collect()} == {i for i, _ in docs[:40]} - {i for i, _ in want}


def test_blocks_name_every_item_within_the_radius():
    r = random.Random(12)
    items = Items({k: _text(r, 30).encode() for k in range(40)})
    for group in items.groups:
        own = group[2]
        prints = np.array([int(o) ^ sum(1 << b for b in r.sample(range(64), r.randrange(0, RADIUS + 4))) for o in own for _ in range(50)], np.uint64)
        at, which = items.candidates(prints, group)
        want = {(i, n) for i, p in enumerate(prints) for n, o in enumerate(own) if bin(int(p) ^ int(o)).count("1") <= RADIUS}
        assert set(zip(at.tolist(), which.tolist(), strict=True)) == want


def test_windows_are_simhashes_of_their_shingles():
    r = random.Random(13)
    h = np.array([r.getrandbits(64) for _ in range(9)], np.uint64)
    assert int(simhash(h)) == sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in h) > 9)


@pytest.mark.parametrize("block", [1, 3])
def test_items_in_several_blocks(spark, monkeypatch, block):
    monkeypatch.setattr("revspine.llm.decontaminate.BLOCK_ITEMS", block)
    r = random.Random(14)
    items = [(j, _text(r, 25)) for j in range(5)]
    docs = [(i, _text(r, 30) + " " + items[i % 5][1]) for i in range(10)] + [(99, _text(r, 100))]
    df, bench = documents(spark, docs), spark.createDataFrame(items, ITEMS)
    assert {(x.doc_id, x.item_id) for x in leaks(df, bench).collect()} == {(i, i % 5) for i in range(10)}
    assert [x.doc_id for x in decontaminate(df, bench).collect()] == [99]


@pytest.mark.parametrize("block", [2, 1024])
def test_items_that_share_an_id(spark, monkeypatch, block):
    monkeypatch.setattr("revspine.llm.decontaminate.BLOCK_ITEMS", block)
    r = random.Random(16)
    texts = [_text(r, 25) for _ in range(7)]
    bench = spark.createDataFrame(list(zip([1, 1, 1, None, None, None, 2], texts, strict=True)) + [(1, texts[0])], ITEMS)
    docs = [(i, _text(r, 30) + " " + t) for i, t in enumerate(texts)] + [(90, texts[0] + " " + _text(r, 9) + " " + texts[2]), (99, _text(r, 100))]
    got = [(x.doc_id, x.item_id) for x in leaks(documents(spark, docs + docs[:1]), bench).collect()]
    assert Counter(got) == Counter([(0, 1), (0, 1), (1, 1), (2, 1), (3, None), (4, None), (5, None), (6, 2), (90, 1)])
    assert [x.doc_id for x in decontaminate(documents(spark, docs), bench).collect()] == [99]


def test_odd_rows_and_items(spark):
    df = documents(spark, odd_rows()).selectExpr("*", "doc_id AS item_id", "doc_id AS c1")
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "too short item"), (None, "one two three four five six"), (4, " ".join(f"w{k}" for k in range(50, 80))), (5, " ".join(f"w{k}" for k in range(50, 80)))], ITEMS)
    assert {(x.doc_id, x.item_id) for x in leaks(df, odd).collect()} == {(7, 4), (7, 5), (8, 4), (8, 5)}
    assert decontaminate(df, odd).columns == df.columns and decontaminate(df, odd).count() == len(odd_rows()) - 2
    none = spark.createDataFrame([], ITEMS)
    assert leaks(df, none).count() == 0 and decontaminate(df, none).count() == len(odd_rows())
    assert leaks(spark.createDataFrame([], SHAPE), odd).count() == 0


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    got = {(x.doc_id, x.item_id): x.similarity for x in queries.op6_decontamination(spark, sf).collect()}
    want = brute(docs, items)
    assert set(got) == set(want) and len(want) > 20 and all(abs(got[k] - want[k]) < 1e-9 for k in got)
