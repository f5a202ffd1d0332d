import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import SHAPE, documents, odd_rows, repeats

from revspine.llm import queries
from revspine.llm.common import table
from revspine.llm.repeats import _contexts, _window_rows, covered, documents_of, remove_repeats, stretches, triggers


def _want(rows, length):
    texts = [(t or "").encode() for _, t, *_ in rows]
    out = []
    for (i, *_), t, mask in zip(rows, texts, repeats(texts, length), strict=True):
        kept = np.frombuffer(t, np.uint8)[~mask].tobytes()
        out.append((i, len(t), int(mask.sum()), int((np.diff(np.append(0, mask.astype(int))) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def _got(df, **options):
    return sorted((tuple(r) for r in remove_repeats(df, with_text=False, **options).collect()), key=repr)


def corpus(seed, alphabet="ab", docs=40):
    """Texts that share passages, are periodic, or differ in one byte."""
    r = random.Random(seed)
    passages = ["".join(r.choice(alphabet) for _ in range(r.randrange(20, 160))) for _ in range(6)]
    rows = []
    for i in range(docs):
        parts = [r.choice([r.choice(passages), "".join(r.choice("abcdefgh") for _ in range(r.randrange(60))), "x" * r.randrange(80), "ab" * r.randrange(40)]) for _ in range(r.randrange(1, 7))]
        text = "".join(parts)
        if text and i % 3 == 0:
            at = r.randrange(len(text))
            text = text[:at] + r.choice("aé") + text[at + 1 :]
        rows.append((i, text))
    return rows + [(docs, rows[0][1]), (docs + 1, rows[1][1] + "!")]


def test_triggers_are_the_first_least_hashes():
    r = random.Random(1)
    data = bytes(r.choice(b"abc") for _ in range(700))
    value = [int.from_bytes(data[k : k + 8], "little") * 0x9E3779B97F4A7C15 % 2**64 >> 32 for k in range(len(data) - 7)]
    for length in (8, 20, 50, 700):
        want = [min(range(p, p + length - 7), key=lambda k: (value[k], k)) for p in range(len(data) - length + 1)]
        assert triggers(data, length).tolist() == want


def test_stretches_hold_every_window_once(monkeypatch):
    monkeypatch.setattr("revspine.llm.repeats._WORK_BYTES", 97)
    r = random.Random(2)
    texts = [bytes(r.choice(b"abcde") for _ in range(n)) for n in (50, 51, 300, 77)]
    stop = np.cumsum([len(t) for t in texts])
    begin = np.append(0, stop[:-1])
    doc, low, high, core, end = stretches(b"".join(texts), begin, stop, 50, 16)
    windows = [p for a, e in zip(low, high, strict=True) for p in range(a, e + 1)]
    assert sorted(windows) == [p for a, e in zip(begin, stop, strict=True) for p in range(a, e - 49)]
    assert (high - low < 16).all() and (low + 50 >= end).all() and (high <= core).all() and (end > core).all()


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"group": 0}), (3, {"group": 1}), (4, {"reach": 16}), (5, {"reach": 8, "group": 2})])
def test_brute_force(spark, seed, options):
    rows = corpus(seed)
    assert _got(documents(spark, rows), length=40, **options) == _want(rows, 40)


def test_odd_rows(spark):
    rows = [(i, t[:3000] if t else t, *rest) for i, t, *rest in odd_rows()] + [(40, "é" * 300), (41, "z" * 399), (42, "z" * 399), (43, "y" * 401), (None, "q" * 500), (None, "q" * 500)]
    assert _got(documents(spark, rows)) == _want(rows, 400)
    assert remove_repeats(spark.createDataFrame([], SHAPE)).count() == 0


def test_missing_ids_do_not_share_names(spark):
    r = random.Random(7)
    rows = [(None, "".join(r.choice("abcdefgh") for _ in range(60))) for _ in range(20_000)]
    rows += [(None, t[:25] + "-" * 9 + t[:25]) for _, t in rows[:200]]
    docs = documents_of(documents(spark, rows), "doc_id", "text")
    assert docs.select("d", "t").distinct().count() == len({t for _, t in rows})
    assert _got(documents(spark, rows), length=20) == _want(rows, 20)


def test_entries_of_copies_are_taken_once():
    texts = {1: b"a" * 30, 2: b"b" * 30}
    batch = pa.RecordBatch.from_pylist([{"d": d, "t": 5, "text": t, "wanted": [{"k": 1, "pos": 0, "w": 2}], "id": d} for d, t in texts.items() for _ in range(50)])
    assert sum(b.num_rows for b in _contexts(20, 16)(iter([batch]))) == 2
    assert sum(b.num_rows for b in _window_rows(20)(iter([batch]))) == 2


def test_positions_of_copies_are_combined_before_the_shuffle(spark):
    rows = [(None, "".join(chr(97 + k * k % 23) for k in range(3000)))] * 50 + [(1, "short")] * 50
    df = documents(spark, rows)
    assert _got(df) == _want(rows, 400)
    plan = remove_repeats(df, with_text=False)._jdf.queryExecution().toString()
    assert "partial_collect_set(pos" in plan and "collect_list(pos" not in plan


def test_operator_gives_text_and_spans(spark):
    common = "".join(chr(97 + k * k % 23) for k in range(60))
    df = documents(spark, [(1, "head " + common + " tail"), (2, common)]).selectExpr("*", "doc_id AS d", "text AS t", "1 AS pos")
    rows = {r.doc_id: r for r in remove_repeats(df, length=30).collect()}
    assert bytes(rows[1].kept) == b"head  tail" and list(rows[1].spans) == [5, 65] and bytes(rows[2].kept) == b""


def test_covered():
    at = lambda p, n: p << 8 | n
    assert covered([at(0, 3), at(2, 0), at(13, 0), at(30, 1)], 10) == [(0, 23), (30, 41)]


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    assert sorted((tuple(r) for r in queries.op8_repeats(spark, sf).collect()), key=repr) == _want(rows, 400)
