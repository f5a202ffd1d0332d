import hashlib
import os
import re

from helpers import SHAPE, documents, odd_rows

from revspine.llm.exact_dedup import drop_duplicates, grace, membership

def _norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_membership_of_odd_rows(spark):
    rows = odd_rows()
    got = membership(documents(spark, rows), budget=20_000).collect()
    assert len(got) == len(rows)
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(_norm(t), []).append(i)
    want = []
    for i, t, *_ in rows:
        ids = [x for x in groups[_norm(t)] if x is not None]
        keep = min(ids) if ids else None
        want.append((i, keep, len(groups[_norm(t)]), i == keep, hashlib.sha256(_norm(t).encode()).hexdigest()))
    key = repr
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_membership_of_an_empty_table(spark):
    assert membership(spark.createDataFrame([], SHAPE)).count() == 0
    assert drop_duplicates(spark.createDataFrame([], SHAPE)).count() == 0


def test_drop_duplicates_keeps_whole_rows_and_clashing_columns(spark):
    df = documents(spark, odd_rows()).selectExpr("*", "doc_id AS keep_id", "named_struct('x', array(doc_id)) AS _row", "n_chars AS group_size", "lang AS _content")
    got = drop_duplicates(df, budget=20_000)
    assert got.columns == df.columns
    rows = got.collect()
    assert len(rows) == len({_norm(r[1]) for r in odd_rows()})
    assert all(r._row.x == [r.doc_id] and r.keep_id == r.doc_id for r in rows)
    by_text = {_norm(r.text): r.doc_id for r in rows}
    assert by_text["a"] == 4 and by_text["a b"] == 6 and by_text[""] == 1


def test_grace_spills_recursively_and_leaves_no_file(tmp_path, monkeypatch):
    monkeypatch.setattr("tempfile.tempdir", str(tmp_path))
    records = [(b"%d" % (k * 7 % 501) * 20, k, 1, None) for k in range(5000)]
    got = {e[0]: (e[1], e[2]) for e in grace(iter(records), budget=5_000, fanout=3)}
    want = {}
    for content, k, n, _ in records:
        first, total = want.get(content, (k, 0))
        want[content] = (min(first, k), total + n)
    assert got == want
    assert os.listdir(tmp_path) == []


def test_grace_of_one_content_larger_than_the_budget():
    assert [e[2] for e in grace(iter([(b"x" * 100_000, k, 1, None) for k in range(50)]), budget=1_000)] == [50]
