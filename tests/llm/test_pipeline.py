import re

import corpus_pipeline
import pytest
from helpers import SHAPE, components, documents, odd_rows, simhash
from test_decontaminate import brute
from test_packing import _check

from revspine.llm.common import table

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["language", "exact", "near", "clean", "pack"]


def test_run_matches_a_brute_force_version(spark):
    docs = sorted((r.doc_id, r.text) for r in table(spark, SF, "documents").collect())
    kept = [(i, t) for i, t in docs if re.search(r"[^\W\d_]", t or "")]  # every document with a letter is in one of the four languages
    first = {}
    for i, t in kept:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), i)
    kept = [(i, t) for i, t in kept if i in set(first.values())]
    least = components([i for i, _ in kept], [simhash(t) for _, t in kept])
    kept = [x for x, c in zip(kept, least, strict=True) if x[0] == c]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    leaked = {i for i, _ in brute(kept, items)}
    sizes = _check(corpus_pipeline.run(spark, SF).collect(), {i: t for i, t in kept if i not in leaked})
    assert sum(1024 - s for s in sizes) < 1024


def test_null_and_repeated_ids_through_all_stages(spark, tmp_path):
    """Different texts under one id, or under none, are documents of their own in every stage."""
    docs = table(spark, SF, "documents").select(*COLUMNS)
    texts = [r.text for r in docs.where("length(text) BETWEEN 600 AND 3000").orderBy("doc_id").limit(24).collect()]
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, t) for k, t in enumerate(texts)]
    rows += [(7, texts[0].upper()), (None, texts[1]), (None, texts[1] + " "), rows[0], rows[1]]
    made = documents(spark, rows).unionByName(docs.where("length(text) > 200 AND doc_id % 2 = 0"))
    made.write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, SF, "benchmark").write.parquet(f"{tmp_path}/benchmark.parquet")
    every = [(r.doc_id, r.text) for r in made.collect()]
    first = {}
    for i, t in sorted(every, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), (i, t))
    kept = list(first.values())
    groups = {}
    for row, c in zip(kept, components(list(range(len(kept))), [simhash(t) for _, t in kept]), strict=True):
        groups.setdefault(c, []).append(row)
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    leaked = {k for k, _ in brute([(k, g[0][1]) for k, g in enumerate(groups.values())], items)}
    clean = [g for k, g in enumerate(groups.values()) if k not in leaked]
    from test_packing import ids
    want = sorted(min((x is None, x or 0) for x, _ in g) for g in clean)
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    got = sorted((p.doc_id is None, p.doc_id or 0) for p in pieces if p.start == 0)
    assert len(got) == len(clean) and got == want
    assert sum(p.length for p in pieces) in {sum(x) for x in [[len(ids(g[0][1])) // 4 for g in clean]]} or all(len(g) > 1 for g in clean)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_every_stage_takes_odd_rows(spark, name, stage):
    for df in (documents(spark, odd_rows()), spark.createDataFrame([], SHAPE)):
        extra = df.selectExpr("*", "doc_id AS component_id", "text AS _text", "1 AS k", "lang AS _lang")
        out = stage(spark, extra, SF)
        if name != "packing":
            assert out.columns == extra.columns
        assert out.count() <= max(df.count(), 10**6)


def test_language_rejects_only_what_has_no_language(spark):
    df = table(spark, SF, "documents").select(*COLUMNS).unionByName(documents(spark, [(10**6, "12 34 ... !!"), (10**6 + 1, None), (10**6 + 2, "")]))
    gone = df.join(corpus_pipeline.language(spark, df, SF), "doc_id", "left_anti")
    assert {r.doc_id for r in gone.collect()} == {10**6, 10**6 + 1, 10**6 + 2}
