import zlib
from collections import Counter

from helpers import SHAPE, documents, odd_rows

from revspine.llm import queries
from revspine.llm.common import table
from revspine.llm.sharding import interleave, shard_digest


def _check(rows, shards=8):
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes[k] for k in range(shards)) <= 1
    for k in range(shards):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sizes[k]))
    return sizes


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    rows = queries.op7_sharding(spark, sf).collect()
    _check(rows)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)


def test_order_is_that_of_a_brute_force_version(spark):
    """Ranks within sources, one order by fractional rank, equal cuts."""
    docs = documents(spark, [(k, f"t{k}", "en", "abc"[k % 7 % 3] if k % 11 else None) for k in range(500)])
    rows = interleave(docs.select("doc_id", "source"), 5).collect()
    h = {r.doc_id: r.h for r in docs.selectExpr("doc_id", "xxhash64(17, doc_id) h").collect()}
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r.doc_id)
    place = []
    for s, ids in by.items():
        # hash ranges are ordered by their unsigned number, hashes within one as they are
        for rank, i in enumerate(sorted(ids, key=lambda i: ((h[i] % 2**64) >> 52, h[i]))):
            place.append(((2 * rank + 1) / (2 * len(ids)), "n" if s is None else "s" + s, i))
    want, n = {}, len(place)
    for pos, (_, _, i) in enumerate(sorted(place)):
        shard = pos * 5 // n
        want[i] = (shard, pos - (shard * n + 4) // 5)
    assert {r.doc_id: (r.shard, r.slot) for r in rows} == want


def test_every_shard_matches_the_mixture(spark):
    rows = interleave(documents(spark, [(k, "t", "en", "hot" if k % 3 else f"s{k % 5}") for k in range(900)]).select("doc_id", "source"), 6).collect()
    for source in {r.source for r in rows}:
        counts = Counter(r.shard for r in rows if r.source == source)
        assert max(counts.values()) - min(counts[k] for k in range(6)) <= 1


def test_odd_rows(spark):
    rows = shard_digest(documents(spark, odd_rows())).collect()
    assert len(rows) == len(odd_rows())
    _check(rows)
    assert sorted(r.size for r in rows) == sorted(len((t or "").encode()) + 1 for _, t, *_ in odd_rows())
    assert shard_digest(spark.createDataFrame([], SHAPE)).count() == 0


def test_rows_without_ids_do_not_share_a_range(spark):
    """NULL ids, and one id for all, are dealt out by their further columns."""
    for i in ("CAST(NULL AS BIGINT)", "CAST(5 AS BIGINT)"):
        df = documents(spark, [(k, f"text {k}") for k in range(2000)]).selectExpr(f"{i} AS doc_id", "text", "source")
        _check(shard_digest(df).collect())
        seen = interleave(df.selectExpr("doc_id", "source", "crc32(text) AS c"), 4, ties=["c"]).collect()
        assert [r.c for r in sorted(seen, key=lambda r: (r.shard, r.slot))] != sorted(r.c for r in seen)
    ranges = df.selectExpr("shiftrightunsigned(xxhash64(17, doc_id, text), 52) AS b").groupBy("b").count().agg({"count": "max"}).first()[0]
    assert ranges < 20


def test_columns_named_like_the_results(spark):
    df = documents(spark, [(k, "t") for k in range(20)]).selectExpr("doc_id", "source", "7 AS shard", "text AS slot")
    assert interleave(df, 3).columns == ["doc_id", "source", "shard", "slot"]
    _check(interleave(df, 3).collect(), 3)


def test_extra_columns_with_clashing_names(spark):
    df = documents(spark, [(k, "t") for k in range(20)]).selectExpr("doc_id", "source", "doc_id AS _h", "doc_id AS _rank", "doc_id AS c0")
    rows = interleave(df, 3).collect()
    assert all(r._h == r._rank == r.c0 == r.doc_id for r in rows)


def test_plan_is_native(spark):
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        queries.op7_sharding(spark, "/root/testdata/sf0.001").explain("formatted")
    assert not any(w in out.getvalue() for w in ("Python", "Pandas", "MapInArrow"))
