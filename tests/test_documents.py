"""Manifest documents cut at entry boundaries by many tasks equal the one-task reader."""

import json
import os
import random
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from revspine.operators.extract import malformed_records
from revspine.schemas import CORRUPT, UNREADABLE
from revspine.sources import documents
from revspine.sources.documents import read_split_manifest, split_documents
from revspine.sources.raw import read_manifest
from revspine.sources.tables import export_json, export_json_array


@pytest.fixture()
def small_blocks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    for k, v in before.items():
        spark.conf.set(k, v)


def rows(df):
    return sorted((str(r.position), r.customer_id, r.subscription_id, r.amount, r[CORRUPT], str(r[UNREADABLE])) for r in df.collect())


def _document(seed, n):
    r = random.Random(seed)
    odd = ["x", 'a}b', '{"in":"text"}', 'quote " and \\ slash', "}{][,:", "", "é漢\n\t", "\\\\", '\\"}']

    def entry():
        if r.random() < 0.08:
            return r.choice([3, None, "lost", "lo}st", [1, {"a": 2}], True, "", 'q"}'])
        e = {"customer_id": r.choice(odd) + str(r.randrange(99)), "subscription_id": r.choice(odd), "amount": r.choice([5, "7", 8.0, "no}", None])}
        if r.random() < 0.3:
            e["extra"] = {"deep": [{"x": r.choice(odd)}, [{}]], "y": {}}
        return e

    return {"num_customers": n, "note": 'a } "customers":[ { b', "meta": {"x": {"y": [1, {}]}, "k": "customers"}, "clock_ids": ["c}", {"customers": [1]}, 2],
            "customers": [entry() for _ in range(n)], "other": [{"customer_id": "no"}, 4], "last": {"customers": [{"customer_id": "no"}]}}


def _cut(text, size):
    """The pieces of a document as the text reader deals them out over blocks of ``size`` bytes."""
    data = text.encode()
    ends = [i for i, c in enumerate(data) if c == ord("}")]
    out = []
    for start in [0] + [e + 1 for e in ends if e + 1 < len(data)]:
        end = next((e for e in ends if e >= start), len(data))
        out.append((data[start:end].decode(), "f", 0 if start == 0 else (start - 1) // size * size, len(data)))
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["value", "file", "block", "file_size"])


@pytest.mark.parametrize("size", [3, 7, 20, 50, 300, 10**6])
def test_entries_of_blocks_of_any_size(size):
    """The reader of a block alone, without Spark: all entries come out whole or in order of their parts."""
    for seed in range(40):
        doc = _document(seed, seed % 11)
        batch = _cut(json.dumps(doc, ensure_ascii=bool(seed % 2), indent=[None, 1][seed // 2 % 2]), size)
        starts, breaks = documents._starts([r for b in documents._summaries([batch]) for r in b.to_pylist()], False)
        assert breaks == {"f": False}
        rows = [r for b in documents._entries(SimpleNamespace(value=starts), "customers")([batch.select([0, 1, 2])]) for r in b.to_pylist()]
        scope, entries, part = "", [], None
        for block in sorted(b for _, b in starts):
            for r in (r for r in rows if r["block"] == block):
                mine = (scope if r["scope"] is None else r["scope"]) == "customers"
                if r["kind"] == "whole" and mine:
                    entries.append(r["text"])
                elif r["kind"] == "open":
                    part = [r["text"], mine]
                elif r["kind"] in ("through", "rest"):
                    part[0] += r["text"]
                    if r["kind"] == "rest" and part[1]:
                        entries.append(part[0])
                elif r["kind"] == "end":
                    scope = scope if r["scope"] is None else r["scope"]
        assert [json.loads(e) for e in entries] == doc["customers"]


@pytest.mark.parametrize("block", [500, 10**6])
def test_documents_equal_the_one_task_reader(spark, tmp_path, small_blocks, block):
    for k, indent in enumerate((None, 1)):
        (tmp_path / f"m{k}.json").write_text(json.dumps(_document(k, 20), indent=indent, ensure_ascii=bool(k)))
    (tmp_path / "n.json").write_text('{"customers": []}\n')
    small_blocks(block)
    assert rows(read_split_manifest(spark, str(tmp_path))) == rows(read_manifest(spark, str(tmp_path), lines=False))


def test_an_exported_array_is_one_document(spark, tmp_path, small_blocks):
    df = spark.range(0, 500, 1, 7).selectExpr("concat('c}', id) AS customer_id", "IF(id % 3 = 0, NULL, concat('s\"', id)) AS subscription_id", "id AS amount").where("amount > 90")
    export_json_array(df, str(tmp_path / "a"))
    names = sorted(f for f in os.listdir(tmp_path / "a") if f.startswith("part-"))
    whole = "".join((tmp_path / "a" / f).read_text() for f in names)
    assert len(names) > 3 and json.loads(whole) == [r.asDict() for r in df.collect()]
    export_json(df, str(tmp_path / "lines"))
    assert sorted(map(str, json.loads(whole))) == sorted(str(json.loads(x)) for f in os.listdir(tmp_path / "lines") if f.startswith("part-") for x in (tmp_path / "lines" / f).read_text().splitlines())
    export_json_array(df.where("amount < 0"), str(tmp_path / "none"))
    assert json.loads("".join((tmp_path / "none" / f).read_text() for f in sorted(os.listdir(tmp_path / "none")) if f.startswith("part-"))) == []
    export_json_array(df, str(tmp_path / "doc"), '{"customers":[', "]}")
    small_blocks(4000)
    got = read_split_manifest(spark, str(tmp_path / "doc"), one=True)
    assert [(r.position, r.customer_id, r.amount) for r in got.orderBy("position").collect()] == [(k - 91, f"c}}{k}", k) for k in range(91, 500)]


def test_a_failed_export_leaves_no_file(spark, tmp_path):
    df = spark.range(0, 100, 1, 4).withColumn("x", F.expr("IF(id = 77, CAST(raise_error('task lost') AS BIGINT), id)"))
    with pytest.raises(Exception, match="task lost"):
        export_json_array(df, str(tmp_path / "a"))
    left = [f for _, _, names in os.walk(tmp_path / "a") for f in names]
    assert left == []


def test_many_tasks_read_one_document(spark, tmp_path, small_blocks):
    n = 200_000
    with open(tmp_path / "m.json", "w") as f:  # on one line
        f.write('{"num_customers":0,"customers":[' + ",".join(f'{{"customer_id":"c{k % 977}","subscription_id":"s{k}"}}' for k in range(n)) + "]}")
    small_blocks(1 << 20)
    df = split_documents(spark, str(tmp_path / "m.json"))
    assert spark.read.option("lineSep", "}").text(str(tmp_path / "m.json")).rdd.getNumPartitions() >= 8
    got = read_split_manifest(spark, str(tmp_path / "m.json")).selectExpr("count(*) AS n", "count(DISTINCT position) AS d", "max(position) AS m", "count_if(subscription_id = concat('s', position)) AS same").first()
    assert tuple(got) == (n, n, n - 1, n) and df.where("damaged IS NOT NULL").count() == 0


@pytest.mark.parametrize("block", [80, 10**6])
def test_the_damaged_rest_is_reported(spark, tmp_path, small_blocks, block):
    small_blocks(block)
    whole = json.dumps({"customers": [{"customer_id": f"c{k}", "subscription_id": "s"} for k in range(6)]})
    cuts = {"entry": whole.index("c4") + 1, "string": whole.index('"c4"') + 2, "between": whole.index('{"customer_id": "c4"'), "end": len(whole) - 1, "brace": whole.index("}, {\"customer_id\": \"c4\"")}
    for name, at in cuts.items():
        folder = tmp_path / name
        folder.mkdir()
        (folder / "m.json").write_text(whole[:at])
        m = read_split_manifest(spark, str(folder))
        kept = sorted((r.position, r.customer_id) for r in m.where(f"{CORRUPT} IS NULL").collect())
        complete = {"entry": 4, "string": 4, "between": 4, "end": 6, "brace": 3}[name]
        assert kept == [(k, f"c{k}") for k in range(complete)], name
        lost = [r.record for r in malformed_records(m, "manifest").collect()]
        assert lost and all(r is not None for r in lost), name
        if name == "entry":
            assert "".join(lost) == whole[whole.index('{"customer_id": "c4"') : at] or block == 80


def test_documents_without_the_array(spark, tmp_path):
    for k, text in enumerate(["{}", "[]", '{"customers":{"customer_id":"x"}}', '{"customers":[]}']):
        (tmp_path / f"m{k}.json").write_text(text)
    m = read_split_manifest(spark, str(tmp_path))
    assert m.where(f"{CORRUPT} IS NULL").count() == 0
    assert sorted(r.record.partition(":")[0] for r in malformed_records(m, "manifest").collect()) == ["m0.json", "m1.json", "m2.json"]
