"""One parse and one write per source, counts from the write."""

import json
import os
import subprocess
import sys
import tempfile

import pytest
from pyspark.sql import functions as F

from revspine.operators.extract import broken_lines, records
from revspine.plans.etl import etl_full_refresh
from revspine.schemas import BROKEN, CORRUPT, RAW_CUSTOMER
from revspine.sources.raw import parse_json
from revspine.sources.staging import stage_source, write_counted

NOW = "2024-01-01 00:00:00"


def _landing(folder, **sources):
    for name, lines in sources.items():
        os.makedirs(os.path.join(folder, name))
        with open(os.path.join(folder, name, "part-0.json"), "w") as f:
            f.write("".join((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines))
    return str(folder)


@pytest.fixture()
def db(spark):
    warehouse = tempfile.mkdtemp(prefix="revspine-wh-")
    name = "staging_" + os.path.basename(warehouse).replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{warehouse}'")
    return name


def test_good_and_broken_are_written_apart(spark, tmp_path):
    texts = [(json.dumps({"id": f"c{k}", "name": {"x": 1} if k == 3 else "n"}),) for k in range(10)] + [("{",), ("3",)]
    staged = stage_source(parse_json(spark.createDataFrame(texts, "value string").repartition(3), RAW_CUSTOMER), str(tmp_path / "s"))
    assert staged.counts == {"rows": 12, "broken": 2, "unreadable": 1}
    assert sorted(d for d in os.listdir(tmp_path / "s") if "=" in d) == [f"{BROKEN}=false", f"{BROKEN}=true"]
    assert records(staged.rows).count() == 10 and {r[CORRUPT] for r in broken_lines(staged.rows).collect()} == {"{", "3"}
    plan = broken_lines(staged.rows)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(_broken" in plan  # only the files of broken lines are opened


def test_counts_of_empty_and_filtered_writes(spark, tmp_path):
    df = spark.range(10)
    assert write_counted(df.limit(0), str(tmp_path / "a"), rows=F.count(F.lit(1)), odd=F.count_if(F.col("id") % 2 == 1)) == {"rows": 0, "odd": 0}
    assert write_counted(df.where("id > 6"), str(tmp_path / "b"), rows=F.count(F.lit(1)), odd=F.count_if(F.col("id") % 2 == 1)) == {"rows": 3, "odd": 2}


def test_a_load_stores_what_it_left_out(spark, db, tmp_path):
    land = _landing(tmp_path / "l", manifest=[{"position": 0, "customer_id": "c", "subscription_id": "s"}, {"position": 1, "customer_id": "c", "subscription_id": "no"}, '{"position":'],
                    subscriptions=[{"id": "s", "created": "soon"}, "{"], customers=[{"id": "c", "name": ["x"]}], invoices=[{"id": "i", "customer": "c", "amount_due": "5.0"}, {"id": "i", "customer": "c", "amount_due": "?"}, "x"])
    loaded = etl_full_refresh(spark, land, db, now=NOW)
    assert loaded == {"subscriptions": 1, "invoices": 1}
    assert loaded.rejected == {"subscriptions": 2, "invoices": 1, "manifest": 1} and loaded.violations == 3
    assert loaded.parsed["invoices"] == {"rows": 3, "broken": 1, "unreadable": 1}
    got = {(r.load, r.position, r.reason, r.record) for r in spark.table(f"{db}.load_rejects").collect()}
    assert got == {("subscriptions", 1, "subscription not found", None), ("subscriptions", None, "malformed", "{"), ("invoices", None, "malformed", "x"), ("manifest", None, "malformed", '{"position":')}
    assert {(r.record_id, r.field, r.value) for r in spark.table(f"{db}.load_violations").collect()} == {("s", "created", "soon"), ("c", "name", '["x"]'), ("i", "amount_due", "?")}
    assert {r.table_name: (r.rows_fetched, r.rows_loaded, r.rows_rejected) for r in spark.table(f"{db}.load_summary").collect()} == {"subscriptions": (1, 1, 2), "invoices": (2, 1, 1), "manifest": (0, 0, 1)}
    root = spark.sql(f"DESCRIBE DATABASE {db}").filter("info_name = 'Location'").first()["info_value"].removeprefix("file:")
    assert not [f for f in os.listdir(root) if f.startswith("_staging")]  # staged sources go when the load ends
    again = etl_full_refresh(spark, _landing(tmp_path / "ok", manifest=[{"position": 0, "customer_id": "c", "subscription_id": "s"}], subscriptions=[{"id": "s"}], customers=[{"id": "c"}], invoices=[{"id": "i", "customer": "c"}]), db, now=NOW)
    assert again.rejected == {"subscriptions": 0, "invoices": 0, "manifest": 0} and spark.table(f"{db}.load_rejects").count() == 0  # a clean load leaves no old rejects


_LOGGED = """
import json, os, sys, glob
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
log = {log!r}
SparkSession.builder.master("local[2,4]").config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://" + log).config("spark.ui.enabled", "false").config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false").config("spark.sql.warehouse.dir", {warehouse!r}).config("spark.sql.shuffle.partitions", "2").getOrCreate()
from revspine.session import build_session
spark = build_session()
from pyspark import TaskContext
from pyspark.sql import functions as F
from revspine.sources.staging import write_counted
import pyarrow as pa
def once(batches):
    for n, b in enumerate(batches):
        yield b
    if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 1:
        raise RuntimeError("lost after all rows")
counts = write_counted(spark.range(0, 1000, 1, 4).mapInArrow(once, "id bigint"), {warehouse!r} + "/retried", rows=F.count(F.lit(1)), odd=F.count_if(F.col("id") % 2 == 1))
from revspine.plans.etl import etl_full_refresh
spark.sql("CREATE DATABASE wh LOCATION '" + {warehouse!r} + "/wh'")
loaded = etl_full_refresh(spark, {landing!r}, "wh", now="2024-01-01 00:00:00")
spark.stop()
reads = {{}}
for path in glob.glob(log + "/*"):
    for line in open(path):
        e = json.loads(line)
        if e["Event"] == "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart":
            stack = [e["sparkPlanInfo"]]
            while stack:
                node = stack.pop()
                stack += node["children"]
                where = str(node.get("metadata", {{}}).get("Location", ""))
                for name in ("manifest", "subscriptions", "customers", "invoices"):
                    if node["nodeName"].startswith("Scan text") and {landing!r} + "/" + name in where:
                        reads[name] = reads.get(name, 0) + 1
print("RESULT" + json.dumps([counts, dict(loaded), reads]))
"""


def test_event_log_shows_one_parse_per_source_and_retries_count_once(tmp_path):
    """A session of its own: tasks may fail there, and it writes an event log."""
    land = _landing(tmp_path / "land", manifest=[{"position": k, "customer_id": f"c{k % 3}", "subscription_id": f"s{k}"} for k in range(20)], subscriptions=[{"id": f"s{k}"} for k in range(20)] + ["{"],
                    customers=[{"id": f"c{k}"} for k in range(3)], invoices=[{"id": f"i{k}", "customer": f"c{k % 4}"} for k in range(40)])
    os.makedirs(tmp_path / "log")
    code = _LOGGED.format(repo=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), log=str(tmp_path / "log"), warehouse=str(tmp_path / "wh"), landing=land)
    out = subprocess.run(["timeout", "300", sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path)
    assert "RESULT" in out.stdout, out.stderr[-3000:]
    counts, loaded, reads = json.loads(out.stdout.rpartition("RESULT")[2])
    assert counts == {"rows": 1000, "odd": 500}  # the task that failed after its rows ran again
    assert loaded == {"subscriptions": 20, "invoices": 30}
    assert reads == {"manifest": 1, "subscriptions": 1, "customers": 1, "invoices": 1}
