"""Summarise the physical plan of every registered query into docs/PLANS.md.

    python tools/plan_report.py [sf_dir]

For each query: scans (columns read, pushed filters), exchanges and their
partitioning, broadcasts, joins, windows and map-side limits, taken from
``explain("formatted")`` of the initial adaptive plan.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KEEP = ("Scan", "Exchange", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
        "BroadcastNestedLoopJoin", "Window", "WindowGroupLimit", "Generate", "HashAggregate", "SortAggregate",
        "ObjectHashAggregate", "Expand", "Union")


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def _clean(s: str) -> str:
    return re.sub(r"#\d+L?", "", s)


def _top_groups(s: str) -> list[str]:
    """Top-level ``[...]`` groups of an argument string."""
    out, depth, start = [], 0, None
    for i, ch in enumerate(s):
        if ch == "[":
            depth += 1
            if depth == 1:
                start = i + 1
        elif ch == "]":
            depth -= 1
            if depth == 0 and start is not None:
                out.append(s[start:i])
    return out


def summarise(text: str) -> list[str]:
    body = text.split("===== Subqueries =====")[0]
    tree, _, details = body.partition("\n\n")
    out = []
    for line in tree.splitlines():
        m = re.search(r"([A-Za-z]+(?: [A-Za-z]+)*)\s+\((\d+)\)", line)
        if not m or not any(m.group(1).startswith(k) for k in KEEP):
            continue
        node, num = m.group(1), m.group(2)
        indent = line[:m.start()].replace("+- ", "   ").replace(":- ", "   ")
        info = ""
        block = re.search(rf"\n\({num}\) [^\n]*\n(.*?)(?=\n\n|\Z)", details, re.S)
        if block:
            b = block.group(1)
            if node.startswith("Scan"):
                rs = re.search(r"ReadSchema: (.*)", b)
                pf = re.search(r"PushedFilters: (.*)", b)
                info = f" reads {rs.group(1) if rs else '?'}" + (f"; pushed {pf.group(1)}" if pf else "")
            elif "Exchange" in node:
                a = re.search(r"Arguments: (.*)", b)
                arg = _clean(a.group(1)) if a else ""
                info = " " + re.split(r", (?:ENSURE_REQUIREMENTS|REPARTITION_BY_NUM|\[plan_id)", arg)[0]
            elif node in ("HashAggregate", "SortAggregate", "ObjectHashAggregate"):
                k = re.search(r"Keys \[\d+\]: \[(.*?)\]", b)
                f = re.search(r"Functions \[\d+\]: \[(.*?)\]\n", b)
                partial = " partial" if f and "partial_" in f.group(1) else ""
                info = f"{partial} by [{re.sub(r'#[0-9L]+', '', k.group(1)) if k else ''}]"
            elif node.startswith("Window"):
                a = re.search(r"Arguments: (.*)", b)
                groups = _top_groups(a.group(1)) if a else []
                if node == "WindowGroupLimit" and groups:
                    info = f" per [{_clean(groups[0])}]"
                elif len(groups) >= 3 and groups[1]:
                    info = f" per [{_clean(groups[1])}]"
                elif len(groups) >= 2:
                    info = f" in one partition, ordered by [{_clean(groups[-1])}]"
        out.append(f"{indent}{node}{info}"[:220])
    return out


def real_inputs(spark, sf_dir) -> list[str]:
    """Plans over a stored table and real landing files, where filters and
    column pruning reach the scan (the fixtures derive their rows behind a generator)."""
    from revspine.operators.extract import rejects
    from revspine.plans.mrr import monthly_mrr
    from revspine.sources import fixtures as fx
    from revspine.sources.raw import read_raw_customers, read_raw_invoices, read_raw_subscriptions
    d = tempfile.mkdtemp(prefix="run-plans-")
    fx.subscriptions(spark, sf_dir).write.parquet(f"{d}/table")
    fx.manifest(spark, sf_dir).write.parquet(f"{d}/manifest")
    for name, df in (("subscriptions", fx.raw_subscription_lines(spark, sf_dir)), ("customers", fx.raw_customer_lines(spark, sf_dir)),
                     ("invoices", fx.raw_invoice_lines(spark, sf_dir))):
        df.write.text(f"{d}/{name}")
    plans = {"monthly_mrr (view) over a stored table": monthly_mrr(spark.read.parquet(f"{d}/table"), "view", fx.AS_OF),
             "rejects over landing files": rejects(spark.read.parquet(f"{d}/manifest"), read_raw_subscriptions(spark, f"{d}/subscriptions"),
                                                   read_raw_customers(spark, f"{d}/customers"), read_raw_invoices(spark, f"{d}/invoices"))}
    out = []
    for name, df in plans.items():
        out += [f"## {name}", "", "```"] + summarise(formatted(df)) + ["```", ""]
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from revspine.plans.registry import queries
    from revspine.session import build_session
    spark = build_session("local[8]", 8)
    lines = ["# Physical plans", "",
             f"Initial adaptive plans (`explain(\"formatted\")`) of the billing engine's registered queries on `{sf_dir}`, reduced",
             "to the operators that decide cost at scale. Generated by `tools/plan_report.py`; AQE may still",
             "coalesce partitions, split skewed joins or switch a join to broadcast at run time.", ""]
    for name, q in queries().items():
        text = formatted(q(spark, sf_dir))
        s = summarise(text)
        n_ex = sum("Exchange" in x and "Broadcast" not in x for x in s)
        n_bc = sum("BroadcastExchange" in x for x in s)
        lines += [f"## {name}", "", f"{n_ex} shuffle exchange(s), {n_bc} broadcast(s).", "", "```"] + s + ["```", ""]
    lines += real_inputs(spark, sf_dir)
    os.makedirs(os.path.join(ROOT, "docs"), exist_ok=True)
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
