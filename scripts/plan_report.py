"""Summarise the physical plan of every registered query into PLANS.md.

usage: python scripts/plan_report.py [sf_dir] [out.md]
Per query: hash shuffles, broadcast exchanges, windows, sorts, Python stages, and for
each parquet scan the pushed filters and the columns read.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(plan: str) -> dict:
    scans = []
    for line in plan.splitlines():
        if "FileScan parquet" not in line and "Scan parquet" not in line:
            continue
        t = re.search(r"/(\w+)\.parquet", line)
        pf = re.search(r"PushedFilters: \[([^\]]*)\]", line)
        rs = re.search(r"ReadSchema: struct<([^>]*)>", line)
        scans.append((t.group(1) if t else "?", pf.group(1) if pf else "",
                      ",".join(c.split(":")[0] for c in rs.group(1).split(",")) if rs else ""))
    own = [ln for ln in plan.splitlines() if "ReusedExchange" not in ln]
    body = "\n".join(own)
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition",
                                   body)),
        "reused": plan.count("ReusedExchange"),
        "broadcasts": body.count("BroadcastExchange"),
        "windows": plan.count("Window ["),
        "sorts": plan.count("Sort ["),
        "python": len(re.findall(r"MapInPandas|ArrowEvalPython|FlatMapCoGroupsInPandas|BatchEvalPython", plan)),
        "scans": sorted(set(scans)),
    }


def main():
    from cdmspark.plans.catalog import QUERIES
    from cdmspark.session import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    spark = get_session("local[8]", 8)
    lines = ["# Physical plans (initial AQE plans)", "",
             f"Generated by `scripts/plan_report.py` on `{sf_dir}`. Shuffles = hash/range/single "
             "exchanges before AQE re-planning (AQE may turn a shuffle join into a broadcast at run "
             "time and coalesces partitions). Python = pandas-function operators. Operators that keep an "
             "intermediate table (see README) show the plan from that table on.", "",
             "| query | shuffles | reused | broadcasts | windows | sorts | python | scans: table [pushed filters] (columns read) |",
             "| --- | --- | --- | --- | --- | --- | --- | --- |"]
    for name, fn in QUERIES.items():
        if name.startswith("stream_visit"):
            lines.append(f"| {name} | (per micro-batch: the load_visit plan) | | | | | | orders stream |")
            continue
        df = fn(spark, sf_dir)
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        scans = "; ".join(f"{t} [{p}] ({c})" for t, p, c in s["scans"])
        lines.append(f"| {name} | {s['shuffles']} | {s['reused']} | {s['broadcasts']} | {s['windows']} | {s['sorts']} | "
                     f"{s['python']} | {scans} |")
        print(name, s["shuffles"], s["broadcasts"], file=sys.stderr)
    with open(out, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main()
