"""Regenerate docs/PLANS.md from scripts/explain_plans.py output.

Usage: python scripts/plans_doc.py [sf_dir]
"""

from __future__ import annotations

import os
import subprocess
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(HERE)

INTRO = """# Plan review

Generated by `python scripts/plans_doc.py` from `scripts/explain_plans.py`
(plan facts per registered query: pushed filters, read schemas, shuffle
exchanges, join strategies, Python stages, window-group limits) and the
formatted plan of the flagship query.  No query falls back from whole-stage
codegen (checked in the Spark log of `scripts/oracle_check.py`).

What to look for:

* ticker filters on Parquet columns are pushed (`In`, `StringStartsWith`);
  filters on derived text (casts, concatenations) cannot be and run in the
  first codegen stage instead;
* `ReadSchema` holds only the columns a query uses;
* catalog-style queries shuffle twice (listing aggregate, then window or
  join), and newest-N carries a partial `WindowGroupLimit` below its shuffle;
* `BroadcastHashJoin` appears only where a side is a fixed registry or AQE
  measured it small at runtime; no nested-loop or cartesian joins;
* Python runs only where the operator is a per-file byte job (head sampling,
  raw copy) or a user Arrow function (`row_filter`);
* the stand-in listings aggregate `min(key)` (a sort-based aggregate over a
  string); real listings come from file metadata and have no aggregate.
"""


def run(*args: str) -> str:
    cmd = [sys.executable, os.path.join(HERE, "explain_plans.py"), *args]
    return subprocess.run(cmd, capture_output=True, text=True, timeout=3600, check=True).stdout


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    facts = run(sf)
    full = run(sf, "flagship", "--full")
    phys = full.split("== Physical Plan ==", 1)[-1]
    keep, in_scan = ["== Physical Plan =="], False
    for ln in phys.splitlines():
        if ln.startswith("(") and "Scan parquet" in ln:
            in_scan = True
        elif ln.startswith("("):
            in_scan = False
        if "+-" in ln or ln.startswith("AdaptiveSparkPlan") or in_scan:
            keep.append(ln)
    doc = INTRO + f"\n## Facts per query\n\n```\n{facts.strip()}\n```\n\n## Flagship plan\n\n```\n" + "\n".join(keep).strip() + "\n```\n"
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as fh:
        fh.write(doc)


if __name__ == "__main__":
    main()
