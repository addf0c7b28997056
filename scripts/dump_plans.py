"""Write PLANS.md: the physical plan tree of every query outside the optional
subpackage at sf0.1, with its exchange count, pushed filters and read schemas.

usage: python scripts/dump_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from airshed.plans import registry  # noqa: E402
from airshed.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", app="airshed-plans")
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plans\n")
    print(f"Generated by `scripts/dump_plans.py` on `{sf_dir}` (Spark {spark.version}, AQE on; initial plans).")
    print("What a query runs before its result's plan (its loads, the hot-key sketch, ordinal scratch tables) is not shown.\n")
    for name, q in registry.QUERIES.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            q(spark, sf_dir).explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n")[0].replace("== Physical Plan ==\n", "")
        exchanges = len(re.findall(r"^\(\d+\) Exchange", text, re.M))
        broadcasts = len(re.findall(r"^\(\d+\) BroadcastExchange", text, re.M))
        pushed = sorted(set(re.findall(r"PushedFilters: (\[.*?\])\n", text)))
        schemas = sorted(set(re.findall(r"ReadSchema: (struct<.*?>)\n", text)))
        print(f"## {name}\n")
        print(f"shuffles: {exchanges}, broadcasts: {broadcasts}\n")
        for p in pushed:
            print(f"* PushedFilters: `{p}`")
        for s in schemas:
            print(f"* ReadSchema: `{s}`")
        print("\n```\n" + tree.strip() + "\n```\n")


if __name__ == "__main__":
    main()
