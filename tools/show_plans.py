"""Write the physical plans of the headline queries to PLANS.md.

Plans are taken with automatic broadcast joins off, as they would be chosen
for tables far above the broadcast threshold; broadcasts that remain are the
explicit ones over tables bounded by construction.

    python tools/show_plans.py [sf_dir] [out.md]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from retentio.plans import catalog  # noqa: E402
from retentio.session import local_session  # noqa: E402

HEADLINE = [
    ("member table", lambda s, d: catalog.members(s, d)),
    ("weight sweep and optimum (D10)", catalog.d10_optimal_weight),
    ("scenario table with global rank (D15)", catalog.d15_score_scenarios),
    ("strategy comparison (D12)", catalog.d12_compare_strategies),
    ("expected-loss priority (D16)", catalog.d16_expected_loss_priority),
]


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    text = re.sub(r"#\d+L?", "", text)  # drop expression ids
    return "\n".join(line[:180] for line in text.splitlines())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(os.path.dirname(os.path.dirname(
        os.path.abspath(__file__))), "PLANS.md")
    spark = local_session(8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    parts = ["# Physical plans of the headline queries", "",
             "Generated by `tools/show_plans.py` with automatic broadcast joins off (the choice for",
             "large tables). Remaining broadcasts are explicit, over tables bounded by construction",
             "(one row per scenario, per partition and scenario, or per band). Queries that",
             "materialise an input show a Parquet scan of the stored table under the checkpoint folder.", ""]
    for title, fn in HEADLINE:
        parts += [f"## {title}", "", "```", _plan(fn(spark, sf_dir)), "```", ""]
    with open(out, "w") as fh:
        fh.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
