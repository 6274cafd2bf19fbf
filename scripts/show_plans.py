"""Write PLANS.md: the formatted physical plans of the headline queries (python scripts/show_plans.py [sf_dir])."""

from __future__ import annotations

import contextlib
import io
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bandwise.plans import registry  # noqa: E402
from bandwise.session import local_session  # noqa: E402

SHOW = ["range_report", "over_under_two_stage", "two_stage_score", "clean_full", "dow_sales_profile", "weather_latest", "stratified_rest", "filter_range"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(tempfile.mkdtemp(prefix="bandwise-"), 8)
    out = [
        "# Physical plans of the headline queries\n",
        f"Generated by `scripts/show_plans.py` on `{sf_dir}` (local[8], AQE on). `AdaptiveSparkPlan isFinalPlan=false`",
        "is the plan before execution; AQE may still turn sort-merge joins into broadcast joins at run time.\n",
    ]
    for name in SHOW:
        df = registry.REGISTRY[name].run(spark, sf_dir)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        plan = buf.getvalue()
        out += [f"## {name}\n", "```", plan.strip(), "```\n"]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
