"""Write PLANS.md: final (adaptive) physical plans of the key queries.

    python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

KEEP = re.compile(r"(Exchange|Reused|Scan|Join|Aggregate|Window|Sort|Generate|PushedFilters|ReadSchema|"
                  r"AdaptiveSparkPlan|Filter|Union|TakeOrdered|Coalesced)")




def run(df) -> str:
    rows = df.collect()  # executes this very plan, so the adaptive plan is final
    text = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    lines = [ln if "FileScan" in ln else ln[:170] for ln in text.splitlines() if KEEP.search(ln)]
    return f"rows: {len(rows)}\n\n```\n" + "\n".join(lines) + "\n```\n"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from cardflow.plans import runner
    from cardflow.registry import QUERIES, SETTINGS
    from cardflow.session import local_session
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    out = [f"# Final physical plans ({sf_dir}, local[*], AQE on)\n",
           "Generated by `tools/explain_plans.py`. Only operator lines are kept.\n"]
    for name in ["customer_rejects", "transaction_rejects", "intermediate", "report_previous_transaction"]:
        out.append(f"## {name}\n")
        out.append(run(QUERIES[name](spark, sf_dir)))
    res = runner.run_steps(spark, runner.inputs_from_tables(spark, sf_dir), SETTINGS,
                           database=f"cardflow_plans_{uuid.uuid4().hex[:6]}")
    inter = res.files(spark, "intermediate")
    from cardflow.plans import reports
    out.append("## EMI offers over the written intermediate table (pushdown and pruning)\n")
    out.append(run(reports.emi_offers(inter, SETTINGS).filter(F.col("COUNTRY") == "ASIA")))
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
