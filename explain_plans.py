"""Write PLANS.md: physical plans of the headline queries (python explain_plans.py [sf_dir])."""

import contextlib
import io
import sys

from tidemart.operators import marts
from tidemart.operators.incremental import Marts
from tidemart.plans.catalog import QUERIES
from tidemart.session import get_spark, scratch_dir
from tidemart.sources import testdata

SF = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
spark = get_spark("local[8]", shuffle_partitions=16)


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


sections = []
for name in ["daily_sales_summary", "revenue_by_category", "top10_products", "stable_daily_sample"]:
    sections.append((name, plan(QUERIES[name](spark, SF), "simple")))

m = Marts(spark, scratch_dir(spark, "plans"), fact_grain="year")
m.refresh(testdata.load_items(spark, SF, 0))
batch = testdata.load_items(spark, SF, 1)
sections.append(("incremental batch (fact rows of the new load past the mark)",
                 plan(marts.build_fact(testdata.load_items(spark, SF, 0).unionByName(batch)
                      .where("loaded_at > timestamp_ntz'2026-01-01 01:00:00'")), "simple")))
sections.append(("merge read of affected partitions",
                 plan(m.fact.read_partitions([d for d in [__import__("datetime").date(1998, 1, 1)]]))))

with open("PLANS.md", "w") as f:
    f.write(f"# Physical plans ({SF}, local[8], AQE on)\n\nGenerated by `python explain_plans.py`. "
            "With AQE the final plan can differ at run time (e.g. a sort-merge join becomes a "
            "broadcast join once a side's runtime size is known).\n\n")
    for title, text in sections:
        f.write(f"## {title}\n\n```\n{text.strip()}\n```\n\n")
print("wrote PLANS.md")
