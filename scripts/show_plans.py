"""Print the key lines of the physical plans of selected queries.

usage: python scripts/show_plans.py [sf_dir] [name ...]
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickwise.plans.catalog import QUERIES  # noqa: E402
from tickwise.session import get_spark  # noqa: E402

KEEP = re.compile(r"(Exchange|Sort |Window|Aggregate|Join|BroadcastExchange|TakeOrdered|"
                  r"WindowGroupLimit|Scan parquet|PartitionFilters|PushedFilters|ReadSchema|Generate)")

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or ["enrich_ticks", "latest_per_symbol", "tail_per_symbol", "top_gainers",
                         "corr_matrix", "scan_enriched", "scan_recent", "symbol_series", "enrich_split"]
spark = get_spark("local[8]", shuffle_partitions=8)
spark.conf.set("spark.sql.adaptive.enabled", "false")   # show the static plan shape
for n in names:
    p = QUERIES[n](spark, sf)._jdf.queryExecution().executedPlan().toString()
    print(f"### {n}\n```")
    for line in p.splitlines():
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            if "FileScan" in line:
                head = line[:line.index("FileScan") + 8]
                parts = [m.group(0) for m in re.finditer(
                    r"(PartitionFilters|PushedFilters|ReadSchema): (\[[^\]]*\]|struct<[^>]*>)", line)]
                print(head + " " + "; ".join(parts))
            else:
                print(line[:200])
    print("```\n")
