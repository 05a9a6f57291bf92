"""List plan shapes to look at: python tests/check_plans.py [sf_dir].

Prints, per registered query, joins without keys and windows or sorts over a single partition.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402

if __name__ == "__main__":
    from threadlens import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session(master="local[8]", shuffle_partitions=8, spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    for name, fn in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        found = {k: len(re.findall(k, plan)) for k in (
            "BroadcastNestedLoopJoin", "CartesianProduct", "SinglePartition", "BatchEvalPython", "WindowGroupLimit", r"Exchange hash", "FileScan")}
        print(f"{name:28s}", {k: v for k, v in found.items() if v}, flush=True)
