"""List plan features that do not scale: nested-loop joins, cross products, single-partition steps.

usage: python tools/plan_audit.py [folder] [name or prefix ...]
"""

import re
import sys

sys.path.insert(0, str(__import__("pathlib").Path(__file__).resolve().parents[1]))

from plenaria.queries import registry  # noqa: E402
from plenaria.session import local_session  # noqa: E402

FEATURES = {
    "nested loop": r"BroadcastNestedLoopJoin", "cross product": r"CartesianProduct", "window without partition": r"Window \[.*windowspecdefinition\((?!.*#\d+L?, )",
    "single partition": r"Exchange SinglePartition", "python rows": r"BatchEvalPython", "collect": r"collect_(list|set)",
}


def main(argv):
    folder = argv[1] if len(argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session("audit", **{"spark.sql.autoBroadcastJoinThreshold": "-1"})
    for name, q in registry().items():
        if argv[2:] and not any(name.startswith(w) for w in argv[2:]):
            continue
        df = q(spark, folder)
        plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        found = {f: len(re.findall(p, plan)) for f, p in FEATURES.items() if re.search(p, plan)}
        shuffles = len(re.findall(r"Exchange hashpartitioning", plan))
        print(f"{name}: {shuffles} shuffles, {len(re.findall('FileScan', plan))} scans {found or ''}", flush=True)


if __name__ == "__main__":
    main(sys.argv)
