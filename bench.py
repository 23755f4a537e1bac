"""Benchmark: time the headline queries on one folder and print one JSON line.

``BENCH_SF_DIR`` names the folder, ``BENCH_CPUS`` the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plenaria.queries import registry  # noqa: E402
from plenaria.session import local_session  # noqa: E402

HEADLINE = [
    "d1_latest_version", "d3_conform_entity", "d4_conform_bridge", "j3_fk_null", "j5_both_ends", "t1_partial_date",
    "x3_regex_rules", "x7_fold_key", "j1_chain", "j6_interval_join", "j7_year_membership", "j12_active_count",
    "g2_distinct", "g4_median_p90", "f6_iqr", "w2_argmax", "w4_global_row_number", "w6_lead_moves", "r4_margins",
    "k4_merge", "k5_cascade", "q8_profile", "m2_semantic_query", "a1_unanimity", "a2_position", "a4_against_majority",
    "a5_dissent", "a7_agreement", "a9_switches", "a10_components", "a11_seat_events", "a12_yearly_seats",
    "a15_scorecard", "a17_per_proposer", "a19_lead_time", "a21_citations", "a22_earner_share", "a27_highest_level",
    "a29_place_match", "z_contacts_fact", "z_decisions_fact", "z_votes_fact", "z_careers_dim_persoon",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = local_session("bench", cpus)
    found = registry()
    # start-up cost (class loading, first codegen, Python workers) is not any query's time
    for name in ("g1_basic", "j15_pairs"):
        found[name](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in only or HEADLINE:
        start = time.perf_counter()
        found[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline queries, total seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": folder.rstrip("/").rsplit("sf", 1)[-1], "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
