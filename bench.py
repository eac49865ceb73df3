"""Times the headline queries and the whole batch job; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores. Every query runs to completion into
a no-op sink. ``medallion_job`` is raw files -> bronze -> silver -> gold -> checks, all from text; its input is written
before the clock starts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallystrata.plans import job  # noqa: E402
from tallystrata.session import local_session  # noqa: E402
from tallystrata.sources.scratch import scratch_path  # noqa: E402
from workload import raw  # noqa: E402
from workload.bank import Bank  # noqa: E402
from workload.queries import registered  # noqa: E402

HEADLINE = (
    "annual_yoy", "tx_kpis", "tx_by_type_share", "month_profile", "top_accounts", "client_kpis", "age_bands_sql",
    "client_balance_top", "url_tail_top", "credit_kpis", "status_share", "tenor_rate", "top_employees",
    "index_running_sum", "withdrawals_vs_index", "credit_vs_index", "index_corr", "fact_tx_evolution", "fact_tx_type",
    "fact_clients", "fact_proposals", "fact_withdrawals", "rate_histogram", "daily_series", "burst_days",
    "seasonality_quarter", "seasonality_weekday", "welch_month_flag", "welch_parity", "dedup_keep_first",
    "distinct_rows", "dq_unique_key", "dq_constraints", "frequency_index", "typed_timestamps",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=max(int(cpus), 1) if cpus.isdigit() else 8)
    queries = registered()
    queries["annual_yoy"](spark, sf_dir).collect()   # starts the JVM-side machinery once

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)

    root = raw.write_raw(Bank(spark, sf_dir), scratch_path(spark, "raw"))
    start = time.perf_counter()
    outcome = job.run(spark, root, scratch_path(spark, "lake"))
    seconds["medallion_job"] = round(time.perf_counter() - start, 3)
    raw_rows = sum(outcome.rows["bronze"].values())

    print(json.dumps({
        "metric": "headline_queries_and_job_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": cpus,
        "job_rows": raw_rows,
        "job_rows_per_sec": round(raw_rows / seconds["medallion_job"]),
        "job_checks_passed": sum(c.passed for c in outcome.checks),
    }))


if __name__ == "__main__":
    main()
