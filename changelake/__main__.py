"""Command line: run Silver tables and, optionally, the Gold marts.

    spark-submit changelake_job.py --BRONZE_PATH s3://b --SILVER_PATH s3://s \\
        --QUARANTINE_PATH s3://q [--TABLE fact_orders ...] [--JOB_NAME proj-dev-x] \\
        [--METRICS_PATH s3://m] [--GOLD_PATH s3://g] [--PUBLISH versioned] \\
        [--ORDER_AS timestamp] [--NULL_KEYS keep] [--MATERIALIZE persist] [--CHECK_SCHEMA warn] \\
        [--BROADCAST_PARENTS_UP_TO 33554432]

With ``--INCREMENTAL`` every table takes in only the files it has not seen
(parents first), instead of being built from all files.
"""

from __future__ import annotations

import argparse
import json

from .config import RunConfig, environment_from_job_name, resolve_paths
from .plans.gold_job import run_gold
from .plans.incremental_silver import apply_all
from .plans.silver_job import run_table
from .plans.specs import SPECS
from .session import build_session


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="changelake")
    ap.add_argument("--BRONZE_PATH", required=True)
    ap.add_argument("--SILVER_PATH", required=True)
    ap.add_argument("--QUARANTINE_PATH", required=True)
    ap.add_argument("--TABLE", action="append", choices=sorted(SPECS))
    ap.add_argument("--JOB_NAME", default="changelake")
    ap.add_argument("--METRICS_PATH")
    ap.add_argument("--GOLD_PATH")
    ap.add_argument("--PUBLISH", default="versioned", choices=["overwrite", "versioned"])
    ap.add_argument("--ORDER_AS", default="string", choices=["string", "timestamp"])
    ap.add_argument("--NULL_KEYS", default="group", choices=["group", "keep"])
    ap.add_argument("--MATERIALIZE", default="table", choices=["table", "persist"])
    ap.add_argument("--CHECK_SCHEMA", default="error", choices=["error", "warn", "off"])
    ap.add_argument("--FAIL_ON_EMPTY", action="store_true")
    ap.add_argument("--INCREMENTAL", action="store_true")
    ap.add_argument("--FORGET_DELETES_DAYS", type=float)
    ap.add_argument("--BROADCAST_PARENTS_UP_TO", type=int)
    a = ap.parse_args(argv)
    spark = build_session(app_name=a.JOB_NAME)
    cfg = RunConfig(resolve_paths(vars(a)), environment=environment_from_job_name(a.JOB_NAME),
                    metrics_path=a.METRICS_PATH, fail_on_empty=a.FAIL_ON_EMPTY)
    if a.INCREMENTAL:
        chosen = {t: SPECS[t] for t in a.TABLE or SPECS}
        runs = apply_all(spark, cfg, chosen, order_as=a.ORDER_AS, null_keys=a.NULL_KEYS, check_schema=a.CHECK_SCHEMA,
                         forget_deletes_days=a.FORGET_DELETES_DAYS)
        for t, r in runs.items():
            print(json.dumps({"table": t, "run_id": cfg.run_id, "files": r.files if r else 0,
                              "partitions_written": len(r.touched) if r else 0,
                              "valid_rows": r.valid_rows if r else None}))
        return _gold(spark, cfg, a.GOLD_PATH)
    tables = a.TABLE or sorted(SPECS, key=lambda n: (not n.startswith("dim_"), n))
    for t in tables:
        r = run_table(spark, SPECS[t], cfg, publish=a.PUBLISH, order_as=a.ORDER_AS,
                      null_keys=a.NULL_KEYS, materialize=a.MATERIALIZE, check_schema=a.CHECK_SCHEMA,
                      broadcast_parents_up_to=a.BROADCAST_PARENTS_UP_TO)
        print(json.dumps({"table": t, "run_id": cfg.run_id, "raw_rows": r.raw_rows,
                          "valid_rows": r.valid_rows, "quarantined_rows": r.quarantined_rows,
                          "max_capture_ts": r.max_capture_ts}))
    return _gold(spark, cfg, a.GOLD_PATH)


def _gold(spark, cfg: RunConfig, path: str | None) -> int:
    if path:
        for row in run_gold(spark, cfg, path).collect():   # one row per table
            print(json.dumps(row.asDict(), default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
