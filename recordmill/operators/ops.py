"""Operational queries on the current state of jobs, and a command line for them."""

from __future__ import annotations

import argparse
import sys
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN = ["RECEIVED", "VALIDATING", "PLANNING", "PROCESSING"]
DEFAULT_LIMIT = 100


def get_job(jobs: DataFrame, job_id) -> DataFrame:
    return jobs.where(F.col("job_id") == job_id)


def summaries(jobs: DataFrame) -> DataFrame:
    """Jobs as they are shown: what a job lacks is an empty text, a zero or false; times stay null."""
    kinds = {"string": "", "bigint": 0, "int": 0, "double": 0.0, "boolean": False}
    return jobs.withColumns({c: F.coalesce(F.col(c), F.lit(kinds[t]).cast(t)) for c, t in jobs.dtypes if t in kinds})


def by_receipt(jobs: DataFrame, receipts: DataFrame) -> DataFrame:
    """Receipts with their jobs."""
    return receipts.join(jobs, "job_id")


def by_status(jobs: DataFrame, status: str, after: Column | None = None, before: Column | None = None, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Oldest update first, then id. With both bounds the range is inclusive; ``before`` alone is exclusive."""
    rows, at = jobs.where(F.col("state") == status), F.col("updated_at")
    if after is not None and before is not None:
        rows = rows.where(at.between(after, before))
    elif after is not None:
        rows = rows.where(at >= after)
    elif before is not None:
        rows = rows.where(at < before)
    return rows.orderBy("updated_at", "job_id").limit(limit)


def stuck(jobs: DataFrame, now: Column, threshold: str, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Jobs in an open state that were not updated for longer than the threshold, longest first."""
    rows = jobs.where(F.col("state").isin(OPEN) & (F.col("updated_at") < now - F.expr(f"INTERVAL {threshold}")))
    return rows.withColumn("stuck_seconds", (F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp("updated_at")).cast("long")).orderBy("updated_at", "job_id").limit(limit)


def main(argv: list[str]) -> int:
    p = argparse.ArgumentParser(description="Query the job ledger (a Parquet table of current states).")
    p.add_argument("--jobs", required=True)
    p.add_argument("--job-id")
    p.add_argument("--status")
    p.add_argument("--after")
    p.add_argument("--before")
    p.add_argument("--stuck", help="for example '30 minutes'")
    p.add_argument("--limit", type=int, default=DEFAULT_LIMIT)
    a = p.parse_args(argv)
    jobs = SparkSession.builder.getOrCreate().read.parquet(a.jobs)
    time = lambda x: None if x is None else F.lit(datetime.fromisoformat(x))
    if a.job_id:
        out = get_job(jobs, a.job_id)
    elif a.status:
        out = by_status(jobs, a.status, time(a.after), time(a.before), a.limit)
    elif a.stuck:
        out = stuck(jobs, F.current_timestamp(), a.stuck, a.limit)
    else:
        p.error("one of --job-id, --status and --stuck is needed")
    rows = [r[0] for r in out.select(F.to_json(F.struct("*"))).limit(a.limit).collect()]
    print("\n".join(rows))
    return 0 if rows or not a.job_id else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
