"""The daily batch job on a cluster: raw events in, fact table and report data
sets out. A thin sequential driver over the library functions (each step is
a distributed Spark job; nothing is collected).

    zip -qr eventide.zip eventide
    spark-submit --py-files eventide.zip daily_job.py --raw s3://…/raw_events \\
        --dims s3://…/dims --out s3://…/analytics --as-of "2024-02-01 00:00:00" \\
        --since "2024-01-31 00:00:00"

(``daily_job.py`` at the repository root calls ``main``; ``--py-files``
ships the package to the executors, where only the streaming debounce runs
Python code.)

``--raw`` is the raw landing table (parquet, columns of ``fixtures.RAW_COLUMNS``);
``--dims`` holds ``dim_users`` and ``dim_tenants`` parquet tables. Outputs:
``fct_events`` (a ``FactStore``), and one folder per data set. With ``--since``
only the raw rows collected after that time are merged into the fact table
that stands there, and only the dates that they touch are rewritten; without
it the table is built anew.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import funnel as FN
from ..operators import quality as Q
from ..operators import reports as R
from ..operators.fact_store import FactStore
from ..session import build_session
from ..sources import io as IO


def run(spark: SparkSession, raw_path: str, dims_path: str, out: str, as_of: str, since: str | None = None) -> None:
    raw = spark.read.parquet(raw_path)
    users = spark.read.parquet(f"{dims_path}/dim_users")
    tenants = spark.read.parquet(f"{dims_path}/dim_tenants")

    store = FactStore(spark, f"{out}/fct_events")
    if since is None or store.version() is None:
        store.build(raw, as_of=as_of)
    else:
        store.apply(raw.where(F.col("collector_tstamp") > F.lit(since).cast("timestamp_ntz")), as_of=as_of)
    fact = store.read()

    def kept(df: DataFrame, name: str) -> DataFrame:
        """A data set that several reports read, computed once."""
        df.write.mode("overwrite").parquet(f"{out}/work/{name}")
        return spark.read.parquet(f"{out}/work/{name}")

    # per-user invites, step times and flags, built once for the funnel family
    profile = kept(FN.user_profiles(raw), "user_profiles")

    recon = kept(Q.reconcile(raw, fact), "reconciliation")
    nulls = kept(Q.null_checks(raw), "null_checks")
    funnel_rows = kept(FN.funnel(raw, st=FN.profile_steps(profile)), "funnel")
    cohorts = kept(FN.weekly_cohort(raw, profile=profile), "cohorts")
    sets = {
        "reconciliation": recon,
        "reconciliation_summary": Q.status_summary(recon),
        "null_checks": nulls,
        "duplicates": Q.duplicates(raw),
        "tenant_coverage": Q.p0_coverage(raw),
        "funnel": funnel_rows,
        "benchmarks": FN.benchmark_compare(funnel_rows, C.FUNNEL_BENCHMARKS),
        "time_to_complete": FN.time_to_complete(raw, st=FN.profile_steps(profile, bounded=False)),
        "segments": FN.role_severity(FN.segment_by_role(raw, users, profile=profile)),
        "cohorts": cohorts,
        "executive_summary": R.executive_summary(raw, fact, tenants, users),
        "event_volume": R.event_volume(fact),
        "category_distribution": R.category_distribution(fact),
        "tenant_overview": R.tenant_overview(fact, tenants),
        "quality_scorecard": R.quality_scorecard(recon, nulls, raw, fact),
        "funnel_share": R.funnel_share(funnel_rows),
        "cohort_trend": R.cohort_trend(cohorts),
    }
    IO.write_report_sets(sets, f"{out}/reports")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    p.add_argument("--raw", required=True)
    p.add_argument("--dims", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--as-of", required=True)
    p.add_argument("--since")
    a = p.parse_args(argv)
    run(build_session(app="eventide-daily"), a.raw, a.dims, a.out, a.as_of, a.since)


if __name__ == "__main__":
    main()
