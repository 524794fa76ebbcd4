"""spark-submit entry point for the daily batch job (see eventide/plans/job.py)."""

from eventide.plans.job import main

if __name__ == "__main__":
    main()
