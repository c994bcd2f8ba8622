"""Launcher: spark-submit --py-files splitweave.zip run_job.py <pipeline> --option value."""

from splitweave.plans.submit import main

if __name__ == "__main__":
    main()
