"""spark-submit entry script: ``spark-submit --py-files orderlake.zip run_job.py <command> [options]``.

Commands: ledger-to-bronze, bronze-to-silver, silver-to-gold, clustering, ingest-stream
(see ``orderlake/plans/cli.py``).
"""

from orderlake.plans.cli import main

if __name__ == "__main__":
    main()
