"""Entry point for spark-submit; see stormglass/plans/cli.py for the jobs."""

from stormglass.plans.cli import main

if __name__ == "__main__":
    main()
