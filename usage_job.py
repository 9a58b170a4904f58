"""Entry point of the streaming job: ``spark-submit usage_job.py --help``."""

from tallyboard.streaming.app import main

if __name__ == "__main__":
    main()
