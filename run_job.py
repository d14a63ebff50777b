"""spark-submit launcher: ``spark-submit --py-files tidemark.zip run_job.py <command> ...``."""

import sys

from tidemark.cli import main

if __name__ == "__main__":
    sys.exit(main())
