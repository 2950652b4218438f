"""Entry script for spark-submit: ``spark-submit changelake_job.py --BRONZE_PATH ...``."""

from changelake.__main__ import main

if __name__ == "__main__":
    raise SystemExit(main())
