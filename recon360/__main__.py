"""``spark-submit recon360/__main__.py INPUT OUTPUT`` or ``python -m recon360 INPUT OUTPUT``."""

from __future__ import annotations

import argparse

from recon360.plans import job
from recon360.session import build_session, drop_scratch


def main() -> None:
    parser = argparse.ArgumentParser(prog="recon360", description="conform, check and answer")
    parser.add_argument("input", help="folder with the five sources and, if wanted, rules, mapping and questions")
    parser.add_argument("output", help="folder for all tables and reports")
    args = parser.parse_args()
    spark = build_session()
    try:
        tables = job.run(spark, args.input, args.output)
        tables["dq_summary"].show(truncate=False)
        tables["checks"].show(100, truncate=False)
    finally:
        drop_scratch(spark)
        spark.stop()


if __name__ == "__main__":
    main()
