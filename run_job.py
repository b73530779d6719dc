"""spark-submit entry for the batch and incremental jobs.

    spark-submit run_job.py bronze-to-silver <bronze glob> <silver folder> [--multi-line]
    spark-submit run_job.py silver-to-gold   <silver folder> <gold folder>
    spark-submit run_job.py incremental      <landing folder> <state folder> <silver folder> [--multi-line] [--by-content] [--archive <folder>]
    spark-submit run_job.py export-csv       <bronze glob> <export folder> [--multi-line]
    spark-submit run_job.py export-newest    <landing folder> <export folder> <archive folder> [--multi-line]
    spark-submit run_job.py inspect          <bronze glob> [--multi-line]
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from stratalake.plans.flat_export import export_files, export_newest
from stratalake.plans.jobs import run_bronze_to_silver, run_silver_to_gold
from stratalake.session import build_session
from stratalake.sources.readers import infer_bronze, inspect_schema
from stratalake.streaming.upsert import BUCKET_BYTES, BUCKETS, run_incremental


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, folders in {
        "bronze-to-silver": ["bronze", "silver"],
        "silver-to-gold": ["silver", "gold"],
        "incremental": ["landing", "state", "silver"],
        "export-csv": ["bronze", "out"],
        "export-newest": ["landing", "out", "archive"],
        "inspect": ["bronze"],
    }.items():
        job = jobs.add_parser(name)
        for folder in folders:
            job.add_argument(folder)
        if folders[0] in ("bronze", "landing"):
            job.add_argument("--multi-line", action="store_true", help="files of any layout: arrays, values over several lines or one per line")
        if name == "incremental":
            job.add_argument("--by-content", action="store_true", help="leave out files whose content was taken under another name")
            job.add_argument("--archive", help="folder that files are moved to once a later run has begun")
            job.add_argument("--buckets", type=int, default=BUCKETS, help="buckets of a new table")
            job.add_argument("--bucket-bytes", type=int, default=BUCKET_BYTES, help="average size at which buckets are split")
    args = parser.parse_args()
    spark = build_session(f"stratalake {args.job}")

    if args.job == "bronze-to-silver":
        print(run_bronze_to_silver(spark, args.bronze, args.silver, multi_line=args.multi_line))
    elif args.job == "silver-to-gold":
        print(run_silver_to_gold(spark, args.silver, args.gold, datetime.now(timezone.utc)))
    elif args.job == "incremental":
        more = {"buckets": args.buckets, "bucket_bytes": args.bucket_bytes, "by_content": args.by_content}
        print(run_incremental(spark, args.landing, args.state, args.silver, args.multi_line, args.archive, **more))
    elif args.job == "export-newest":
        now = datetime.now(timezone.utc)
        print(export_newest(spark, args.landing, args.out, args.archive, now, args.multi_line))
    elif args.job == "export-csv":
        print(export_files(spark, args.bronze, args.out, datetime.now(timezone.utc), args.multi_line))
    else:
        inspect_schema(infer_bronze(spark, args.bronze, args.multi_line)).show(1000, truncate=False)


if __name__ == "__main__":
    main()
