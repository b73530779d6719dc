"""Times the headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import statistics
import time
from collections.abc import Callable
from datetime import datetime, timezone

from stratalake.plans import gold, jobs, silver
from stratalake.plans.clean_profile import clean_and_profile
from stratalake.plans.flat_export import export_flat
from stratalake.registry.stage import layers
from stratalake.session import build_session, work_dir
from stratalake.sources.readers import scan_bronze_json
from stratalake.sources.writers import write_json_arrays
from stratalake.streaming.gold import run_gold_incremental
from stratalake.streaming.ingest import ingest_bronze
from stratalake.streaming.upsert import run_incremental

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
RUN_TS = datetime(2024, 2, 1, tzinfo=timezone.utc)


def seconds(run: Callable[[], object]) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="20g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    at = layers(spark, SF_DIR)

    def to_noop(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    # Preparation: deriving and landing the raw JSON is not part of any job, so it is timed apart.
    times = {"prepare_raw_json": seconds(at.bronze_json)}
    times["prepare_silver"] = seconds(at.silver_base)

    headline = {
        "run_bronze_to_silver": lambda: jobs.run_bronze_to_silver(
            spark, at.bronze_json(), work_dir(spark, "silver")
        ),
        "run_silver_to_gold": lambda: jobs.run_silver_to_gold(
            spark, at.silver_base(), work_dir(spark, "gold")
        ),
        "transform_artists": lambda: to_noop(silver.transform_artists(at.bronze("artists"))),
        "transform_albums": lambda: to_noop(silver.transform_albums(at.bronze("albums"))),
        "transform_songs": lambda: to_noop(silver.transform_songs(at.bronze("songs"))),
        "build_artist_summary": lambda: to_noop(
            gold.build_artist_summary(at.silver("artists"), at.silver("songs"), at.silver("albums"))
        ),
        "build_yearly_release_metrics": lambda: to_noop(
            gold.build_yearly_release_metrics(at.silver("albums"))
        ),
        "clean_and_profile": lambda: to_noop(clean_and_profile(at.bronze_parts())),
        "flat_csv_export": lambda: export_flat(
            spark, at.bronze_parts(), work_dir(spark, "export"), RUN_TS
        ),
        "stream_json_ingest": lambda: ingest_bronze(
            spark, at.bronze_json(), work_dir(spark, "ingested"), work_dir(spark, "state")
        ),
    }
    for name, run in headline.items():
        times[name] = statistics.median(seconds(run) for _ in range(RUNS))

    # The same raw data as array files, which many tasks read.
    arrays = work_dir(spark, "arrays")
    write_json_arrays(at.bronze().repartition(2), arrays)
    read = lambda: to_noop(scan_bronze_json(spark, arrays, multi_line=True))
    times["read_array_files"] = statistics.median(seconds(read) for _ in range(RUNS))

    # The incremental job, and gold after it: all files as news, then one more file of a thousand envelopes.
    landing = at.bronze_json()
    names = ("incremental_first_run", "gold_deltas_first_run", "incremental_small_delta", "gold_deltas_small_delta")
    runs = {name: [] for name in names}
    few = at.bronze().limit(1000).coalesce(1)
    for _ in range(min(RUNS, 2)):
        state, silver_base, gold_base = (work_dir(spark, name) for name in ("state", "silver", "gold"))
        silver_run = lambda: run_incremental(spark, landing, state, silver_base)  # noqa: E731, B023
        gold_run = lambda: run_gold_incremental(spark, state, gold_base, RUN_TS)  # noqa: E731, B023
        for step in ("first_run", "small_delta"):
            if step == "small_delta":
                few.write.mode("append").json(landing)
            runs[f"incremental_{step}"].append(seconds(silver_run))
            runs[f"gold_deltas_{step}"].append(seconds(gold_run))
    times |= {name: statistics.median(values) for name, values in runs.items()}

    scale = re.search(r"sf([\d.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "bronze to silver to gold, wall time",
                "value": round(times["run_bronze_to_silver"] + times["run_silver_to_gold"], 3),
                "unit": "sec",
                "queries": {name: round(t, 3) for name, t in times.items()},
                "sf": float(scale.group(1)) if scale else SF_DIR,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
