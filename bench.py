"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the folder of the given tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` how many timed
runs follow the warm-up run. The log text is rendered from ``events`` beforehand. A stage is timed as a user of
the batch job sees it: text scan, parse, aggregate, parquet write, mirror copy.

The given tables make a few megabytes of text, on which jobs mostly start and stop. ``BENCH_TEXT_MB`` (512, 0 for none) megabytes are
rendered from ``events`` as well, repeated with shifted event numbers, and the stages timed once over them, with megabytes a second
and core and core seconds a gigabyte.
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from logloom import schemas  # noqa: E402
from logloom.functions import fixed  # noqa: E402
from logloom.operators import anomaly, hourly, system_log, volume  # noqa: E402
from logloom.plans import metrics_batch, report, system_batch  # noqa: E402
from logloom.registry import event_source  # noqa: E402
from logloom.sources import readers, sinks  # noqa: E402
from logloom.sources.durable import durable, scratch_path  # noqa: E402
from logloom.sources.options import BatchOptions  # noqa: E402


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("logloom-bench")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def benchmarks(spark: SparkSession, sf_dir: str) -> dict:
    events = event_source.events(spark, sf_dir)
    system_path, metric_path = scratch_path(spark, "bench-system"), scratch_path(spark, "bench-metrics")
    sinks.write_lines(event_source.system_lines(events), system_path)
    sinks.write_lines(event_source.metric_lines(events), metric_path)
    results, mirror = scratch_path(spark, "bench-results"), scratch_path(spark, "bench-mirror")
    options = BatchOptions(namenode="", input_path=system_path, output_base=results, mirror_base=mirror)
    system_batch.run(spark, options)
    hours = durable(readers.read_result(spark, results, fixed.RESULT_HOURS, schemas.HOURLY_FEATURES), "hours")

    def stage(name, operator):
        def run():
            parsed = system_log.parse_system_log(readers.read_lines(spark, system_path))
            sinks.export(spark, operator(parsed), f"{name}_alone", results, mirror)

        return run

    metric_options = BatchOptions(namenode="", input_path=metric_path, output_base=results)

    return {
        "component_volume": stage(fixed.RESULT_COMPONENTS, volume.component_volume),
        "severity_levels": stage(fixed.RESULT_LEVELS, volume.severity_levels),
        "top_templates": stage(fixed.RESULT_TEMPLATES, volume.top_templates),
        "hourly_features": stage(fixed.RESULT_HOURS, hourly.hourly_features),
        "system_batch_all_four": lambda: system_batch.run(spark, options),
        "server_metric_reports": lambda: metrics_batch.run(spark, metric_options),
        "anomaly_scores": lambda: anomaly.anomaly_scores(hours).collect(),
        "report": lambda: report.run(spark, results, results),
    }


def large_text(spark: SparkSession, sf_dir: str, megabytes: int, cores: int) -> dict:
    """The stages over more text than fits the noise of starting jobs."""
    events = event_source.events(spark, sf_dir)
    path, results = scratch_path(spark, "bench-large"), scratch_path(spark, "bench-large-results")
    count, longest = events.count(), 125
    copies = max(1, megabytes * 1_000_000 // (count * longest))
    shifted = F.col("event_id") + F.col("copy") * count
    many = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).withColumn("event_id", shifted)
    sinks.write_lines(event_source.system_lines(many.repartition(4 * cores)), path)
    size = readers.read_lines(spark, path).selectExpr("sum(octet_length(value) + 1)").first()[0] / 1e6
    options = BatchOptions(namenode="", input_path=path, output_base=results)
    seconds = {}
    for name, operator in {
        "component_volume": volume.component_volume,
        "severity_levels": volume.severity_levels,
        "top_templates": volume.top_templates,
        "hourly_features": hourly.hourly_features,
    }.items():
        started = time.perf_counter()
        sinks.export(spark, operator(system_log.parse_system_log(readers.read_lines(spark, path))), name, results)
        seconds[name] = round(time.perf_counter() - started, 3)
    started = time.perf_counter()
    system_batch.run(spark, options)
    seconds["system_batch_all_four"] = round(time.perf_counter() - started, 3)
    return {
        "text_mb": round(size, 1),
        "seconds": seconds,
        "mb_per_second_and_core": {name: round(size / taken / cores, 2) for name, taken in seconds.items()},
        "core_seconds_per_gb": {name: round(taken * cores / size * 1000, 1) for name, taken in seconds.items()},
        "templates_over_severity": round(seconds["top_templates"] / seconds["severity_levels"], 2),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    seconds = {}
    for name, run in benchmarks(spark, sf_dir).items():
        run()
        times = []
        for _ in range(runs):
            started = time.perf_counter()
            run()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times), 3)
    megabytes, cores = int(os.environ.get("BENCH_TEXT_MB", "512")), int(os.environ.get("BENCH_CPUS", "8"))
    large = large_text(spark, sf_dir, megabytes, cores) if megabytes else None
    stages = ("component_volume", "severity_levels", "top_templates", "hourly_features")
    print(
        json.dumps(
            {
                "metric": "four stages run separately, text scan to mirrored parquet",
                "value": round(sum(seconds[name] for name in stages), 3),
                "unit": "sec",
                "queries": seconds,
                "large_text": large,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
