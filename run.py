"""Runs one of the jobs in the session ``spark-submit`` sets up: ``spark-submit run.py system|metrics|report``.

Locations come from the environment: ``HDFS_NAMENODE``, ``LOG_INPUT_PATH``, ``MAX_INPUT_ROWS``, ``HDFS_OUTPUT_BASE``,
``LOCAL_OUTPUT_BASE`` (second copy of the results), ``TIMINGS_PATH``, ``METRICS_PATH`` and ``WORKER_SETUP`` (records of stage
times, and of times, rows and bytes), ``BOUNDED_SUMMARY`` (1 for text whose templates are mostly unique). Every job
stores its tables under the output base; what it prints is a preview.
"""

import os
import sys

from pyspark.sql import SparkSession

from logloom.functions import fixed
from logloom.plans import metrics_batch, report, system_batch
from logloom.sources import readers, sinks
from logloom.sources.options import BatchOptions


def system(spark: SparkSession) -> None:
    options = BatchOptions.from_mapping(os.environ)
    timings, metrics = os.environ.get("TIMINGS_PATH"), os.environ.get("METRICS_PATH")
    bounded = os.environ.get("BOUNDED_SUMMARY", "") not in ("", "0")
    for stage, seconds in system_batch.run(spark, options, timings, os.environ.get("WORKER_SETUP"), metrics, bounded).items():
        print(f"{stage}: {seconds:.2f}s")


def preview(spark: SparkSession, results: str, name: str) -> None:
    """The first rows on the console; the whole table is stored."""
    path = readers.result_path(results, name)
    print(f"{path} (first {sinks.PREVIEW_ROWS} rows)")
    sinks.show(spark.read.parquet(path))


def metrics(spark: SparkSession) -> None:
    options = BatchOptions.from_mapping(os.environ, metrics_batch.DEFAULT_INPUT)
    for name in metrics_batch.run(spark, options):
        preview(spark, options.results, name)


def write_report(spark: SparkSession) -> None:
    options = BatchOptions.from_mapping(os.environ)
    candidates = [base for base in (options.mirror_base, options.results) if base]
    base = readers.resolve_base(spark, candidates)
    for name in report.run(spark, base, options.results, os.environ.get("TIMINGS_PATH")):
        preview(spark, options.results, fixed.REPORT_PREFIX + name)


JOBS = {"system": system, "metrics": metrics, "report": write_report}

if __name__ == "__main__":
    if len(sys.argv) != 2 or sys.argv[1] not in JOBS:
        sys.exit(f"usage: run.py {'|'.join(JOBS)}")
    JOBS[sys.argv[1]](SparkSession.builder.appName(f"logloom {sys.argv[1]}").getOrCreate())
