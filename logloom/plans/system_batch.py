"""The system-log batch job: from raw text to the four result tables."""

import time

from pyspark.sql import DataFrame, SparkSession

from logloom.functions import fixed
from logloom.operators import hourly, system_log, volume
from logloom.sources import readers, sinks
from logloom.sources.durable import durable, job_tables
from logloom.sources.options import BatchOptions

LINE_COUNT = "Line_Count"
VIEW = "windows_logs"


def results_of(summary: DataFrame, parsed: DataFrame | None = None) -> dict[str, tuple[str, DataFrame]]:
    """Result name to stage label and table, all from the stored summary.

    With ``parsed`` lines the summary is a bounded one: templates are then counted over the lines, and their number per hour is an estimate.
    """
    components, levels, templates, features = fixed.RESULT_STAGES
    if parsed is None:
        top, hours = volume.top_templates(summary, weight=LINE_COUNT), hourly.hourly_features(summary, weight=LINE_COUNT)
    else:
        top, hours = volume.frequent_templates(parsed), hourly.merged_hours(hourly.hourly_sketches(summary, weight=LINE_COUNT))
    return {
        fixed.RESULT_COMPONENTS: (components, volume.component_volume(summary, weight=LINE_COUNT)),
        fixed.RESULT_LEVELS: (levels, volume.severity_levels(summary, weight=LINE_COUNT)),
        fixed.RESULT_TEMPLATES: (templates, top),
        fixed.RESULT_HOURS: (features, hours),
    }


def run(
    spark: SparkSession,
    options: BatchOptions,
    timings_path: str | None = None,
    setup: str | None = None,
    metrics_path: str | None = None,
    bounded: bool = False,
) -> dict[str, float]:
    """Write the four result tables and return the seconds per stage.

    The text is scanned and parsed once, which is a stage of its own: the summary goes to the shared folder and
    every result is an aggregate of that. The parsed lines are also there for SQL, as view ``windows_logs``. With
    ``timings_path`` the stage times are added to the timings table under ``setup``, which must then be named; with ``metrics_path``
    the times, rows and bytes of the four results to the metrics table.

    ``bounded`` is for text whose templates are mostly unique: the summary then holds no template, and the lines are read twice more for
    the most frequent ones.
    """
    if (timings_path is not None or metrics_path is not None) and not setup:
        raise ValueError("stage times need the name of the worker setup they were taken under")
    started = time.monotonic()
    lines = readers.read_lines(spark, options.source, options.max_input_rows)
    parsed = sinks.register_view(system_log.parse_system_log(lines), VIEW)
    with job_tables(spark):
        summary = durable(system_log.bounded_summary(parsed) if bounded else system_log.summarise(parsed), "summary")
        seconds = {fixed.SUMMARY_STAGE: time.monotonic() - started}
        made = {
            stage: sinks.measured_export(spark, table, name, options.results, options.mirror_base)
            for name, (stage, table) in results_of(summary, parsed if bounded else None).items()
        }
    seconds |= {stage: export.seconds for stage, export in made.items()}
    if timings_path is not None:
        sinks.append_timings(spark, timings_path, setup, seconds)
    if metrics_path is not None:
        sinks.append_metrics(spark, metrics_path, setup, made)
    return seconds
