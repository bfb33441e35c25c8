"""The report: every table behind it, from the result tables of the batch job."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom import schemas
from logloom.functions import fixed
from logloom.operators import anomaly, components, hourly, severity, stages, templates
from logloom.sources import readers, sinks
from logloom.sources.durable import job_tables


def build(
    spark: SparkSession,
    base: str,
    selected: Sequence[str] | None = None,
    benchmark: str | None = None,
    relative: bool = False,
    simplified: bool = False,
    timings: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Report tables by name; a section whose input is missing or too small is left out.

    Without a selection the largest components are compared, to the first of them. Presence of a result is read from the folder
    listing; only the selection and the anomaly model run jobs here.
    """
    ranked = components.with_share_and_rank(readers.read_result(spark, base, fixed.RESULT_COMPONENTS, schemas.COMPONENT_VOLUME))
    largest = [row.Component for row in components.default_selection(ranked).collect()]
    if not largest:
        raise ValueError(f"no component volume under {base}: run the batch job first")
    selected = largest if selected is None else selected
    benchmark = benchmark or next(iter(selected), None)
    comparison = components.compare_to_benchmark(ranked, selected, benchmark)
    tables = {
        "component_cards": components.cards(comparison, benchmark),
        "component_comparison": components.comparison_table(comparison),
        "component_metric": components.metric_view(comparison, relative),
        "component_share": components.selected_share(ranked, selected),
    }
    if readers.has_result(spark, base, fixed.RESULT_HOURS):
        tables |= _hours(readers.read_result(spark, base, fixed.RESULT_HOURS, schemas.HOURLY_FEATURES), selected, simplified)
    if readers.has_result(spark, base, fixed.RESULT_LEVELS):
        levels = readers.read_result(spark, base, fixed.RESULT_LEVELS, schemas.SEVERITY_LEVELS)
        tables["severity_mix"] = levels.orderBy(F.desc("Total_Logs"), "Level")
        tables["severity_summary"] = severity.severity_summary(levels)
    if readers.has_result(spark, base, fixed.RESULT_TEMPLATES):
        actions = readers.read_result(spark, base, fixed.RESULT_TEMPLATES, schemas.TOP_TEMPLATES)
        tables["template_concentration"] = templates.template_concentration(actions)
    if timings is not None:
        tables["stage_timings"] = stages.ordered_timings(timings)
        tables["stage_speedup"] = stages.stage_speedup(timings)
    return tables


def _hours(hours: DataFrame, selected: Sequence[str], simplified: bool) -> dict[str, DataFrame]:
    tables = {}
    scaler = anomaly.Scaler.fit(anomaly.complete_rows(hours))
    charted = [name for name in selected if name in fixed.COMPONENTS]
    if charted and scaler.rows:
        tables["indexed_trend"] = hourly.indexed_trend(hours, charted)
    if scaler.rows >= 2:
        scores = anomaly.with_status(anomaly.anomaly_scores(hours, scaler=scaler))
        tables["anomaly_windows"] = anomaly.flagged(scores) if simplified else scores
        tables["anomaly_kpis"] = anomaly.anomaly_kpis(scores)
        tables["anomaly_triage"] = anomaly.anomaly_triage(scores, fixed.TRIAGE_ROWS_SIMPLIFIED if simplified else fixed.TRIAGE_ROWS)
    return tables


def run(spark: SparkSession, base: str, results: str, timings_path: str | None = None, **options) -> dict[str, float]:
    """Write every report table whole under ``results``, named ``report_<table>``, and return the seconds per table."""
    timings = None
    if timings_path is not None and readers.exists(spark, timings_path):
        timings = spark.read.schema(schemas.STAGE_TIMINGS).parquet(timings_path)
    with job_tables(spark):
        tables = build(spark, base, timings=timings, **options)
        return {name: sinks.export(spark, table, fixed.REPORT_PREFIX + name, results) for name, table in tables.items()}
