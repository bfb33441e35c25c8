"""Queries by name; each takes a session and the folder of the given tables."""

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom import schemas
from logloom.functions import fixed
from logloom.operators import (
    anomaly,
    components,
    guards,
    hourly,
    server_metrics,
    severity,
    stages,
    system_log,
    templates,
    volume,
)
from logloom.operators.isolation_forest import ForestModel, average_path, fit_forest
from logloom.plans import metrics_batch, report, system_batch
from logloom.registry import event_source as source
from logloom.sources import files, readers, sinks
from logloom.sources.durable import durable, scratch_path
from logloom.sources.options import BatchOptions

Query = Callable[[SparkSession, str], DataFrame]
SELECTED, BENCHMARK = ("CBS", "CSI", "SQM", fixed.UNLABELED), "CSI"
ROW_CAP = 2500
ODD_FILES = ("a b", "c#d", "e%20f", "g+h", "i[j]", "k{l}", "ö")
SKETCH_ERROR = 0.07


def stored_lines(spark: SparkSession, sf_dir: str, files: int | None = None) -> str:
    path = scratch_path(spark, "system-lines")
    sinks.write_lines(source.system_lines(source.events(spark, sf_dir)), path, files)
    return path


# Sources and sinks


def scan_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_lines(spark, stored_lines(spark, sf_dir))


def scan_text_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "metric-lines")
    sinks.write_lines(source.metric_lines(source.events(spark, sf_dir)), path, files=5)
    return readers.read_lines(spark, path)


def scan_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ordered-lines")
    ordered = source.events(spark, sf_dir).repartitionByRange(7, "event_id").sortWithinPartitions("event_id")
    sinks.write_lines(source.system_lines(ordered), path)
    parts = sorted(files.plain_name(name) for name in spark.read.text(path).inputFiles())
    # Names that a scan writes in another way than a file system does.
    for number, (part, odd) in enumerate(zip(parts, ODD_FILES, strict=False)):
        files.rename(spark, part, f"{path}/{number} {odd}.log")
    return readers.read_lines(spark, path, max_rows=ROW_CAP)


def scan_first_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the first of three folders that holds data: one is missing, one has a result without data."""
    missing, empty, full = (scratch_path(spark, name) for name in ("missing", "empty", "full"))
    sinks.export(spark, spark.createDataFrame([], schemas.SEVERITY_LEVELS).limit(0), fixed.RESULT_LEVELS, empty)
    files.delete(spark, readers.result_path(empty, fixed.RESULT_LEVELS))
    sinks.export(spark, severity_levels(spark, sf_dir), fixed.RESULT_LEVELS, full)
    return readers.read_result(spark, readers.resolve_base(spark, [missing, empty, full]), fixed.RESULT_LEVELS, schemas.SEVERITY_LEVELS)


def scan_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that passes its guard, and one that does not and counts as empty."""
    levels = severity_levels(spark, sf_dir)
    other = levels.withColumnRenamed("Total_Logs", "Logs")
    return guards.or_empty(levels, schemas.SEVERITY_LEVELS).unionByName(guards.or_empty(other, schemas.SEVERITY_LEVELS))


def sink_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result whose replacement fails while it is written: the old one is still there."""
    base = scratch_path(spark, "results")
    volumes = component_volume(spark, sf_dir)
    sinks.export(spark, volumes, fixed.RESULT_COMPONENTS, base)
    stop = F.raise_error(F.lit("stops here")).cast("bigint")
    try:
        sinks.export(spark, volumes.withColumn("Total_Logs", F.when(F.col("Component") == "", stop).otherwise(0)), fixed.RESULT_COMPONENTS, base)
    except PySparkException as problem:
        if "stops here" not in str(problem):
            raise
    return readers.read_result(spark, base, fixed.RESULT_COMPONENTS, schemas.COMPONENT_VOLUME)


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each result of the batch job, counted while it was written."""
    options = BatchOptions("", stored_lines(spark, sf_dir, files=5), 0, scratch_path(spark, "results"))
    path = scratch_path(spark, "metrics")
    system_batch.run(spark, options, setup=fixed.WORKER_SETUPS[0], metrics_path=path)
    metrics = spark.read.schema(schemas.RUN_METRICS).parquet(path)
    return metrics.select("Process", "Worker Setup", "Rows", (F.col("Bytes") > 0).alias("Has_Bytes"))


def batch_from_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job with its locations and row cap from environment-style settings; its copy of the largest result."""
    settings = {
        "HDFS_NAMENODE": "", "LOG_INPUT_PATH": stored_lines(spark, sf_dir, files=5), "MAX_INPUT_ROWS": "0",
        "HDFS_OUTPUT_BASE": scratch_path(spark, "results"), "LOCAL_OUTPUT_BASE": scratch_path(spark, "mirror"),
    }
    options = BatchOptions.from_mapping(settings)
    system_batch.run(spark, options)
    return readers.read_result(spark, options.mirror_base, fixed.RESULT_COMPONENTS, schemas.COMPONENT_VOLUME)


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "results")
    sinks.export(spark, component_volume(spark, sf_dir), fixed.RESULT_COMPONENTS, base)
    return readers.read_result(spark, base, fixed.RESULT_COMPONENTS, schemas.COMPONENT_VOLUME)


def scan_or_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "results")
    sinks.export(spark, severity_levels(spark, sf_dir), fixed.RESULT_LEVELS, base)
    found = readers.read_result(spark, base, fixed.RESULT_LEVELS, schemas.SEVERITY_LEVELS)
    missing = readers.read_result(spark, base, "no_such_result", schemas.SEVERITY_LEVELS)
    return found.unionByName(missing)


def sink_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "results")
    table = hourly_features(spark, sf_dir)
    for _ in range(2):  # the second run replaces the first
        sinks.export(spark, table, fixed.RESULT_HOURS, base)
    return readers.read_result(spark, base, fixed.RESULT_HOURS, schemas.HOURLY_FEATURES)


def sink_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, mirror = scratch_path(spark, "results"), scratch_path(spark, "mirror")
    sinks.register_view(source.parsed_system(spark, sf_dir), "windows_logs")
    text = "SELECT EventTemplate, count(*) AS Actions FROM windows_logs GROUP BY EventTemplate"
    sinks.export(spark, text, fixed.RESULT_TEMPLATES, base, mirror)
    return readers.read_result(spark, mirror, fixed.RESULT_TEMPLATES, schemas.TOP_TEMPLATES)


def sink_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "metric-lines")
    rows = source.metric_rows(source.events(spark, sf_dir))
    sinks.write_lines(server_metrics.render_server_metrics(rows), path, files=5)
    return server_metrics.parse_server_metrics(readers.read_lines(spark, path))


def system_batch_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch job over stored text; all four result tables in one."""
    options = BatchOptions(
        namenode="", input_path=stored_lines(spark, sf_dir, files=5), output_base=scratch_path(spark, "results")
    )
    system_batch.run(spark, options)
    return batch_tables(spark, options.results, F.col("Unique_Templates"))


def batch_tables(spark: SparkSession, base: str, of_hours: Column) -> DataFrame:
    def result(name: str, schema, key: str, count: Column) -> DataFrame:
        table = readers.read_result(spark, base, name, schema)
        return table.select(F.lit(name).alias("Result"), F.col(key).cast("string").alias("Key"), count.alias("Line_Count"))

    return (
        result(fixed.RESULT_COMPONENTS, schemas.COMPONENT_VOLUME, "Component", F.col("Total_Logs"))
        .unionByName(result(fixed.RESULT_LEVELS, schemas.SEVERITY_LEVELS, "Level", F.col("Total_Logs")))
        .unionByName(result(fixed.RESULT_TEMPLATES, schemas.TOP_TEMPLATES, "EventTemplate", F.col("Actions")))
        .unionByName(result(fixed.RESULT_HOURS, schemas.HOURLY_FEATURES, "Hour_Window", of_hours))
    )


def bounded_batch_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job with a summary that holds no template; of the hours the lines, which are exact, since the number of templates is not."""
    base = scratch_path(spark, "results")
    system_batch.run(spark, BatchOptions("", stored_lines(spark, sf_dir, files=5), 0, base), bounded=True)
    return batch_tables(spark, base, F.col("Total_Logs"))


def metrics_batch_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The server-metric job over stored text; both stored tables in one."""
    path = scratch_path(spark, "metric-lines")
    sinks.write_lines(source.metric_lines(source.events(spark, sf_dir)), path, files=5)
    options = BatchOptions(namenode="", input_path=path, output_base=scratch_path(spark, "results"))
    metrics_batch.run(spark, options)
    errors = spark.read.parquet(readers.result_path(options.results, fixed.RESULT_SERVER_ERRORS))
    memory = spark.read.parquet(readers.result_path(options.results, fixed.RESULT_SERVER_MEMORY))
    none = F.lit(None).cast("double").alias("Peak")
    return errors.select(F.lit("errors").alias("Result"), "Server", F.col("Total_errors").alias("Lines"), none).unionByName(
        memory.select(F.lit("memory").alias("Result"), "Server", F.col("times_over_avg").alias("Lines"), F.col("peak_memory_gb").alias("Peak"))
    )


def report_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job and the report job over stored text; stored report tables in one."""
    base = scratch_path(spark, "results")
    system_batch.run(spark, BatchOptions(namenode="", input_path=stored_lines(spark, sf_dir, files=5), output_base=base))
    report.run(spark, base, base)

    def table(name: str, key: str, value: str) -> DataFrame:
        stored = spark.read.parquet(readers.result_path(base, fixed.REPORT_PREFIX + name))
        rounded = F.round(F.col(f"`{value}`").cast("double"), 6)
        return stored.select(F.lit(name).alias("Report"), F.expr(key).cast("string").alias("Key"), rounded.alias("Value"))

    return reduce(
        DataFrame.unionByName,
        [
            table("component_comparison", "Component", fixed.TITLE_SHARE),
            table("component_metric", "Component", "Value"),
            table("component_share", "Component", "SelectedSharePct"),
            table("severity_mix", "Level", "Total_Logs"),
            table("severity_summary", "Error_Text", "Error_Pct"),
            table("template_concentration", "Short_Name", "Actions"),
            table("indexed_trend", "concat_ws(' ', Component, Hour_Window)", "Indexed"),
            table("anomaly_kpis", "'windows'", "Total_Windows"),
        ],
    )


# Parsing


def parse_system_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.parsed_system(spark, sf_dir)


def parse_odd_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = source.odd_lines(source.events(spark, sf_dir))
    return system_log.parse_system_log(lines, tuple(source.ODD_NAMES.values()))


def event_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.parsed_system(spark, sf_dir).select("Content", "EventTemplate")


def assemble_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return system_log.with_timestamp(source.parsed_system(spark, sf_dir)).select("Date", "Time", "Timestamp")


def parse_server_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.parsed_metrics(spark, sf_dir)


def classify_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source.metric_rows(source.events(spark, sf_dir)).drop("Level")
    return server_metrics.classify_severity(rows).select("event_id", "CPU (%)", "Response Time (ms)", "Level")


# Aggregates


def component_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return volume.component_volume(source.parsed_system(spark, sf_dir))


def severity_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return volume.severity_levels(source.parsed_system(spark, sf_dir))


def top_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return volume.top_templates(source.parsed_system(spark, sf_dir))


def top_mostly_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent of mostly unique templates: by counters that separate them from the rest, and by ones that are too few and fall back."""
    parsed = source.parsed_system(spark, sf_dir)
    unique = F.when(F.length("Content") % 3 == 0, F.concat(F.lit("at "), "Time")).otherwise(F.col("Content"))
    stored = durable(parsed.select(F.when(F.length("Content") % 2 == 0, F.col("Component")).otherwise(unique).alias("EventTemplate")), "templates")
    ways = {"counters": volume.frequent_templates(stored, 3, counters=512), "all values": volume.frequent_templates(stored, 3, counters=2)}
    return reduce(DataFrame.unionByName, [table.withColumn("Way", F.lit(way)) for way, table in ways.items()])


def hours_of_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours stored by two runs over different lines and added up, next to the exact hours; templates agree within the stated error."""
    path, found = scratch_path(spark, "hour-sketches"), source.events(spark, sf_dir)
    for half in range(2):
        lines = source.system_lines(found.filter(F.col("event_id") % 2 == half))
        hourly.hourly_sketches(system_log.parse_system_log(lines)).write.mode("append").parquet(path)
    merged = hourly.merged_hours(spark.read.parquet(path))
    exact = hourly_features(spark, sf_dir).select("Hour_Window", F.col("Unique_Templates").alias("Exact"))
    near = F.abs(F.col("Unique_Templates") - F.col("Exact")) <= F.lit(SKETCH_ERROR) * F.col("Exact") + 1
    return merged.join(exact, "Hour_Window").withColumn("Within", near).drop("Unique_Templates", "Exact")


def hourly_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly.hourly_features(source.parsed_system(spark, sf_dir))


def errors_by_server(spark: SparkSession, sf_dir: str) -> DataFrame:
    return server_metrics.errors_by_server(source.parsed_metrics(spark, sf_dir))


def memory_over_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = durable(server_metrics.summarise(source.parsed_metrics(spark, sf_dir)), "metric-summary")
    return server_metrics.memory_over_average(summary, weight=server_metrics.LINE_COUNT)


# Report


def wide_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return volume.component_volume(source.parsed_system(spark, sf_dir, components=source.WIDE_COMPONENTS))


def component_share_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.with_share_and_rank(wide_volume(spark, sf_dir))


def default_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.default_selection(component_share_rank(spark, sf_dir))


def benchmark_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.compare_to_benchmark(component_share_rank(spark, sf_dir), SELECTED, BENCHMARK)


def component_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.comparison_table(benchmark_compare(spark, sf_dir))


def component_metric_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = durable(benchmark_compare(spark, sf_dir), "compared")
    views = [
        components.metric_view(compared, relative).select(
            F.lit(name).alias("View"), "Component", F.col("Value").cast("double").alias("Value")
        )
        for name, relative in (("Absolute", False), ("Relative", True))
    ]
    return views[0].unionByName(views[1])


def component_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.cards(benchmark_compare(spark, sf_dir), BENCHMARK)


def selected_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Stored first, as in the report: else the selection would be pushed down into the parsing of every line.
    stored = durable(component_share_rank(spark, sf_dir), "ranked")
    return components.selected_share(stored, SELECTED)


def indexed_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly.indexed_trend(durable(hourly_features(spark, sf_dir), "hours"))


def severity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return severity.severity_summary(severity_levels(spark, sf_dir))


def template_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.template_concentration(top_templates(spark, sf_dir))


def stage_timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.ordered_timings(source.stage_runs(source.events(spark, sf_dir)))


def timings_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A timings table that several runs have added to, read back."""
    path = scratch_path(spark, "timings")
    runs: dict[str, dict[str, float]] = {}
    for row in source.stage_runs(source.events(spark, sf_dir)).collect():  # one row per stage and setup
        runs.setdefault(row["Worker Setup"], {})[row["Process"]] = row["Seconds"]
    for setup, seconds in runs.items():
        sinks.append_timings(spark, path, setup, seconds)
    return stages.ordered_timings(spark.read.schema(schemas.STAGE_TIMINGS).parquet(path))


def stage_speedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.stage_speedup(source.stage_runs(source.events(spark, sf_dir)))


# Anomaly model


def stored_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return durable(hourly_features(spark, sf_dir), "hours")


def standardize_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = stored_hours(spark, sf_dir)
    scaled = anomaly.Scaler.fit(hours).transform(hours)
    return scaled.select("Hour_Window", *[F.round(f"{name}_Z", 6).alias(f"{name}_Z") for name in fixed.FEATURES])


def contamination_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.contamination_tier(hourly_features(spark, sf_dir))


def quantile_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = stored_hours(spark, sf_dir).select("Hour_Window", F.col("Total_Logs").cast("double").alias("Raw"))
    return anomaly.flag_lowest(hours, "Raw", fixed.CONTAMINATION_DEFAULT, "Score", "Flag").withColumn(
        "Score", F.round("Score", 6)
    )


def quantile_fenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quantiles of a whole column by narrowing the range, never by gathering its values."""
    values = source.events(spark, sf_dir).select("value")
    shares = (0.01, 0.03, 0.5, 0.97)
    found = [(share, round(anomaly.quantile(values, "value", share, exact_rows=100), 6)) for share in shares]
    return spark.createDataFrame(found, "Share double, Quantile double")


def rule_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours scored by their number of lines: what follows a score does not depend on where it comes from."""
    raw = stored_hours(spark, sf_dir).withColumn("Raw", F.col("Total_Logs").cast("double"))
    share = fixed.CONTAMINATION_DEFAULT
    flagged = anomaly.flag_lowest(raw, "Raw", share, "Anomaly_Score", "Is_Anomaly").drop("Raw")
    return flagged.withColumn("Anomaly_Score", F.round("Anomaly_Score", 6))


def status_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.with_status(rule_scores(spark, sf_dir))


def flags_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.flagged(rule_scores(spark, sf_dir))


def kpis_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.anomaly_kpis(rule_scores(spark, sf_dir))


def triage_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.anomaly_triage(rule_scores(spark, sf_dir))


#: Two trees written by hand. Inner nodes: feature, threshold, left child (the right one follows); leaves: path length.
HAND_FOREST = ForestModel(
    features=("Total_Logs", "CSI_Count"),
    sample=8,
    depth_limit=2,
    nodes={
        "roots": np.array([0, 3]),
        "feature": np.array([0, 0, 0, 1, 0, 0, 0, 0]),
        "threshold": np.array([14.0, np.inf, np.inf, 2.0, np.inf, 20.0, np.inf, np.inf]),
        "left": np.array([1, 1, 2, 4, 4, 6, 6, 7]),
        "path_length": np.array([0.0, 1.5, 2.25, 0.0, 1.0, 0.0, 2.0, 3.0]),
    },
)


def forest_by_hand(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = HAND_FOREST.score(stored_hours(spark, sf_dir))
    return scored.select("Hour_Window", F.round("Raw_Score", 9).alias("Raw_Score"))


def forest_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What defines an isolation tree, tree by tree, of a forest whose trees draw from disjoint parts of the events."""
    rows = source.events(spark, sf_dir).select("event_id", F.col("user_id").cast("double").alias("u"), F.col("value").cast("double").alias("v")).dropna()
    trees, sample = 8, 32
    model = fit_forest(rows, ["u", "v"], ["event_id"], trees=trees, sample=sample, once=True)
    nodes = durable(model.table(spark), "nodes")
    low, high = (rows.agg(*[how(c).alias(f"{name}_{c}") for c in ("u", "v")]) for how, name in ((F.min, "low"), (F.max, "high")))
    inner = F.col("left") != F.col("node")
    bounds = nodes.crossJoin(F.broadcast(low)).crossJoin(F.broadcast(high))  # one row each
    inside = F.when(F.col("feature") == 0, F.col("threshold").between(F.col("low_u"), F.col("high_u"))).otherwise(F.col("threshold").between(F.col("low_v"), F.col("high_v")))
    return bounds.groupBy("tree_id").agg(
        (F.sum((~inner).cast("int")) - F.sum(inner.cast("int"))).alias("Leaves_Over_Splits"),
        F.coalesce(F.every(F.when(inner, inside)), F.lit(True)).alias("Splits_In_Range"),
        F.every(F.when(~inner, F.col("path_length") <= model.depth_limit + average_path(np.array([sample]))[0])).alias("Depth_Limited"),
        (F.sum((~inner).cast("int")) <= sample).alias("Leaves_Fit_Sample"),
    )


def anomaly_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.anomaly_scores(stored_hours(spark, sf_dir))


def anomaly_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.flagged(anomaly_scores(spark, sf_dir))


def anomaly_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.with_status(anomaly_scores(spark, sf_dir))


def anomaly_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.anomaly_kpis(anomaly_scores(spark, sf_dir))


def anomaly_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.anomaly_triage(anomaly_scores(spark, sf_dir))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        scan_text, scan_text_dir, scan_limit, scan_parquet, scan_or_empty, scan_first_base, scan_guarded,
        sink_replaced, run_metrics, batch_from_mapping, bounded_batch_results, top_mostly_unique, hours_of_two_runs, forest_properties,
        sink_parquet_roundtrip, sink_mirror, sink_text_roundtrip, system_batch_results,
        metrics_batch_results, report_results, parse_odd_names, timings_appended,
        parse_system_log, event_template, assemble_timestamp, parse_server_metrics, classify_severity,
        component_volume, severity_levels, top_templates, hourly_features, errors_by_server, memory_over_average,
        component_share_rank, default_components, benchmark_compare, component_table, component_metric_view,
        component_cards, selected_share, indexed_trend, severity_summary, template_concentration,
        stage_timings, stage_speedup,
        standardize_features, contamination_tier, quantile_threshold,
        quantile_fenced, status_by_rule, flags_by_rule, kpis_by_rule, triage_by_rule, forest_by_hand,
        anomaly_scores, anomaly_flags, anomaly_status, anomaly_kpis, anomaly_triage,
    )
}
