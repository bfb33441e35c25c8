"""The server-metric job: errors and above-average memory per server."""

from pyspark.sql import DataFrame, SparkSession

from logloom.functions import fixed
from logloom.operators import server_metrics
from logloom.sources import readers, sinks
from logloom.sources.durable import durable, job_tables
from logloom.sources.options import BatchOptions

DEFAULT_INPUT = "/raw_logs/generated_logs"
VIEW = "server_logs"


def build(spark: SparkSession, options: BatchOptions) -> dict[str, DataFrame]:
    """Both reports as tables by name.

    The text is parsed once, to counts per server, level and memory value; these are stored and serve both. The parsed
    lines are also there for SQL, as view ``server_logs``.
    """
    lines = readers.read_lines(spark, options.source, options.max_input_rows)
    metrics = sinks.register_view(server_metrics.parse_server_metrics(lines), VIEW)
    summary = durable(server_metrics.summarise(metrics), "metric-summary")
    return {
        fixed.RESULT_SERVER_ERRORS: server_metrics.errors_by_server(summary, weight=server_metrics.LINE_COUNT),
        fixed.RESULT_SERVER_MEMORY: server_metrics.memory_over_average(summary, weight=server_metrics.LINE_COUNT),
    }


def run(spark: SparkSession, options: BatchOptions) -> dict[str, float]:
    """Write both reports whole under the results base and return the seconds per table."""
    with job_tables(spark):
        return {
            name: sinks.export(spark, table, name, options.results, options.mirror_base)
            for name, table in build(spark, options).items()
        }
