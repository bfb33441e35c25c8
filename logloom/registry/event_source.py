"""Log lines and metric rows made from the ``events`` table.

The lines cover what the parsers must cope with: lines without a date, impossible dates, missing times, level words
the parser does not know or finds only in the message, lines without a known component, short and empty fields.
Every event becomes one line; remainders of the event number only decide what its line looks like.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions import render
from logloom.operators import server_metrics, system_log

# A wider component list than the default, so that the report queries have something to compare.
WIDE_COMPONENTS = ("CBS", "CSI", "SQM", "DPX", "WUA", "TRI", "NET", "GPO")
# Names that mean something in a regular expression, and what they stand in for; one is the beginning of another.
ODD_NAMES = {"CBS": "C++", "CSI": "^SI", "SQM": "S.M", "DPX": "[DPX]", "WUA": "W|A", "TRI": "C+", "NET": "N\\T", "GPO": "(GPO"}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def system_lines(source: DataFrame) -> DataFrame:
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    head = (
        F.when(_every(97), "    continued")
        .when(_every(101), F.concat(F.substring(stamp, 1, 4), F.lit("-13"), F.substring(stamp, 8, 12)))
        .when(_every(103), F.substring(stamp, 1, 10))
        .otherwise(stamp)
    )
    level = (
        F.when(F.col("event_type") == "error", "Error")
        .when(F.col("event_type") == "signup", "Warning")
        .when((F.col("event_type") == "purchase") & (F.col("user_id") % 10 == 0), "Critical")
        .when(_every(107), "Notice")
        .otherwise("Info")
    )
    bucket = F.col("user_id") % 12
    component = F.when(bucket < 3, "CBS").when(bucket < 5, "CSI")
    for position, name in enumerate(WIDE_COMPONENTS[2:], start=5):
        component = component.when(bucket == position, name)
    component = component.otherwise("-")
    message = F.concat(
        F.lit("Session: "),
        F.col("event_id").cast("string"),
        F.lit(" "),
        F.col("event_type"),
        F.lit(" package_"),
        (F.col("user_id") % 50).cast("string"),
        F.lit(" hr 0x"),
        F.hex(F.col("event_id") + 2147483648),
        F.lit(" ref @"),
        F.lpad(F.lower(F.hex(F.col("event_id") * 7919)), 8, "0"),
        F.lit(" props "),
        F.col("props"),
        F.when(_every(109), ", Warning in CSI  again").otherwise(""),
    )
    separator = F.when(_every(89), " ").otherwise(", ")
    line = F.concat(head, separator, F.rpad(level, 22, " "), F.rpad(component, 7, " "), message)
    return source.select(line.alias("value"))


def odd_lines(source: DataFrame) -> DataFrame:
    value = F.col("value")
    for name, odd in ODD_NAMES.items():
        value = F.replace(value, F.lit(f" {name} "), F.lit(f" {odd} "))
    return system_lines(source).select(value.alias("value"))


def metric_rows(source: DataFrame) -> DataFrame:
    cpu, response = F.col("event_id") % 76 + 20, F.col("event_id") % 901 + 100
    return source.select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Time stamp"),
        F.concat(F.lit("SERVER_"), (F.col("user_id") % 3 + 1).cast("string")).alias("Server"),
        render.severity(cpu, response).alias("Level"),
        response.cast("int").alias("Response Time (ms)"),
        cpu.cast("int").alias("CPU (%)"),
        F.col("value").alias("Memory (GB)"),
        (F.col("event_id") % 451 + 50).cast("int").alias("Requests"),
    )


def metric_lines(source: DataFrame) -> DataFrame:
    rows = metric_rows(source)
    broken = (
        F.when(_every(97), "garbage line")
        .when(_every(101), F.concat_ws(" | ", "Time stamp", "Server", "Level", F.lit("Response Time = ms | CPU=70%")))
        .when(_every(103), F.replace("value", F.lit("ms |"), F.lit(".9ms |")))
        .otherwise(F.col("value"))
    )
    names = ("Time stamp", "Server", "Level", "Response Time (ms)", "CPU (%)", "Memory (GB)", "Requests")
    rendered = rows.withColumn("value", render.metric_line(*[F.col(name) for name in names]))
    return rendered.select(broken.alias("value"))


def parsed_system(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return system_log.parse_system_log(system_lines(events(spark, sf_dir)), **options)


def parsed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return server_metrics.parse_server_metrics(metric_lines(events(spark, sf_dir)))


def stage_runs(source: DataFrame) -> DataFrame:
    """Timings of stages, one of them unknown: the summed values of the event types, split over two setups by user."""
    stage = (
        F.when(F.col("event_type") == "click", "Component Volume")
        .when(F.col("event_type") == "view", "Severity Levels")
        .when(F.col("event_type") == "purchase", "Top Event Templates")
        .when(F.col("event_type") == "error", "Text Summary")
        .otherwise("Unknown Stage")
    )
    setup = F.when(F.col("user_id") % 3 == 0, "2 Worker Nodes").otherwise("1 Worker Node")
    seconds = F.sum(F.col("value").cast("decimal(18,2)")).cast("double")
    return source.groupBy(stage.alias("Process"), setup.alias("Worker Setup")).agg(seconds.alias("Seconds"))
