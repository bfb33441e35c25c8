"""Raw system-log lines to columns."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions import fixed, text, times

#: A sketch of distinct templates has 2 to the power of this registers: a relative standard error below 1.7 %.
SKETCH_PRECISION = 12


def parse_system_log(
    lines: DataFrame,
    components: Sequence[str] = fixed.COMPONENTS,
    levels: Sequence[str] = fixed.LEVELS,
) -> DataFrame:
    """One row per line that starts with a date; a field that is not in the line is ``''``.

    The result is a plain projection, so a query that needs two of the columns evaluates only those two.
    """
    line = F.col("value")
    fields = lines.select(
        text.leading_date(line).alias("Date"),
        text.leading_time(line).alias("Time"),
        text.word_after_comma(line, levels).alias("Level"),
        text.first_word(line, components).alias("Component"),
        text.text_after_word(line, components).alias("Content"),
    )
    return with_event_template(fields.filter(F.col("Date") != ""))


def with_event_template(messages: DataFrame, source: str = "Content", target: str = "EventTemplate") -> DataFrame:
    """Add the message with its hex values, numbers and ids replaced by placeholders."""
    current, names = F.col(source), []
    steps = messages
    for number, (pattern, replacement, needed) in enumerate(fixed.TEMPLATE_RULES):
        replaced = F.regexp_replace(current, pattern, replacement)
        if needed is not None:
            replaced = F.when(current.contains(needed), replaced).otherwise(current)
        name = f"{target}_step_{number}"
        steps, current = steps.withColumn(name, replaced), F.col(name)
        names.append(name)
    return steps.withColumn(target, F.trim(current)).drop(*names)


def with_timestamp(parsed: DataFrame) -> DataFrame:
    """Add ``Timestamp``; null where date and time do not form a valid one."""
    return parsed.withColumn("Timestamp", times.timestamp_of(F.col("Date"), F.col("Time")))


def with_hour(parsed: DataFrame) -> DataFrame:
    """Add ``Hour_Window``; null where the line has no valid timestamp."""
    return parsed.withColumn("Hour_Window", times.hour_of(F.col("Date"), F.col("Time")))


def summarise(parsed: DataFrame) -> DataFrame:
    """Line counts per hour, level, component and template.

    Every system-log result is an aggregate of this table, so one scan of the text serves all of them. Counts
    are combined before the shuffle and the shuffle key contains the template, so a crowded hour is spread and
    a frequent template arrives as one row per task.
    """
    return (
        with_hour(parsed)
        .groupBy("Hour_Window", "Level", "Component", "EventTemplate")
        .agg(F.count(F.lit(1)).alias("Line_Count"))
    )


def bounded_summary(parsed: DataFrame, precision: int = SKETCH_PRECISION) -> DataFrame:
    """Line counts per hour, level and component, with a sketch of the templates of each.

    For text whose templates are mostly unique, of which :func:`summarise` is as large as the text: here it has a row of bounded size per hour,
    level and component. It serves every result but the most frequent templates; the number of distinct ones is an estimate (see
    :func:`logloom.operators.hourly.merged_hours`).
    """
    return (
        with_hour(parsed)
        .groupBy("Hour_Window", "Level", "Component")
        .agg(F.count(F.lit(1)).alias("Line_Count"), F.hll_sketch_agg("EventTemplate", precision).alias("Templates_Sketch"))
    )
