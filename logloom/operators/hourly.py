"""Hourly feature rows and the trend derived from them."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions import fixed
from logloom.operators.system_log import SKETCH_PRECISION, with_hour


def hourly_features(
    lines: DataFrame,
    components: Sequence[str] = fixed.COMPONENTS,
    ratio_of: str | None = None,
    weight: str | None = None,
    closed: bool = True,
    exact: bool = True,
) -> DataFrame:
    """One row per hour that has lines: totals, counts per component, distinct templates and components, and
    the share of the component ``ratio_of``, by default the last listed.

    ``closed`` says that ``Component`` holds nothing but ``components`` and ``''``, which is what the parser
    produces. Distinct components are then a sum of presence flags and the template count is the only distinct
    aggregate, so Spark need not copy every row per distinct aggregate. Other values are refused at run time;
    ``closed=False`` counts any.
    ``exact=False`` estimates the number of templates and saves shuffling them.
    """
    hours = lines if "Hour_Window" in lines.columns else with_hour(lines)
    component, ratio_of = F.col("Component"), ratio_of or components[-1]
    # Lines without a valid time form a group that counts nothing and is dropped afterwards: a row filter on the
    # hour would be pushed into the scan and work out the time of every line a second time.
    each = F.col("Hour_Window").isNotNull().cast("bigint") if weight is None else F.col(weight)
    total = F.count("Hour_Window") if weight is None else F.sum(F.when(F.col("Hour_Window").isNotNull(), each))
    counts = {name: F.sum(F.when(component == name, each).otherwise(0)) for name in components}
    if closed:
        active = _listed_components(component, ("", *components))
    else:
        active = F.count_distinct(component)
    templates = F.count_distinct if exact else F.approx_count_distinct
    return (
        hours.groupBy("Hour_Window")
        .agg(
            total.alias("Total_Logs"),
            *[count.alias(f"{name}_Count") for name, count in counts.items()],
            templates("EventTemplate").alias("Unique_Templates"),
            active.alias("Active_Components"),
            F.round(F.try_divide(counts[ratio_of].cast("double"), total), 4).alias(f"{ratio_of}_Ratio"),
        )
        .filter(F.col("Total_Logs") > 0)
        .orderBy("Hour_Window")
    )


def hourly_sketches(
    lines: DataFrame, components: Sequence[str] = fixed.COMPONENTS, weight: str | None = None, precision: int = SKETCH_PRECISION
) -> DataFrame:
    """Hours as they are stored to be added up later: counts, lines per listed component, and a sketch of the templates.

    ``Component_Lines`` counts the lines of ``''`` and of each listed component, in this order; ``Templates_Sketch`` is a mergeable
    sketch of ``2 ** precision`` registers, so an hour is one row of bounded size however many templates it has. Rows of several runs over different
    lines are made one by :func:`merged_hours`. Only listed components may occur. ``lines`` may be a bounded summary, whose sketches are united.
    """
    known = "Templates_Sketch" in lines.columns
    templates = F.hll_union_agg("Templates_Sketch", F.lit(False)) if known else F.hll_sketch_agg("EventTemplate", precision)
    hours = lines if "Hour_Window" in lines.columns else with_hour(lines)
    timed, listed = F.col("Hour_Window").isNotNull(), ("", *components)
    each = F.when(timed, F.lit(1) if weight is None else F.col(weight)).otherwise(0).cast("bigint")
    held = [F.sum(F.when(F.col("Component") == name, each).otherwise(0)) for name in listed]
    return (
        hours.groupBy("Hour_Window")
        .agg(
            F.sum(each).alias("Total_Logs"),
            F.array(*held).alias("Component_Lines"),
            _listed_components(F.col("Component"), listed).alias("Listed"),  # refuses others
            templates.alias("Templates_Sketch"),
        )
        .filter("Hour_Window IS NOT NULL AND Listed >= 0")
        .drop("Listed")
    )


def merged_hours(
    parts: DataFrame, components: Sequence[str] = fixed.COMPONENTS, ratio_of: str | None = None
) -> DataFrame:
    """Hourly features from the :func:`hourly_sketches` of one or more runs; templates are estimated, all else is exact.

    The relative standard error of ``Unique_Templates`` is below ``1.04 / sqrt(2 ** precision)``, merged or not.
    """
    ratio_of = ratio_of or components[-1]
    lines = [F.sum(F.get("Component_Lines", F.lit(place))) for place in range(len(components) + 1)]
    counts = dict(zip(("", *components), lines))
    total = F.sum("Total_Logs")
    active = sum((F.when(n > 0, 1).otherwise(0) for n in lines[1:]), F.when(lines[0] > 0, 1).otherwise(0))
    return (
        parts.groupBy("Hour_Window")
        .agg(
            total.alias("Total_Logs"),
            *[counts[name].alias(f"{name}_Count") for name in components],
            F.hll_sketch_estimate(F.hll_union_agg("Templates_Sketch", F.lit(False))).alias("Unique_Templates"),
            active.cast("bigint").alias("Active_Components"),
            F.round(F.try_divide(counts[ratio_of].cast("double"), total), 4).alias(f"{ratio_of}_Ratio"),
        )
        .orderBy("Hour_Window")
    )


def _listed_components(component: Column, listed: Sequence[str]) -> Column:
    """How many of the listed names occur in a group; an error if any other does."""
    present = [F.max(F.when(component == name, 1).otherwise(0)) for name in listed]
    unlisted = F.max(F.when(component.isin(*listed), 0).when(component.isNotNull(), 1).otherwise(0))
    refusal = F.raise_error(F.lit(f"components other than {list(listed)}: list them or pass closed=False"))
    return F.when(unlisted == 1, refusal.cast("bigint")).otherwise(sum(present[1:], present[0]).cast("bigint"))


def component_series(hours: DataFrame, components: Sequence[str] = fixed.COMPONENTS) -> DataFrame:
    """Hourly counts as one row per hour and component, for those components that have a count column."""
    present = {f"{name}_Count": name for name in components if f"{name}_Count" in hours.columns}
    if not present:
        raise ValueError(f"no hourly counts for components {list(components)}")
    long = hours.unpivot(["Hour_Window"], list(present), "Count_Column", "Line_Count")
    name = F.create_map(*[F.lit(text) for pair in present.items() for text in pair])[F.col("Count_Column")]
    return long.select("Hour_Window", name.alias("Component"), "Line_Count")


def indexed_trend(hours: DataFrame, components: Sequence[str] = fixed.COMPONENTS) -> DataFrame:
    """Each component's hourly counts, as a percentage of its count in the first hour of the table.

    A component that has no lines in the first hour has no series.
    """
    series = component_series(hours, components)
    base = series.groupBy("Component").agg(F.min_by("Line_Count", "Hour_Window").alias("Base"))
    return (
        series.join(F.broadcast(base.filter(F.col("Base") != 0)), "Component")
        .select(
            "Hour_Window",
            "Component",
            (F.col("Line_Count") / F.col("Base") * 100).alias("Indexed"),
        )
        .orderBy("Component", "Hour_Window")
    )
