"""Volume and hourly aggregates: small cases, and equalities that must hold on any input."""

import pytest
from pyspark.errors import PySparkException

from logloom.operators import hourly, system_log, volume
from logloom.registry import event_source

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def parsed(spark):
    return event_source.parsed_system(spark, SF_DIR).cache()


@pytest.fixture(scope="module")
def summary(parsed):
    return system_log.summarise(parsed).cache()


def rows(table):
    return [tuple(row) for row in table.collect()]


def plan(table):
    return table._jdf.queryExecution().executedPlan().toString()


def test_summary_serves_all_four_results(parsed, summary):
    for result in (volume.component_volume, volume.severity_levels, volume.top_templates, hourly.hourly_features):
        assert rows(result(parsed)) == rows(result(summary, weight="Line_Count"))


def test_known_component_list_changes_nothing(parsed):
    assert rows(hourly.hourly_features(parsed)) == rows(hourly.hourly_features(parsed, closed=False))


def test_unlisted_components_are_counted_on_request(spark):
    lines = spark.createDataFrame(
        [("2020-01-01", "01:02:03", name, "t") for name in ("CBS", "DISM", "DPX", "")],
        "Date string, Time string, Component string, EventTemplate string",
    )
    assert hourly.hourly_features(lines, closed=False).first().Active_Components == 4
    assert hourly.hourly_features(lines, components=("DISM", "DPX", "CBS")).first().Active_Components == 4
    with pytest.raises(PySparkException, match="closed=False"):
        hourly.hourly_features(lines).collect()


def test_totals(parsed):
    features = hourly.hourly_features(parsed).collect()
    assert sum(row.Total_Logs for row in volume.component_volume(parsed).collect()) == parsed.count()
    assert all(row.CBS_Count + row.CSI_Count <= row.Total_Logs for row in features)
    valid = system_log.with_timestamp(parsed).filter("Timestamp IS NOT NULL").count()
    assert sum(row.Total_Logs for row in features) == valid < parsed.count()


def test_estimated_templates_are_close(parsed):
    exact = {row.Hour_Window: row.Unique_Templates for row in hourly.hourly_features(parsed).collect()}
    for row in hourly.hourly_features(parsed, exact=False).collect():
        assert abs(row.Unique_Templates - exact[row.Hour_Window]) <= max(1, 0.2 * exact[row.Hour_Window])


def test_unlabelled_lines_count_as_a_component_and_a_template(lines_of):
    lines = lines_of("2020-01-01 01:00:00, Info other", "2020-01-01 01:59:59, Info CBS x", "2020-01-01 99:00:00, Info CSI y")
    (row,) = hourly.hourly_features(system_log.parse_system_log(lines)).collect()
    assert tuple(row)[1:] == (2, 1, 0, 2, 2, 0.0)


def test_ratio_rounds_half_up(spark):
    lines = spark.createDataFrame(
        [("2020-01-01", "01:02:03", "CSI" if i < 1 else "CBS", "t") for i in range(32)],
        "Date string, Time string, Component string, EventTemplate string",
    )
    assert hourly.hourly_features(lines).first().CSI_Ratio == 0.0313  # 1/32 = 0.03125


def test_ties_are_ordered_by_key(lines_of):
    parsed = system_log.parse_system_log(lines_of("2020-01-01 x CBS b", "2020-01-01 x CBS a", "2020-01-01 x CBS c"))
    assert rows(volume.top_templates(parsed, 2)) == [("a", 1), ("b", 1)]


def hours(spark, *values):
    return spark.createDataFrame(
        [(f"2020-01-01 0{hour}:00:00", cbs, csi) for hour, cbs, csi in values],
        "Hour_Window string, CBS_Count bigint, CSI_Count bigint",
    ).selectExpr("cast(Hour_Window AS timestamp_ntz) AS Hour_Window", "CBS_Count", "CSI_Count")


def test_trend_is_relative_to_the_first_hour(spark):
    trend = hourly.indexed_trend(hours(spark, (2, 30, 4), (1, 20, 0), (3, 0, 9))).collect()
    # CSI is zero in the first hour and has no series although later hours have lines.
    assert [(row.Component, row.Indexed) for row in trend] == [("CBS", 100.0), ("CBS", 150.0), ("CBS", 0.0)]


def test_trend_needs_a_known_component(spark):
    with pytest.raises(ValueError):
        hourly.indexed_trend(hours(spark, (1, 1, 1)), ["SQM"])


def test_plans(spark, parsed):
    lines = spark.read.text(SF_DIR)
    features = plan(hourly.hourly_features(system_log.parse_system_log(lines)))
    assert "Expand" not in features  # no row copies for several distinct counts
    assert features.count("Scan text") == 1
    volumes = plan(volume.component_volume(system_log.parse_system_log(lines)))
    assert "<HEX>" not in volumes and "Warning" not in volumes  # columns that are not needed are not parsed
    assert "TakeOrderedAndProject" in plan(volume.top_templates(system_log.parse_system_log(lines)))
    assert "Cartesian" not in features + volumes
