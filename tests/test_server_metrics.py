"""Server-metric lines and reports; the cases are those of FIXTURES.md."""

import pytest

from logloom.operators import server_metrics as metrics

CASES = [
    (
        "2026-01-01 00:00:00.123456 | SERVER_1 | ERROR | Response Time = 712ms | CPU=91% | Memory=3.25GB | Requests=77",
        ("SERVER_1", "ERROR", 712, 91, 3.25, 77),
    ),
    (
        "2026-01-01 00:00:01 | SERVER_2 | INFO | Response Time = 12.9ms | CPU=20% | Memory=1GB | Requests=50",
        ("SERVER_2", "INFO", 12, 20, 1.0, 50),
    ),
    ("garbage", (None,) * 6),
    ("2026-01-01 00:00:02 | SERVER_3 | WARNING | Response Time = ms | CPU=70%", ("SERVER_3", "WARNING", None, 70, None, None)),
    ("t | s | INFO | Response Time = -5ms | CPU=99999999999% | Memory=2.GB | Requests=0", ("s", "INFO", 5, None, 2.0, 0)),
]


def test_lines_of_the_format_description(lines_of):
    for line, expected in CASES:
        row = metrics.parse_server_metrics(lines_of(line)).first()
        assert tuple(row)[1:] == expected, line
        assert row[0] == line.split(" | ")[0]


@pytest.mark.parametrize(
    "cpu, response, level",
    [(86, 701, "ERROR"), (86, 700, "WARNING"), (85, 999, "WARNING"), (66, 100, "WARNING"), (65, 999, "INFO")],
)
def test_severity_rule(spark, cpu, response, level):
    row = spark.createDataFrame([(cpu, response)], "`CPU (%)` int, `Response Time (ms)` int")
    assert metrics.classify_severity(row).first().Level == level


def rows(spark, *values):
    return spark.createDataFrame(list(values), "Server string, Level string, `Memory (GB)` double")


def test_memory_is_compared_to_the_average_of_all_rows(spark):
    table = rows(spark, ("a", "INFO", 1.0), ("a", "ERROR", 3.0), ("b", "INFO", 2.0), ("b", "INFO", None), ("c", "INFO", 2.0))
    result = metrics.memory_over_average(table).collect()
    # The average is exactly 2.0: equal is not over, null drops out.
    assert [tuple(row) for row in result] == [("a", 1, 3.0)]


def test_errors_are_ordered_by_count_then_server(spark):
    table = rows(spark, ("b", "ERROR", 1.0), ("a", "ERROR", 1.0), ("c", "ERROR", 1.0), ("c", "ERROR", 1.0), ("d", "INFO", 1.0))
    result = metrics.errors_by_server(table).collect()
    assert [tuple(row) for row in result] == [("c", 2), ("a", 1), ("b", 1)]


def test_complete_rows_survive_rendering_and_parsing(spark, lines_of):
    parsed = metrics.parse_server_metrics(lines_of(CASES[0][0], CASES[1][0]))
    again = metrics.parse_server_metrics(metrics.render_server_metrics(parsed))
    assert again.exceptAll(parsed).count() == parsed.exceptAll(again).count() == 0
