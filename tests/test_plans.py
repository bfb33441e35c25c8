"""The batch jobs and the report, from text files to tables."""

from pathlib import Path

import pytest

from logloom import schemas
from logloom.functions import fixed
from logloom.operators import hourly, stages, volume
from logloom.plans import metrics_batch, report, system_batch
from logloom.registry import event_source
from logloom.sources import durable, readers, sinks
from logloom.sources.options import BatchOptions

SF_DIR = "/root/testdata/sf0.001"


def rows(table):
    return [tuple(row) for row in table.collect()]


@pytest.fixture(scope="module")
def batch(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("batch")
    events = event_source.events(spark, SF_DIR)
    sinks.write_lines(event_source.system_lines(events), str(folder / "lines"), files=3)
    options = BatchOptions("", str(folder / "lines"), 0, str(folder / "results"), str(folder / "mirror"))
    seconds = [system_batch.run(spark, options, str(folder / "timings"), setup) for setup in fixed.WORKER_SETUPS]
    return folder, options, seconds


def test_batch_results_equal_direct_aggregates(spark, batch):
    _, options, _ = batch
    parsed = event_source.parsed_system(spark, SF_DIR)
    expected = {
        fixed.RESULT_COMPONENTS: (schemas.COMPONENT_VOLUME, volume.component_volume(parsed)),
        fixed.RESULT_LEVELS: (schemas.SEVERITY_LEVELS, volume.severity_levels(parsed)),
        fixed.RESULT_TEMPLATES: (schemas.TOP_TEMPLATES, volume.top_templates(parsed)),
        fixed.RESULT_HOURS: (schemas.HOURLY_FEATURES, hourly.hourly_features(parsed)),
    }
    for name, (schema, table) in expected.items():
        for base in (options.results, options.mirror_base):
            assert sorted(rows(readers.read_result(spark, base, name, schema))) == sorted(rows(table))


def test_batch_reports_its_stage_times(spark, batch):
    folder, _, seconds = batch
    assert list(seconds[0]) == list(fixed.STAGES) and all(value > 0 for value in seconds[0].values())
    speedup = stages.stage_speedup(spark.read.schema(schemas.STAGE_TIMINGS).parquet(str(folder / "timings")))
    assert [row.Process for row in speedup.collect()] == [*fixed.STAGES, fixed.ALL_STAGES]
    with pytest.raises(ValueError):
        system_batch.run(spark, batch[1], str(folder / "timings"), None)


def test_row_cap_applies_before_parsing(spark, batch, tmp_path):
    folder, _, _ = batch
    options = BatchOptions("", str(folder / "lines"), 200, str(tmp_path / "results"))
    system_batch.run(spark, options)
    capped = readers.read_result(spark, options.results, fixed.RESULT_COMPONENTS, schemas.COMPONENT_VOLUME)
    assert 190 <= sum(row.Total_Logs for row in capped.collect()) <= 200
    total = spark.sql("SELECT count(*) AS n FROM windows_logs WHERE Date <> ''").first().n
    assert 190 <= total <= 200


def test_report(spark, batch):
    _, options, _ = batch
    tables = report.build(spark, options.results)
    assert set(tables) == {
        "component_cards", "component_comparison", "component_metric", "component_share", "indexed_trend",
        "anomaly_windows", "anomaly_kpis", "anomaly_triage", "severity_mix", "severity_summary", "template_concentration",
    }
    assert rows(tables["component_comparison"])[0][4:] == (1.0, 0.0)
    assert tables["anomaly_windows"].count() == tables["anomaly_kpis"].first().Total_Windows
    simplified = report.build(spark, options.results, ["CBS", "CSI"], "CSI", relative=True, simplified=True)
    assert simplified["anomaly_triage"].count() <= 5
    assert simplified["anomaly_windows"].filter("NOT Is_Anomaly").count() == 0
    assert simplified["component_share"].count() == 2


def test_report_leaves_out_sections_without_data(spark, tmp_path):
    with pytest.raises(ValueError):
        report.build(spark, str(tmp_path))
    one = spark.createDataFrame([("CBS", 3)], schemas.COMPONENT_VOLUME)
    sinks.write_result(one, str(tmp_path), fixed.RESULT_COMPONENTS)
    assert set(report.build(spark, str(tmp_path))) == {
        "component_cards", "component_comparison", "component_metric", "component_share",
    }


def test_metrics_job(spark, tmp_path):
    events = event_source.events(spark, SF_DIR)
    sinks.write_lines(event_source.metric_lines(events), str(tmp_path / "lines"), files=5)
    options = BatchOptions.from_mapping({"HDFS_NAMENODE": ""}, str(tmp_path / "lines"))
    options = BatchOptions("", options.input_path, 0, str(tmp_path / "out"))
    assert list(metrics_batch.run(spark, options)) == [fixed.RESULT_SERVER_ERRORS, fixed.RESULT_SERVER_MEMORY]
    errors, memory = (spark.read.parquet(readers.result_path(options.results, name)) for name in (fixed.RESULT_SERVER_ERRORS, fixed.RESULT_SERVER_MEMORY))
    assert errors.count() == memory.count() == 3
    direct = spark.sql("SELECT count(*) AS n FROM server_logs WHERE Level = 'ERROR'").first().n
    assert sum(row.Total_errors for row in errors.collect()) == direct


def test_jobs_remove_their_intermediate_tables(spark, batch, tmp_path):
    _, options, _ = batch
    kinds = ("summary", "metric-summary", "scores")
    stored = lambda: {p for k in kinds for p in Path(durable.shared_folder(spark).removeprefix("file:")).glob(f"{k}-*")}
    before = stored()
    system_batch.run(spark, BatchOptions("", options.input_path, 0, str(tmp_path / "results")))
    report.run(spark, str(tmp_path / "results"), str(tmp_path / "report"))
    sinks.write_lines(event_source.metric_lines(event_source.events(spark, SF_DIR)), str(tmp_path / "metrics"))
    metrics_batch.run(spark, BatchOptions("", str(tmp_path / "metrics"), 0, str(tmp_path / "out")))
    assert stored() == before


def test_metrics_job_stores_every_server(spark, tmp_path):
    lines = [f"t | SERVER_{i} | ERROR | Response Time = 1ms | CPU=1% | Memory={i % 4}GB | Requests=1" for i in range(50)]
    sinks.write_lines(spark.createDataFrame([(line,) for line in lines], "value string"), str(tmp_path / "in"))
    metrics_batch.run(spark, BatchOptions("", str(tmp_path / "in"), 0, str(tmp_path / "out")))
    assert spark.read.parquet(readers.result_path(str(tmp_path / "out"), fixed.RESULT_SERVER_ERRORS)).count() == 50


def test_report_job_stores_every_table(spark, batch, tmp_path):
    folder, options, _ = batch
    stored = report.run(spark, options.results, str(tmp_path), str(folder / "timings"))
    assert {"stage_timings", "stage_speedup", "severity_mix", "anomaly_windows"} <= set(stored)
    for name in stored:
        assert spark.read.parquet(readers.result_path(str(tmp_path), fixed.REPORT_PREFIX + name)).count() > 0
