"""Readers, sinks and their guards."""

from pathlib import Path

import pytest

from logloom import schemas
from logloom.functions import fixed
from logloom.sources import durable, files, readers, sinks
from logloom.sources.options import BatchOptions


@pytest.fixture
def volume(spark):
    return spark.createDataFrame([("CBS", 3), ("", 1)], schemas.COMPONENT_VOLUME)


def rows(table):
    return sorted(tuple(row) for row in table.collect())


def test_text_file_and_folder(spark, tmp_path):
    (tmp_path / "a.log").write_text("one\ntwo\n")
    (tmp_path / "b.log").write_text("three")
    assert rows(readers.read_lines(spark, str(tmp_path / "a.log"))) == [("one",), ("two",)]
    assert rows(readers.read_lines(spark, str(tmp_path))) == [("one",), ("three",), ("two",)]


@pytest.mark.parametrize("cap, files", [(1, 1), (100, 1), (150, 2), (399, 4), (400, 4), (9999, 4)])
def test_row_cap_takes_the_first_lines(spark, tmp_path, cap, files):
    for number in range(4):
        (tmp_path / f"{number}.log").write_text("".join(f"{number}-{line}\n" for line in range(100)))
    expected = [f"{number}-{line}" for number in range(4) for line in range(100)][:cap]
    capped = readers.read_lines(spark, str(tmp_path), max_rows=cap)
    assert sorted(row.value for row in capped.collect()) == sorted(expected)
    # Files behind the cap are not part of the plan.
    assert len({file for file in capped.inputFiles()}) == files


def test_row_cap_inside_a_file_of_many_splits(spark, tmp_path):
    (tmp_path / "a.log").write_text("".join(f"{line:05d}\n" for line in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        for cap in (1, 1364, 1365, 1366, 7_777, 19_999):
            capped = readers.read_lines(spark, str(tmp_path), max_rows=cap)
            assert sorted(row.value for row in capped.collect()) == [f"{line:05d}" for line in range(cap)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_no_cap_by_default(spark, tmp_path):
    (tmp_path / "a.log").write_text("one\ntwo\n")
    assert readers.read_lines(spark, str(tmp_path), max_rows=0).count() == 2


def test_missing_and_empty_results_are_typed_and_empty(spark, tmp_path):
    (tmp_path / f"{fixed.RESULT_COMPONENTS}.parquet").mkdir()
    (tmp_path / f"{fixed.RESULT_COMPONENTS}.parquet" / "_SUCCESS").touch()
    for name in (fixed.RESULT_COMPONENTS, fixed.RESULT_LEVELS):
        table = readers.read_result(spark, str(tmp_path), name, schemas.COMPONENT_VOLUME)
        assert table.schema == schemas.COMPONENT_VOLUME and table.count() == 0


def test_base_folder_with_data_wins(spark, tmp_path, volume):
    missing, empty, full = (str(tmp_path / name) for name in ("missing", "empty", "full"))
    (tmp_path / "empty" / "1_component_volume.parquet").mkdir(parents=True)
    assert readers.resolve_base(spark, [missing, str(tmp_path / "other")]) == missing
    assert readers.resolve_base(spark, [missing, empty]) == empty
    sinks.write_result(volume, full, fixed.RESULT_COMPONENTS)
    assert readers.resolve_base(spark, [missing, empty, full]) == full


def test_export_replaces_and_mirrors(spark, tmp_path, volume):
    base, mirror = str(tmp_path / "base"), str(tmp_path / "mirror")
    sinks.export(spark, volume, "r", base, mirror)
    assert sinks.export(spark, volume.limit(1), "r", base, mirror) > 0
    for place in (base, mirror):
        assert rows(readers.read_result(spark, place, "r", schemas.COMPONENT_VOLUME)) == [("CBS", 3)]


def test_export_takes_query_text(spark, tmp_path, volume):
    sinks.register_view(volume, "volume_view")
    sinks.export(spark, "SELECT Component, Total_Logs FROM volume_view WHERE Total_Logs > 1", "r", str(tmp_path))
    assert rows(readers.read_result(spark, str(tmp_path), "r", schemas.COMPONENT_VOLUME)) == [("CBS", 3)]


def test_export_refuses_a_table_without_columns(spark, tmp_path, volume):
    with pytest.raises(ValueError):
        sinks.export(spark, volume.select(), "r", str(tmp_path))


def test_timings_are_appended(spark, tmp_path):
    path = str(tmp_path / "timings")
    sinks.append_timings(spark, path, "1 Worker Node", {"Severity Levels": 2})
    sinks.append_timings(spark, path, "2 Worker Nodes", {"Severity Levels": 1.5})
    assert rows(spark.read.parquet(path)) == [
        ("Severity Levels", "1 Worker Node", 2.0),
        ("Severity Levels", "2 Worker Nodes", 1.5),
    ]


def test_number_of_text_files(spark, tmp_path):
    lines = spark.range(100).selectExpr("cast(id AS string) AS value")
    sinks.write_lines(lines, str(tmp_path / "out"), files=3)
    assert len(list((tmp_path / "out").glob("part-*"))) == 3
    assert readers.read_lines(spark, str(tmp_path / "out")).count() == 100


def test_durable_table_is_read_back(spark, volume):
    stored = durable.durable(volume)
    assert rows(stored) == rows(volume) and stored.schema == volume.schema
    assert durable.shared_folder(spark) in stored.inputFiles()[0]
    folder = Path(stored.inputFiles()[0].removeprefix("file:")).parent
    durable.discard(stored)
    assert not folder.exists()




def test_options():
    assert BatchOptions.from_mapping({}).source == "hdfs://master:9000/logs/windows/Windows.log"
    given = {"HDFS_NAMENODE": "s3a://b", "LOG_INPUT_PATH": "/in", "MAX_INPUT_ROWS": "5", "HDFS_OUTPUT_BASE": "/out"}
    options = BatchOptions.from_mapping({**given, "LOCAL_OUTPUT_BASE": "/m"})
    assert (options.source, options.results, options.mirror_base, options.max_input_rows) == ("s3a://b/in", "s3a://b/out", "/m", 5)
    assert BatchOptions.from_mapping({}, "/raw").input_path == "/raw"


ODD_FILES = ["a b.log", "c#d.log", "e%20f.log", "g+h.log", "i[j].log", "k{l}.log", "m*n?.log", "ö.log"]


@pytest.mark.parametrize("cap", [1, 50, 100, 150, 250, 399, 450, 555, 777, 800, 900])
def test_row_cap_on_names_that_need_encoding(spark, tmp_path, cap):
    for name in ODD_FILES:
        (tmp_path / name).write_text("".join(f"{name} {line}\n" for line in range(100)))
    expected = [(f"{name} {line}", f"file:{tmp_path}/{name}") for name in ODD_FILES for line in range(100)][:cap]
    capped = readers.read_lines(spark, str(tmp_path), max_rows=cap, origin="Origin")
    assert capped.columns == ["value", "Origin"] and rows(capped) == sorted(expected)
    assert readers.read_lines(spark, str(tmp_path)).count() == 800


def test_files_behind_the_cut_are_not_read(spark, tmp_path):
    for number in range(10):
        (tmp_path / f"{number} x.log").write_text("line\n" * 10)
    capped = readers.read_lines(spark, str(tmp_path), max_rows=25, origin="Origin")
    # The scan's own metadata names what was read.
    assert {row.Origin[-7:] for row in capped.collect()} == {"0 x.log", "1 x.log", "2 x.log"}
    assert len(set(capped.inputFiles())) == 3


def test_row_cap_over_many_files(spark, tmp_path):
    for number in range(10_000):
        (tmp_path / f"{number:05d} %.log").write_text("x\n" * (number % 3))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        capped = readers.read_lines(spark, str(tmp_path), max_rows=9_001, origin="Origin")
        last = capped.agg({"Origin": "max", "*": "count"}).first()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    # 0 + 1 + 2 lines for every three files.
    assert last["count(1)"] == 9_001 and last["max(Origin)"].endswith("/09001 %.log")


def test_empty_files_and_folders(spark, tmp_path):
    assert readers.read_lines(spark, str(tmp_path), max_rows=5, origin="f").collect() == []
    for name in ("a", "b", "c"):
        (tmp_path / f"{name}.log").write_text("")
    (tmp_path / "d.log").write_text("one\ntwo")
    assert rows(readers.read_lines(spark, str(tmp_path), max_rows=1)) == [("one",)]


def test_a_failed_write_leaves_the_old_result(spark, tmp_path, volume):
    base = str(tmp_path)
    sinks.export(spark, volume, "r", base)
    broken = spark.range(0, 1000, 1, 4).selectExpr("cast(id AS string) AS Component", "if(id = 999, raise_error('stop'), id) AS Total_Logs")
    with pytest.raises(Exception, match="stop"):
        sinks.export(spark, broken, "r", base)
    assert rows(readers.read_result(spark, base, "r", schemas.COMPONENT_VOLUME)) == rows(volume)
    assert [p.name for p in tmp_path.iterdir()] == ["r.parquet"]


def test_a_result_can_be_made_from_itself(spark, tmp_path, volume):
    base = str(tmp_path / "with blank")
    sinks.export(spark, volume, "r", base)
    old = readers.read_result(spark, base, "r", schemas.COMPONENT_VOLUME)
    sinks.export(spark, old.unionByName(old), "r", base)
    assert rows(readers.read_result(spark, base, "r", schemas.COMPONENT_VOLUME)) == sorted(rows(volume) * 2)
    assert [p.name for p in Path(base).iterdir()] == ["r.parquet"]


def test_a_failed_swap_puts_the_old_result_back(spark, tmp_path, volume, monkeypatch):
    base = str(tmp_path)
    sinks.export(spark, volume, "r", base)
    real = files.rename

    def fails_once(spark, old, new):
        if "/_new-" in old:
            raise OSError("no swap")
        real(spark, old, new)

    monkeypatch.setattr(files, "rename", fails_once)
    with pytest.raises(OSError):
        sinks.export(spark, volume.limit(1), "r", base)
    assert rows(readers.read_result(spark, base, "r", schemas.COMPONENT_VOLUME)) == rows(volume)
    assert [p.name for p in tmp_path.iterdir()] == ["r.parquet"]


def test_exports_are_measured(spark, tmp_path, volume):
    made = sinks.measured_export(spark, volume, "r", str(tmp_path), str(tmp_path / "mirror"))
    stored = sum(p.stat().st_size for p in (tmp_path / "r.parquet").glob("*") if not p.name.startswith("."))
    assert (made.rows, made.bytes) == (2, stored) and made.seconds > 0
    assert sinks.measured_export(spark, volume.limit(0), "r", str(tmp_path)).rows == 0
    sinks.append_metrics(spark, str(tmp_path / "metrics"), "1 Worker Node", {"x": made})
    assert rows(spark.read.schema(schemas.RUN_METRICS).parquet(str(tmp_path / "metrics"))) == [("x", "1 Worker Node", made.seconds, 2, stored)]


def test_cached_tables_are_released(spark, volume):
    with readers.cached_tables(volume, volume.limit(1)) as (whole, first):
        assert whole.count() == 2 and first.count() == 1 and whole.is_cached and first.is_cached
    assert not whole.is_cached and not first.is_cached
    with pytest.raises(KeyError):
        with readers.cached_tables(volume):
            raise KeyError
    assert not volume.is_cached


def test_exists_takes_patterns(spark, tmp_path):
    (tmp_path / "a b").mkdir()
    (tmp_path / "a b" / "part-1").touch()
    assert readers.exists(spark, str(tmp_path / "a b")) and readers.exists(spark, f"{tmp_path}/*/part-*")
    assert not readers.exists(spark, f"{tmp_path}/*/no-*") and not readers.exists(spark, str(tmp_path / "none"))
