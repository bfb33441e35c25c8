"""Every stage of the pipeline against brute force on its own input."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import clashing, messy, rows
from test_llm_linededup import brute as brute_lines
from test_llm_perplexity import brute_statistics
from test_llm_simhash import brute_components, brute_fingerprint

import __spark_entry__
import corpus_pipeline
from logloom.llm import linededup, mixing, perplexity, simhash
from logloom.llm.text import small_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The input of each stage and the result of the last, each written and read again."""
    folder = tmp_path_factory.mktemp("pipeline")
    tables = [spark.read.parquet(f"{SF}/documents.parquet")]
    for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], SF).write.parquet(str(folder / str(place)))
        tables.append(spark.read.parquet(str(folder / str(place))))
    return tables


def test_stages_keep_the_columns(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "simhash near-dedup", "mixing sources", "sentencepiece"]
    assert all(table.columns == steps[0].columns for table in steps[1:-1])


def test_quality_stage(steps):
    before, after = ({r.doc_id: r.text for r in table.collect()} for table in steps[:2])
    assert all(after[i] == before[i] for i in after)
    for i, text in before.items():
        n, _, _, _, again = brute_statistics(text or "")
        if n < 10 or 100 * again > 20 * n:
            assert i not in after
    kept = {r.doc_id for r in perplexity.quality(steps[0]).filter("kept").collect()}
    assert set(after) == kept


def test_line_stage(steps):
    docs = [(r.doc_id, r.text) for r in steps[1].collect()]
    assert rows(steps[2].select("doc_id", "text")) == sorted(brute_lines(docs), key=repr)


def test_near_dedup_stage(steps):
    docs = steps[2].collect()
    component = brute_components([r.doc_id for r in docs], [brute_fingerprint(r.text) for r in docs])
    assert rows(steps[3]) == sorted((tuple(r) for r, c in zip(docs, component) if r.doc_id == c), key=repr)


def test_mixing_stage(steps):
    times = Counter(r.doc_id for r in steps[4].collect())
    for r in mixing.mix(steps[3]).collect():
        if r["size"]:
            assert times[r.doc_id] * r["size"] == r.taken


def test_encoding_stage(steps):
    sentencepiece = pytest.importorskip("sentencepiece")
    oracle = sentencepiece.SentencePieceProcessor(model_file="/opt/tokenizers/piece_bpe_32k.model")
    texts = {r.doc_id: r.text for r in steps[4].collect()}
    found = steps[5].collect()
    assert Counter(r.doc_id for r in found) == Counter(r.doc_id for r in steps[4].collect())
    assert all(r.token_ids == oracle.encode(texts[r.doc_id]) and r.round_trip for r in found)


def test_run_is_the_stages_in_order(spark, steps):
    assert rows(__spark_entry__.queries()["pipeline"](spark, SF)) == rows(steps[5])


@pytest.mark.parametrize("place", range(5))
def test_messy_rows(spark, place):
    _, stage = corpus_pipeline.STAGES[place]
    docs = clashing(messy(spark), "key", "row", "h1", "n_lines", "fp", "pick", "n_tokens")
    found = stage(spark, docs, SF)
    assert found.count() > 0
    if place < 4:
        assert set(found.columns) == set(docs.columns)
    assert stage(spark, messy(spark, []), SF).count() == 0


def test_equal_rows_leave_one(spark):
    docs = messy(spark, [(1, "the very same text of a few words", "en", "a", 3)] * 4 + [(None, "the very same text of a few words", "en", "a", 3)])
    assert rows(corpus_pipeline.near_dedup(spark, docs, SF)) == [(1, "the very same text of a few words", "en", "a", 3)]


@pytest.mark.parametrize("stage", [corpus_pipeline.line_dedup, corpus_pipeline.encode])
def test_python_steps_are_over_when_the_caller_writes(spark, stage):
    """The caller's settings may send much to a Python worker at once."""
    docs = messy(spark)
    found = stage(spark, docs, SF)
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString() and found.inputFiles()
    assert found.count() == docs.count()


def test_lines_are_dropped_by_one_python_step(spark):
    """Two in a row would take two workers for each task; they stay on the executors for the stages that follow."""
    docs = messy(spark)
    surplus = spark.createDataFrame([(1, [5])], "doc_id bigint, lines array<bigint>")
    shared = spark.sparkContext.broadcast((np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    plan = linededup.drop_lines(docs, surplus, shared)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2  # of all rows, and below it of those that go to be joined
    union = next(i for i, line in enumerate(plan.split("\n")) if "Union" in line)
    assert "MapInArrow" not in plan.split("\n")[union + 1] + plan.split("\n")[union + 2]


def test_small_tables_take_no_python_workers(spark):
    """Tables made of Python objects are read by Python workers of their own, which stay on the executors."""
    scores = perplexity.judge(perplexity.score(messy(spark), spark.createDataFrame([], "lang string, word string, n bigint, s0 bigint")), {None: (0.0, 9.0), "en": (1.0, 2.5)})
    links = simhash.near_links(spark.range(100).withColumnRenamed("id", "fp"))
    for found in (scores, links):
        assert "ExistingRDD" not in found._jdf.queryExecution().executedPlan().toString()
    table = small_table(spark, [(None, 1, 2.5), ("en", 3, -1.0)], {"lang": pa.string(), "n": pa.int32(), "x": pa.float64()})
    assert [tuple(r) for r in table.collect()] == [(None, 1, 2.5), ("en", 3, -1.0)] and table.schema.simpleString() == "struct<lang:string,n:int,x:double>"
    assert small_table(spark, [], {"n": pa.int32()}).collect() == []
