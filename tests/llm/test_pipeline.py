"""Each stage on its own input, the whole run against its parts, and odd documents."""

import corpus_pipeline
import pytest
from helpers import ODD, clashing, docs

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    out = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], FOLDER).cache())
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_keep_the_columns(steps):
    for df in steps[:-1]:
        assert df.columns == steps[0].columns


def test_quality_rules_keep_what_the_operator_keeps(spark, steps):
    from panelcast.llm import quality_rules

    assert ids(steps[1]) == ids(quality_rules.judge(steps[0]).where("kept"))


def test_line_dedup_keeps_rows_and_cuts_texts(steps):
    assert ids(steps[2]) == ids(steps[1])
    before, after = ({r.doc_id: r for r in df.collect()} for df in steps[1:3])
    assert any(after[i].text != before[i].text for i in before)
    assert all(r.n_chars == len(r.text) for r in after.values())


def test_one_of_each_class_stays(steps):
    from panelcast.llm import simhash

    classes = simhash.near_duplicates(steps[2]).collect()
    assert ids(steps[3]) == sorted({r.component_id for r in classes})


def test_no_leak_stays(spark, steps):
    from panelcast.llm import decontaminate

    leaked = {r.doc_id for r in decontaminate.leaks(steps[3], spark.read.parquet(f"{FOLDER}/benchmark.parquet")).collect()}
    assert leaked and ids(steps[4]) == sorted(set(ids(steps[3])) - leaked)


def test_every_document_is_packed(steps):
    assert sorted({r.doc_id for r in steps[5].collect()}) == ids(steps[4])


def test_run_is_the_stages_in_turn(spark, steps):
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, FOLDER).select(*key).collect()
    assert sorted(got) == sorted(steps[5].select(*key).collect())


def test_odd_documents(spark):
    table = clashing(docs(spark, ODD), ["row", "kept", "hits", "leaks"])
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, table, FOLDER).collect()
        assert stage(spark, table.where("false"), FOLDER).count() == 0
