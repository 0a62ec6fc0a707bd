"""The pipeline's stages on the small fixture."""

from pathlib import Path

import corpus_pipeline
import pytest

from ledgerloom.llm import queries
from ledgerloom.llm.common import settled, stored
from ledgerloom.session import scratch_dir


def test_each_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))


def test_stages(spark, documents, texts, tmp_path):
    labels = spark.createDataFrame([(i, 1, 0) for i in (*range(12), *range(20, 27), *range(30, 33))], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs, ids = documents, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == documents.columns, name
        docs = spark.createDataFrame(out.collect(), documents.schema)
        ids.append({r.doc_id for r in docs.collect()})
    assert set(range(12)) | {20, 30, 31, 40, 41} <= ids[0] and None not in ids[0]
    assert ids[1] & {20, 21, 22, 23} == {23} and len(ids[1] & {40, 41, 42}) == 1
    assert len(ids[2] & {23, 24, 25, 26}) == 1 and ids[3] == ids[2]
    text = {r.doc_id: r.text for r in docs.collect()}
    long = dict(texts)
    assert text[30] == long[30] and len(text[31]) < 120
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert {r.doc_id for r in packed.collect()} == ids[3]


def scratch_of(spark) -> set[str]:
    """The names of the folders that the library has written."""
    return {p.name for p in Path(scratch_dir(spark, "x").removeprefix("file:")).parent.glob("*")}


def test_stages_leave_only_ids_behind(spark, documents, tmp_path):
    spark.createDataFrame([(i, 1, 0) for i in range(12)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        before = scratch_of(spark)
        out = stage(spark, documents, str(tmp_path))
        rows = out.count()
        new = scratch_of(spark) - before
        assert len(new) <= 1 and all(name.startswith("llm-kept-") for name in new)
        assert rows == out.count()
    before = scratch_of(spark)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    (left,) = scratch_of(spark) - before
    assert left.startswith("llm-repeated-passages-")


def test_a_failed_stage_leaves_nothing(spark, documents):
    def make():
        stored(documents, "before")
        raise ValueError("no")

    before = scratch_of(spark)
    with pytest.raises(ValueError, match="no"):
        settled(spark, make, "after")
    assert scratch_of(spark) == before


def test_what_is_settled_inside_another_goes_with_it(spark, documents):
    before = scratch_of(spark)
    outer = settled(spark, lambda: settled(spark, lambda: documents.select("doc_id"), "inner").distinct(), "outer")
    (left,) = scratch_of(spark) - before
    assert left.startswith("llm-outer-") and outer.count() == documents.distinct().select("doc_id").distinct().count()
