"""The whole pipeline on awkward rows, and what it leaves behind."""

from pathlib import Path

import corpus_pipeline
from tablekit.scratch import shared_folder


def prose(name, n, tail=""):
    return " ".join(f"the {name}{i} of word{i}{name} and{tail}" for i in range(n))


def tables(spark):
    return {p for p in Path(shared_folder(spark).removeprefix("file:")).rglob("*") if p.name.startswith("part-")}


def awkward_rows():
    texts = {i: prose("abcdefghijkl"[i] * 3, 30) for i in range(12)}
    rows = [(i, t, "en", "ab"[i % 2]) for i, t in texts.items()]
    rows += [(0, texts[0], "en", "a"), (20, texts[0], "en", "a"), (0, prose("other", 30), "en", "a")]
    rows += [(21, None, None, None), (22, "", "en", "a"), (None, texts[7], "en", None), (23, prose("long", 30_000), "en", "b")]
    rows += [(24, prose("end", 30, " <|endoftext|>"), None, "a"), (None, None, None, None)]
    return rows


def test_whole_pipeline_on_awkward_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, size string, kept string"
    rows = [(*r, None, "row", "size", "kept") for r in awkward_rows()]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    before = tables(spark)
    result = corpus_pipeline.run(spark, str(tmp_path))
    pieces = result.collect()
    ids = [r.doc_id for r in pieces]
    # Of source b the mix takes no more than its share.
    assert {0, 2, 4, 6, 8, 10, 23, 24} <= set(ids) and not {20, 21, 22} & set(ids)
    assert all(0 < r.length <= 1024 and len(r.ids) == 4 * r.length for r in pieces)
    left = tables(spark) - before
    assert left and all("pipeline-best_fit_packing" in str(p) for p in left)


def test_empty_pipeline(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_a_stage_that_is_not_written_keeps_its_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(*r, None) for r in awkward_rows()]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for stage in (corpus_pipeline.quality_rules, corpus_pipeline.line_dedup):
        docs = stage(spark, docs, str(tmp_path))
    assert docs.count() > 10
