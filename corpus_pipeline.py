"""A training corpus from raw documents.

Rules drop documents of low quality, repeated lines go, one document of each group
of near duplicates stays, sources are mixed to their target weights, and the
tokens are packed into sequences. Each stage is written and read again, so a lost
executor costs one stage's tasks at most.

A stage's own intermediate tables go when the next stage begins, as its result is
written and read again by then; ``run`` also removes each stage's result once the next
one's is written.

Defined cases: an empty table gives an empty result; nulls, empty and very long texts,
repeated rows and shared ids are those of the operators; extra columns of the documents
come along, whatever their names, to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame

from tablekit.llm.line_dedup import deduplicated_documents
from tablekit.llm.mixing import mixed_documents
from tablekit.llm.ngram_join import distinct_documents
from tablekit.llm.packing import pack
from tablekit.llm.quality_rules import good_documents
from tablekit.scratch import kept_scratch, new_path, remove
from tablekit.sources import read_table

#: Per application the folders of stages whose results may still be read.
_open: dict[str, list[str]] = {}


def _stage(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A stage whose intermediate tables are removed when the next one begins."""

    @wraps(function)
    def with_scratch(spark, docs, sf_dir):
        application = spark.sparkContext.applicationId
        read = docs.inputFiles()
        kept = []
        for folder in _open.get(application, []):
            name = folder.rsplit("/", 1)[-1]
            # A result that was not written still needs them.
            if any(name in file for file in read):
                kept.append(folder)
            else:
                remove(spark, folder)
        with kept_scratch(spark) as folder:
            _open[application] = [*kept, folder]
            return function(spark, docs, sf_dir)

    return with_scratch


@_stage
def quality_rules(spark, docs, sf_dir):
    return good_documents(docs)


@_stage
def line_dedup(spark, docs, sf_dir):
    return deduplicated_documents(docs)


@_stage
def near_duplicates(spark, docs, sf_dir):
    return distinct_documents(docs)


@_stage
def mix_sources(spark, docs, sf_dir):
    return mixed_documents(docs)


@_stage
def best_fit_packing(spark, docs, sf_dir):
    """Pieces of the mixed documents, with their ids and their place in a sequence."""
    return pack(docs, keep_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

#: Tokenising and packing have no SQL; the pipeline is tested stage by stage against plain Python.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The packed pieces of the documents in ``sf_dir``; only their own table is left."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        result, path = stage(spark, docs, sf_dir), new_path(spark, f"pipeline-{name}")
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if before:
            remove(spark, before)
        before = path
    for folder in _open.pop(spark.sparkContext.applicationId, []):
        remove(spark, folder)
    return docs
