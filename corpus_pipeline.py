"""The corpus pipeline: quality rules, line dedup, near copies, repeated passages, packing."""

from __future__ import annotations

from pyspark.sql import functions as F

from footfall.llm.common import scratch_path, table
from footfall.llm.jaccard_join import jaccard_components
from footfall.llm.line_dedup import remove_boilerplate
from footfall.llm.packing import pack_documents
from footfall.llm.quality import good
from footfall.llm.substring_dedup import remove_spans, repeated_spans

#: Near copies: shingles of five words, similarity of 0.8 or more.
SHINGLE, PERCENT = 5, 80

#: SQL cannot express the last three stages; they are tested against brute-force versions.
ORACLE_SQL = None


def quality_stage(spark, docs, sf_dir):
    """Documents that pass every quality rule; the base rules of operator 3 are among them."""
    return good(docs)


def _with_chars(docs, names):
    """``n_chars``, if there is such a column, after a change of ``text``."""
    return docs.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in names])


def line_stage(spark, docs, sf_dir):
    """Documents without cross-site boilerplate lines; those with nothing left go."""
    clean = remove_boilerplate(docs)
    return _with_chars(clean.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines"))), docs.columns)


def near_copy_stage(spark, docs, sf_dir):
    """One document of each group of near copies: that with the smallest id.  Documents without
    id or shingles are in no group."""
    groups = jaccard_components(docs, size=SHINGLE, percent=PERCENT)
    gone = groups.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def passage_stage(spark, docs, sf_dir):
    """Documents without passages that an earlier document keeps; those with nothing left go."""
    clean = remove_spans(docs, repeated_spans(docs))
    return _with_chars(clean.where(F.col("text").isNull() | (F.col("text") != "")), docs.columns)


def packing_stage(spark, docs, sf_dir):
    """Pieces of the documents, packed into sequences."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [("quality_rules", quality_stage), ("line_dedup", line_stage), ("near_copies", near_copy_stage),
          ("repeated_passages", passage_stage), ("packing", packing_stage)]


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
