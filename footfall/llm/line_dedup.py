"""Cross-site boilerplate lines by distinct-site spread (operator 9, native).

A HyperLogLog sketch of the sites per line hash, merged by aggregation, decides lines far
from the threshold; lines whose estimate is near it get an exact distinct count.  Lines on
``min_sites`` sites or more are removed from every document but the one with the smallest
key, so no content is lost from the corpus.

A document contributes a line once, whatever its repeats, and sketches are merged map-side,
so a hot line or a hot site reaches the shuffle as one row per task.  Texts travel once, to
meet the short list of lines to remove.

Defined cases: null and empty texts have no lines and come back as they are (null: null);
blank lines are neither counted nor removed; a null site is one site of its own; a null key
sorts after all others; repeated rows (same key and text) are cleaned alike.  All other
columns pass through; working columns are nested, so input names cannot clash, except that
``n_lines`` and ``n_removed`` are overwritten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import SPACES, table, written

MIN_SITES = 10
LG_K = 10
NEAR = 0.25


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)


def _line_hash(line: Column) -> Column:
    """128 bits: two hashes that start from different seeds."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def _row_key(key: str, text: str) -> Column:
    return F.struct(F.col(key).isNull().alias("none"), F.coalesce(F.col(key), F.lit(0)).alias("id"),
                    F.xxhash64(F.col(text)).alias("hash"))


def line_rows(docs: DataFrame, key: str, text: str, site: str) -> DataFrame:
    """One row per document and distinct non-blank line: ``row``, ``site``, ``line`` (its hash)."""
    hashes = F.array_distinct(F.transform(_lines(F.col(text)), _line_hash))
    return (docs.where(F.col(text).isNotNull())
            .select(_row_key(key, text).alias("row"), F.coalesce(F.col(site), F.lit("")).alias("site"),
                    F.explode(hashes).alias("line")))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K,
                near: float = NEAR) -> DataFrame:
    """Lines on ``min_sites`` sites or more: ``line``, ``first`` (smallest document row)."""
    spread = lines.groupBy("line").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("sites"), F.min("row").alias("first"),
    ).where(F.col("sites") >= min_sites * (1 - near))
    spread = written(spread, "line-spread")
    close = F.col("sites") <= min_sites * (1 + near)
    exact = (lines.select("line", "site").distinct()
             .join(spread.where(close).select("line"), "line", "left_semi")
             .groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") >= min_sites).select("line"))
    return spread.where(~close).select("line", "first").unionByName(
        spread.where(close).join(exact, "line", "left_semi").select("line", "first"))


def remove_boilerplate(docs: DataFrame, key: str = "doc_id", text: str = "text", site: str = "source",
                       min_sites: int = MIN_SITES, lg_k: int = LG_K, near: float = NEAR) -> DataFrame:
    """``docs`` with cleaned ``text`` and the columns ``n_lines`` and ``n_removed``."""
    lines = line_rows(docs, key, text, site)
    common = boilerplate(lines, min_sites, lg_k, near)
    removed = (lines.join(common, "line").where(F.col("row")["id"].isNotNull()
                                                & ((F.col("row")["id"] != F.col("first")["id"])
                                                   | (F.col("row")["none"] != F.col("first")["none"])))
               .groupBy("row").agg(F.collect_set("line").alias("gone")))
    held = docs.select(F.struct("*").alias("d"), _row_key(key, text).alias("row"))
    out = held.join(removed, "row", "left").select("d", F.coalesce("gone", F.array()).alias("gone"))
    out = out.select("d", "gone", F.split(F.col("d")[text], "\n").alias("all"))
    gone = lambda x: F.array_contains("gone", _line_hash(x))
    out = out.select("d", F.size(F.filter("all", lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)).alias("n"),
                     F.when(F.size("gone") > 0, F.filter("all", lambda x: ~(
                         (F.length(F.btrim(x, F.lit(SPACES))) > 0) & gone(x)))).otherwise(F.col("all")).alias("left"),
                     F.size("all").alias("was"))
    extra = {"n_lines": F.coalesce("n", F.lit(0)).cast("long"),
             "n_removed": F.coalesce(F.col("was") - F.size("left"), F.lit(0)).cast("long")}
    cols = [F.col("d")[c].alias(c) if c != text else F.array_join("left", "\n").alias(text)
            for c in docs.columns if c not in extra]
    return out.select(*cols, *[e.alias(n) for n, e in extra.items()])


def op9_line_dedup(spark, sf_dir):
    return remove_boilerplate(table(spark, sf_dir, "documents")).select(
        "doc_id", "text", "n_lines", "n_removed")
