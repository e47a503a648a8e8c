"""Repeated passages by paragraph MinHash banding (operator 7).

A document is cut into paragraphs of two kinds.  Lines of at least ``WORDS + REACH`` words are
paragraphs as they stand.  Others lie at places that the words themselves fix, so that a
passage copied into the middle of another text gives the same paragraphs there: the ``WORDS``
words from an anchor on, an anchor being a place whose hash of three words is the least within
``REACH`` words on either side.  Two texts that share a run of about fifty words share such a
paragraph almost surely, and runs of fewer than ``WORDS`` words do not count.

Paragraphs of a kind are banded by MinHash over shingles of five words (``tune`` finds the
number of bands for a similarity and recall), paragraphs that collide with others are joined,
unequal ones are verified by exact Jaccard similarity with signature trees, and clusters are
the components of what was verified.  The first paragraph of a cluster, by document and place,
stays; its copies in other documents are removed.  Neighbours that are neighbours in the kept
text too, with the same words up to the next (every paragraph carries their hash), make a run.
Runs are extended to both sides as far as the words equal those of the kept text: the kept
words beside a run travel to it, ``CONTEXT`` of them first, more in further rounds for the
runs that used them up, no more than lie before the next run from the same kept text.  Runs that overlap or touch make one removed span; words that stand
nowhere else stay, but for those by which similar paragraphs differ.

Scale: texts are dealt by document once, as a bucketed table, which the later joins (to verify,
and for each round of extension the kept texts and the copies) read in place.  Paragraphs
travel once, as a few longs each; collisions are found by the minima and maxima of a band's
rows, which Spark streams past and spills.

Defined cases: rows without id or text, and texts shorter than a paragraph, have none; rows
that share an id count as one document, whose paragraphs are not removed for each other, and
their runs are extended as far as all of these rows agree; an
empty table gives no spans; other columns are ignored here and kept by ``remove_spans``.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import dealt, map_batches, table, written
from footfall.llm.components import components
from footfall.llm.jaccard_join import BLOCK, block_pairs, blocked, tree_links
from footfall.llm.shingles import hashed_words, mix, shingle_hashes

WORDS = 16
REACH = 8
SHINGLE = 5
CONTEXT = 48
PERCENT = 80
RECALL = 0.95
_ANCHOR = 3
_LINE = np.uint64(0xD6E8FEB86659FD93)


def tune(percent: int, recall: float, rows: int = 1) -> int:
    """Least number of bands of ``rows`` MinHashes with which a pair of that similarity collides
    with probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - (percent / 100) ** rows) - 1e-9))


def anchors(hashes: np.ndarray, words: int, reach: int) -> np.ndarray:
    """Places whose three-word hash is the least within ``reach`` (the first of equals), with
    ``words`` words to follow."""
    if len(hashes) < words:
        return np.zeros(0, np.int64)
    marks = shingle_hashes(hashes, _ANCHOR)
    top = np.uint64(np.iinfo(np.uint64).max)
    lows = np.concatenate([np.full(reach, top), marks, np.full(reach, top)])
    width = 1
    while width < reach:  # minima of windows of ``reach``, by doubling
        step = min(width, reach - width)
        lows = np.minimum(lows[:-step], lows[step:])
        width += step
    before, after = lows[:len(marks)], lows[reach + 1:reach + 1 + len(marks)]
    at = np.flatnonzero((marks < before) & (marks <= after))
    return at[at + words <= len(hashes)]


def lined_words(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words, and of each line with words the place of its first word and their number."""
    hashes, lines = hashed_words(text)
    first = np.flatnonzero(np.diff(lines, prepend=-1))
    return hashes, first, np.diff(first, append=len(hashes))


def _set_hashes(sums: np.ndarray, line: bool) -> np.ndarray:
    """Hashes of sets of shingles by the sums of their mixed members; those of lines are others."""
    return mix(sums ^ _LINE if line else sums).view(np.int64)


def anchored(shingles: np.ndarray, minima: list[np.ndarray], starts: np.ndarray, words: int):
    """Set hash and least mixed shingle by seed of the paragraphs at anchors."""
    at = starts[:, None] + np.arange(words - SHINGLE + 1)
    rows = np.sort(shingles[at], axis=1)
    fresh = np.ones(rows.shape, bool)
    fresh[:, 1:] = rows[:, 1:] != rows[:, :-1]
    sums = np.where(fresh, mix(rows + np.uint64(1)), np.uint64(0)).sum(1, dtype=np.uint64)
    return _set_hashes(sums, False), [m[at].min(1) for m in minima]


def lined(shingles: np.ndarray, minima: list[np.ndarray], starts: np.ndarray, lengths: np.ndarray):
    """Set hash and least mixed shingle by seed of the paragraphs that are lines."""
    sizes = lengths - SHINGLE + 1
    offsets = np.cumsum(sizes) - sizes
    at = np.arange(sizes.sum()) + np.repeat(starts - offsets, sizes)
    line = np.repeat(np.arange(len(sizes)), sizes)
    values = shingles[at]
    values = values[np.lexsort((values, line))]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (line[1:] != line[:-1])
    sums = np.add.reduceat(np.where(fresh, mix(values + np.uint64(1)), np.uint64(0)), offsets)
    return _set_hashes(sums, True), [np.minimum.reduceat(m[at], offsets) for m in minima]


def stretches(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of the words from each of ``starts`` up to the next, wherever they stand."""
    lengths = np.diff(starts, append=len(hashes))
    offsets = starts - starts[0]
    place = np.arange(len(hashes) - starts[0]) - np.repeat(offsets, lengths)
    return mix(np.add.reduceat(mix(hashes[starts[0]:] + mix(place.astype(np.uint64))), offsets)).view(np.int64)


def paragraphs(docs: DataFrame, bands: int, words: int = WORDS, reach: int = REACH) -> DataFrame:
    """One row per paragraph and band: ``doc_id``, ``start`` (word), ``n`` (words; more than
    ``words`` for lines), ``next`` (where the next paragraph starts, of lines the end), ``link``
    (hash of the words up to there, of lines 0), ``h``, ``band`` (key)."""
    schema = T.StructType([T.StructField("doc_id", T.LongType())] + [
        T.StructField(c, T.ArrayType(T.LongType())) for c in ("start", "n", "next", "link", "h", *[f"b{i}" for i in range(bands)])])
    seeds = mix(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def run(batches):
        for b in batches:
            sizes, cols = [0], [[] for _ in range(bands + 5)]
            for text in b.column(1):
                hashes, firsts, counts = lined_words(text.as_py())
                starts = anchors(hashes, words, reach)
                long = np.flatnonzero(counts >= words + reach)
                sizes.append(sizes[-1] + len(starts) + len(long))
                if not len(starts) and not len(long):
                    continue
                shingles = shingle_hashes(hashes, SHINGLE)
                minima = [mix(shingles ^ seed) for seed in seeds]
                if len(starts):
                    h, low = anchored(shingles, minima, starts, words)
                    keys = [mix(m + np.uint64(i)).view(np.int64) for i, m in enumerate(low)]
                    row = (starts, np.full(len(starts), words), np.append(starts[1:], len(hashes)), stretches(hashes, starts), h, *keys)
                    for c, v in zip(cols, row):
                        c.append(v)
                if len(long):
                    at, n = firsts[long], counts[long]
                    h, low = lined(shingles, minima, at, n)
                    keys = [mix(mix(m ^ _LINE) + np.uint64(i)).view(np.int64) for i, m in enumerate(low)]
                    for c, v in zip(cols, (at, n, at + n, np.zeros(len(at), np.int64), h, *keys)):
                        c.append(v)
            offsets = pa.array(sizes, pa.int32())
            values = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in cols]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.ListArray.from_arrays(offsets, pa.array(v, pa.int64())) for v in values]], schema.names)

    cut = map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, schema)
    keys = [f"b{i}" for i in range(bands)]
    one = cut.select("doc_id", F.explode(F.arrays_zip("start", "n", "next", "link", "h", *keys)).alias("p"))
    return one.select("doc_id", *[F.col(f"p.{c}").alias(c) for c in ("start", "n", "next", "link", "h")],
                      F.explode(F.array(*[F.col(f"p.{k}") for k in keys])).alias("band"))


def _verified(docs: DataFrame, members: DataFrame, percent: int, words: int, block: int) -> DataFrame:
    """``h`` and ``component`` of the classes of paragraphs that are similar to another class.

    Every band's classes are verified among themselves, by a tree per band (split into blocks
    if it is large); bands of one class only have nothing to verify.
    """
    mixed = members.where("mixed")
    first = mixed.groupBy("h").agg(F.min(F.struct("doc_id", "start", "n")).alias("at"))
    wanted = first.groupBy(F.col("at.doc_id").alias("doc_id")).agg(
        F.collect_list(F.struct("h", "at.start", "at.n")).alias("wanted"))
    schema = T.StructType([T.StructField("h", T.LongType()), T.StructField("members", T.BinaryType()),
                           T.StructField("n", T.LongType())])

    def cut(batches):
        for b in batches:
            out = []
            for text, rows in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                hashes, _ = hashed_words(text)
                shingles = shingle_hashes(hashes, SHINGLE)
                rows = [r for r in rows if r["start"] + r["n"] <= len(hashes)]
                sets = [np.unique(shingles[r["start"]:r["start"] + r["n"] - SHINGLE + 1]) for r in rows]
                sums = np.array([mix(s + np.uint64(1)).sum(dtype=np.uint64) for s in sets], np.uint64)
                line = np.array([r["n"] > words for r in rows], bool)
                for r, s, h in zip(rows, sets, np.where(line, _set_hashes(sums, True), _set_hashes(sums, False)).tolist()):
                    if h == r["h"]:
                        out.append((h, s.tobytes(), len(s)))
            cols = [*zip(*out)] or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.int64()))], schema.names)

    def member(row: dict):
        return row["h"], row["own"], np.frombuffer(row["members"], np.uint64)

    texts = docs.join(wanted.hint("shuffle_hash"), "doc_id").select("text", "wanted")
    found = written(map_batches(texts, cut, schema).dropDuplicates(["h"]), "paragraph-sets")
    bands = found.join(mixed.select("h", F.col("band").alias("cluster")).distinct().hint("merge"), "h")
    links = tree_links(block_pairs(blocked(bands, block)), member, percent)
    return components(written(links, "paragraph-links")).select(F.col("id").alias("h"), "component")


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT,
                   recall: float = RECALL, words: int = WORDS, reach: int = REACH, block: int = BLOCK) -> DataFrame:
    """Removed spans: ``doc_id``, ``start`` and ``end`` (words, end excluded), ``kept_doc`` and
    ``kept_start`` (where the first copy stays), ``cluster_id`` of the first paragraph."""
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).where(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    docs = dealt(docs, "doc_id", "passage-texts")
    rows = paragraphs(docs, tune(percent, recall), words, reach)
    # one shuffle by band; a band's rows stand together, and its extremes tell whether any two meet
    band = Window.partitionBy("band")
    met = rows.withColumns({"mixed": F.min("h").over(band) != F.max("h").over(band),
                            "shared": F.min("doc_id").over(band) != F.max("doc_id").over(band)})
    members = written(met.where(F.col("mixed") | F.col("shared")).drop("shared"), "colliding")
    similar = _verified(docs, members, percent, words, block)
    names = ("start", "n", "next", "link")
    places = members.select("doc_id", *names, "h").distinct().join(similar, "h", "left").select(
        "doc_id", *names, F.coalesce("component", "h").alias("cluster_id"))
    places = written(places, "paragraphs")
    kept = places.groupBy("cluster_id").agg(F.min(F.struct("doc_id", *names)).alias("kept"), F.max("doc_id").alias("last"))
    kept = kept.where(F.col("kept.doc_id") != F.col("last")).select("cluster_id", "kept")
    gone = places.join(kept, "cluster_id").where(F.col("doc_id") != F.col("kept.doc_id")).select(
        "doc_id", (F.col("n") > words).alias("line"), "start", (F.col("start") + F.col("n")).alias("end"), "next",
        (F.col("link") == F.col("kept.link")).alias("same"), "cluster_id", F.col("kept.doc_id").alias("kept_doc"),
        F.col("kept.start").alias("kept_start"), (F.col("kept.start") + F.col("kept.n")).alias("kept_end"),
        F.col("kept.next").alias("kept_next"))
    order = Window.partitionBy("doc_id", "line").orderBy("start")
    lag = lambda c: F.lag(c).over(order)
    follows = lag("same") & (F.col("kept_doc") == lag("kept_doc")) & (F.col("start") == lag("next")) & (
        F.col("kept_start") == lag("kept_next"))
    gone = gone.withColumn("new", F.when(follows, 0).otherwise(1)).withColumn("run", F.sum("new").over(order))
    runs = gone.groupBy("doc_id", "line", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kept_doc", "start").alias("kept_doc"),
        F.min("kept_start").alias("kept_start"), F.max("kept_end").alias("kept_end"),
        F.min_by("cluster_id", "start").alias("cluster_id")).drop("line", "run")
    shift, last = F.col("kept_start") - F.col("start"), F.col("kept_end") - F.col("end")
    runs = runs.select("*", shift.alias("shift"), last.alias("last"), F.when(shift != last, F.col("start")).alias("own"))
    runs = written(_united(runs, "kept_doc", "shift", "last", "own"), "runs")
    found = ("doc_id", "start", "end", "kept_doc", "kept_start", "cluster_id")
    return _united(_extended(docs, runs).unionByName(runs.select(*found))).select(*found)


def _contexts(docs: DataFrame, ends: DataFrame, length: int) -> DataFrame:
    """Hashes of up to ``length`` words before (``after`` false) or after places of kept documents
    (in reverse order before), and whether there are ``more``."""
    wanted = ends.groupBy("kept_doc", "after", "kept_at").agg(F.least(F.max("room"), F.lit(length)).alias("size"))
    wanted = wanted.groupBy(F.col("kept_doc").alias("doc_id")).agg(
        F.collect_list(F.struct("after", "kept_at", "size")).alias("wanted"))
    schema = T.StructType([T.StructField("kept_doc", T.LongType()), T.StructField("after", T.BooleanType()),
                           T.StructField("kept_at", T.LongType()), T.StructField("context", T.BinaryType()),
                           T.StructField("more", T.BooleanType())])

    def run(batches):
        for b in batches:
            out = []
            for i, text, rows in zip(*(c.to_pylist() for c in b.columns)):
                hashes, _ = hashed_words(text)
                for r in rows:
                    at, size = r["kept_at"], r["size"]
                    side = hashes[at:at + size] if r["after"] else hashes[max(0, at - size):at][::-1]
                    more = at + size < len(hashes) if r["after"] else at > size
                    out.append((i, r["after"], at, side.tobytes(), more))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(
                [*zip(*out)] or [()] * 5, pa.schema(list(zip(schema.names, (
                    pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.bool_())))))], schema.names)

    found = map_batches(docs.join(wanted.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "wanted"), run, schema)
    return found.groupBy("kept_doc", "after", "kept_at").agg(F.min(F.struct("context", "more")).alias("kept"))


def _reached(docs: DataFrame, ends: DataFrame) -> DataFrame:
    """``ends`` moved on by the ``n`` words that equal their contexts, within their ``room``, and
    whether they may go on (``open``)."""
    met = ends.groupBy("doc_id").agg(F.collect_list(F.struct(*[c for c in ends.columns if c != "doc_id"])).alias("ends"))
    held = ("after", "at", "kept_doc", "kept_at", "room", "cluster_id")
    types = (pa.int64(), pa.bool_(), *[pa.int64()] * 6, pa.bool_())
    schema = ("doc_id long, after boolean, at long, kept_doc long, kept_at long, room long, cluster_id long, n long, "
              "open boolean")

    def run(batches):
        for b in batches:
            out = []
            for i, text, rows in zip(*(c.to_pylist() for c in b.columns)):
                hashes, _ = hashed_words(text)
                for r in rows:
                    at, kept = r["at"], np.frombuffer(r["kept"]["context"], np.uint64)
                    own = hashes[at:at + len(kept)] if r["after"] else hashes[max(0, at - len(kept)):at][::-1]
                    differ = np.flatnonzero(own != kept[:len(own)])
                    n = min(int(differ[0]) if len(differ) else len(own), r["room"])
                    out.append((i, *[r[c] for c in held], n, n == len(kept) and n < r["room"] and r["kept"]["more"]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([*zip(*out)] or [()] * 9, types)],
                                             ["doc_id", *held, "n", "open"])

    found = map_batches(docs.join(met.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "ends"), run, schema)
    found = found.groupBy("doc_id", *held).agg(F.min("n").alias("n"), F.min("open").alias("open"))
    return found.withColumns({c: F.when(F.col("after"), F.col(c) + F.col("n")).otherwise(F.col(c) - F.col("n"))
                              for c in ("at", "kept_at")})


def _extended(docs: DataFrame, runs: DataFrame, length: int = CONTEXT) -> DataFrame:
    """What runs gain on either side: spans beside them whose words equal those of the kept text."""
    order = Window.partitionBy("doc_id", "kept_doc", "shift", "last", "own").orderBy("start")
    before, after = F.col("start") - F.lag("end").over(order), F.lead("start").over(order) - F.col("end")
    ends = runs.withColumns({"before": before, "behind": after}).select("doc_id", "kept_doc", "cluster_id", F.inline(F.array(*[
        F.struct(F.lit(side).alias("after"), at.alias("at"), kept_at.alias("kept_at"),
                 F.coalesce(room, F.lit(1 << 62)).alias("room"))
        for side, at, kept_at, room in ((False, F.col("start"), F.col("kept_start"), F.col("before")),
                                        (True, F.col("end"), F.col("end") + F.col("last"), F.col("behind")))])))
    gains = None
    while True:
        contexts = written(_contexts(docs, ends, length), "contexts")
        met = ends.join(contexts.hint("merge"), ["kept_doc", "after", "kept_at"])
        found = written(_reached(docs, met), "reached")
        back = F.when(F.col("after"), F.col("n")).otherwise(0)
        gain = found.where(F.col("n") > 0).select(
            "doc_id", (F.col("at") - back).alias("start"), (F.col("at") - back + F.col("n")).alias("end"), "kept_doc",
            (F.col("kept_at") - back).alias("kept_start"), "cluster_id")
        gains = gain if gains is None else gains.unionByName(gain)
        ends = found.where("open").withColumn("room", F.col("room") - F.col("n")).drop("n", "open")
        if ends.isEmpty():
            return gains
        length *= 8


def _united(runs: DataFrame, *keys: str) -> DataFrame:
    """Runs of a document (and ``keys``) that overlap or touch, as one span each."""
    order = Window.partitionBy("doc_id", *keys).orderBy("start", "end")
    new = F.col("start") > F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("new", F.when(new, 1).otherwise(0)).withColumn(
        "span", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    first = F.min(F.struct("start", F.col("kept_doc").alias("doc"), "kept_start", "cluster_id")).alias("first")
    return runs.groupBy("doc_id", *keys, "span").agg(first, F.max("end").alias("end")).select(
        "doc_id", *[k for k in keys if k != "kept_doc"], "first.start", "end", F.col("first.doc").alias("kept_doc"),
        "first.kept_start", "first.cluster_id")


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans and the white space after each."""
    raw = text.encode()
    at = [m.start() for m in _WORD.finditer(raw)] + [len(raw)]
    out, place = [], 0
    for start, end in sorted(spans):
        out.append(raw[place:at[min(start, len(at) - 1)]])
        place = max(place, at[min(end, len(at) - 1)])
    return b"".join([*out, raw[place:]]).decode()


def remove_spans(docs: DataFrame, spans: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the spans of ``repeated_spans``."""
    gone = spans.groupBy(F.col("doc_id").alias("id")).agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    names = docs.columns
    held = docs.select(F.struct("*").alias("d"), F.col(key).alias("id")).join(gone, "id", "left").select("d", "spans")

    def run(batches):
        for b in batches:
            row, lists = b.column(0), b.column(1).to_pylist()
            texts = row.field(names.index(text)).to_pylist()
            out = [cut_words(t, [(s["start"], s["end"]) for s in x]) if x and t else t for t, x in zip(texts, lists)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.string()) if c == text else row.field(i) for i, c in enumerate(names)], names)

    return map_batches(held, run, docs.schema)


def op7_substring_dedup(spark, sf_dir):
    return repeated_spans(table(spark, sf_dir, "documents"))
