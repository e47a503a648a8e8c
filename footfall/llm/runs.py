"""Periodic run detection by online dyadic square catching (operator 13).

A text is a sequence of words.  A run is a stretch with smallest period ``q`` (words ``q``
apart are identical), at least ``max(least, 2 * q)`` words long, that no neighbouring word
extends.  ``SquareCatcher`` finds all runs of a growing text.

Periods are dealt to levels: level ``l`` has blocks of ``B = 2**l`` words that start at
multiples of ``B``, and periods from ``2B - 1`` to ``4B - 2``.  Every completed block is a
catcher.  A run of such a period holds a whole block among the words that have a partner ``q``
further on, because there are at least ``2B - 1`` of those.  So a suffix of ``B`` words, ended
by the word just appended, can be the partner of two blocks of the level only, and each
appended word costs two comparisons of hashes a level.  Equal suffixes of neighbouring blocks
at one distance chain up; the ends of a chain move on by fewer than ``B`` words, found by
the hashes of the lower levels; a chain as long as its distance is a square and, with its
ends, a run.  A multiple of a run's period chains over the same words, so of equal stretches
the least period counts.  The work is O(log n) array operations' elements a word, and memory
is O(log n) longs a word of one text.

Words are numbered exactly; blocks of two words and more are compared by 64-bit hashes.
Texts are independent, so nothing is shuffled: hot sources, copies and repeated rows have no
effect, and a lost executor costs its own batches.

Defined cases: a null, empty or blank text has no words and no runs; a text of any length is
read whole; repeated rows are handled one by one; an empty table gives no rows; other
columns are ignored (``keep`` passes some through, which must not be named like a result
column).
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import map_batches, table
from footfall.llm.shingles import mix

LEAST = 12
APPEND = 1 << 16  # words appended at a time
OUT_BYTES = 16 << 20  # text handed back at a time
_ODD = np.uint64(0x9E3779B97F4A7C15)

RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])


class SquareCatcher:
    """Runs of a text that grows by ``append``; the result does not depend on how it is cut."""

    def __init__(self, least: int = LEAST):
        self.least = least
        self.hashes = [np.zeros(0, np.uint64)]  # by level: hash of the 2**level words from each place
        self.caught: list[list[tuple[np.ndarray, np.ndarray]]] = [[]]  # by level: (distance, block)

    def append(self, numbers: np.ndarray) -> None:
        """Appends words, given as numbers that are equal for identical words only."""
        old = len(self.hashes[0])
        self.hashes[0] = np.concatenate([self.hashes[0], numbers.astype(np.uint64)])
        n = len(self.hashes[0])
        self._catch(0, old, n)
        level = 1
        while 2 * (2 * (1 << level) - 1) <= n:  # a square of the level's least period fits
            half, block = 1 << (level - 1), 1 << level
            if level == len(self.hashes):
                self.hashes.append(np.zeros(0, np.uint64))
                self.caught.append([])
            below, known = self.hashes[level - 1], self.hashes[level]
            first, last = len(known), n - block + 1
            fresh = mix(below[first:last] * _ODD + below[first + half:last + half])
            self.hashes[level] = np.concatenate([known, fresh]) if first else fresh
            self._catch(level, first, last)
            level += 1

    def _catch(self, level: int, first: int, last: int) -> None:
        """Compares the suffixes that start at ``first`` to ``last`` with the two blocks that each
        can be a partner of."""
        block, hashes = 1 << level, self.hashes[level]
        for back in (0, block):
            low = max(first, 2 * block - 1 + back)
            if low >= last:
                continue
            places = np.arange(low, last)
            blocks = places - (2 * block - 1)
            blocks -= blocks % block + back
            hit = np.flatnonzero(hashes[low:last] == hashes[blocks])
            if len(hit):
                self.caught[level].append((places[hit] - blocks[hit], blocks[hit]))

    def _chains(self, level: int):
        """Start, end and distance of the stretches of this level whose words equal those a
        distance further on."""
        distance, block = (np.concatenate(x) for x in zip(*self.caught[level]))
        size, n = 1 << level, len(self.hashes[0])
        order = np.lexsort((block, distance))
        distance, block = distance[order], block[order]
        new = np.ones(len(block), bool)
        new[1:] = (distance[1:] != distance[:-1]) | (block[1:] != block[:-1] + size)
        at = np.flatnonzero(new)
        start, q = block[at], distance[at]
        end = block[np.append(at[1:], len(block)) - 1] + size
        for k in range(level - 1, -1, -1):
            step, hashes = 1 << k, self.hashes[k]
            fits = np.flatnonzero(end + q + step <= n)
            grow = fits[hashes[end[fits]] == hashes[end[fits] + q[fits]]]
            end[grow] += step
            fits = np.flatnonzero(start >= step)
            grow = fits[hashes[start[fits] - step] == hashes[start[fits] - step + q[fits]]]
            start[grow] -= step
        return start, end, q

    def runs(self) -> np.ndarray:
        """(start, length, period) of the runs of the text so far, by start, then period."""
        found = [self._chains(level) for level in range(len(self.caught)) if self.caught[level]]
        if not found:
            return np.zeros((0, 3), np.int64)
        start, end, q = (np.concatenate(x) for x in zip(*found))
        square = end - start >= np.maximum(q, self.least - q)
        start, q, length = start[square], q[square], (end - start + q)[square]
        order = np.lexsort((q, length, start))
        start, length, q = start[order], length[order], q[order]
        least = np.ones(len(start), bool)
        least[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
        out = np.stack([start[least], length[least], q[least]], 1)
        return out[np.lexsort((out[:, 2], out[:, 0]))]


def word_runs(words: list[bytes], least: int = LEAST, step: int = APPEND) -> np.ndarray:
    """The runs of a text of words, appended ``step`` at a time."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    catcher = SquareCatcher(least)
    if len(number) < len(words):
        for at in range(0, len(words), step):
            part = words[at:at + step]
            catcher.append(np.fromiter(map(number.__getitem__, part), np.uint64, len(part)))
    return catcher.runs()


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that some run repeats: only its first period stays."""
    if not len(runs):
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, keep=(),
                  edit=None) -> DataFrame:
    """The key, the columns ``keep``, ``n_words``, ``runs`` (array of start, length, period; words
    count from 0) and ``collapsed`` (the words that stay, joined by one space) of every row.

    ``edit(key, words)`` may replace the words of a text before they are searched.
    """
    held = [docs.schema[c] for c in dict.fromkeys([key, *keep])]
    schema = T.StructType([*held, T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN, False)),
                           T.StructField("collapsed", T.StringType())])
    kind = pa.list_(pa.field("element", pa.struct([pa.field(c, pa.int64(), False) for c in RUN.names]), False))

    def batch(rows, sizes, runs, texts):
        flat = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
        offsets = np.cumsum([0, *map(len, runs)])
        found = pa.StructArray.from_arrays([pa.array(flat[:, i].copy()) for i in range(3)],
                                           fields=[kind.value_type.field(i) for i in range(3)])
        return pa.RecordBatch.from_arrays(
            [*rows, pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), found, type=kind),
             pa.array(texts, pa.binary()).cast(pa.string())], schema.names)

    def run(batches):
        for b in batches:
            keys, contents = b.column(key), b.column("_content")
            first, size, sizes, runs, texts = 0, 0, [], [], []
            for i, (k, t) in enumerate(zip(keys, contents)):
                words = (t.as_py() or b"").split()
                if edit is not None:
                    words = edit(k.as_py(), words)
                sizes.append(len(words))
                runs.append(word_runs(words, least))
                texts.append(b" ".join(collapsed(words, runs[-1])))
                size += len(texts[-1])
                if size > OUT_BYTES:
                    yield batch([b.column(f.name).slice(first, len(sizes)) for f in held], sizes, runs, texts)
                    first, size, sizes, runs, texts = i + 1, 0, [], [], []
            yield batch([b.column(f.name).slice(first, len(sizes)) for f in held], sizes, runs, texts)

    return map_batches(docs.select(*[f.name for f in held], F.col(text).cast("binary").alias("_content")), run, schema)


def recycled(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The edit that the query prescribes: every tenth document, by checksum of its id, goes on with
    the words from a place on over and over; rows without an id stay as they are."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(b"%d" % doc_id), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    once = words[a:a + p]
    return (words[:a] + once * -(-(n - a) // p))[:n]


def op13_periodic_runs(spark, sf_dir):
    found = periodic_runs(table(spark, sf_dir, "documents"), edit=recycled)
    # greatest length; of equal ones the least start, then period
    best = F.get(F.sort_array(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period")))), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    found = found.select("doc_id", "runs", "collapsed", best.alias("best"), listed.alias("listed"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        (-F.col("best.l")).alias("length"), F.col("best.period").alias("period"),
        F.expr("-1000 * best.l div best.period").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
