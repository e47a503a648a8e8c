"""Filter interaction audit (operator 11).

What each filter of a set removes depends on the filters before it.  The audit applies the
filters in every order and reports, for each step of each order, what stays, what goes, what
had failed but was gone already, and what only this filter would have caught.

Measures come from a table-driven byte transducer.  ``STEP`` and ``EMIT`` give, for a state
(between words or in a word) and a byte of UTF-8 (or the end of a text), the next state and
the events: a word starts or ends, a capital, a code point, a symbol.  The state before a byte
depends on the byte before it alone, so one pass of table look-ups over the bytes of many texts
runs the machine.  The word spans that it emits go into a hash table with open addressing; a
span meets an earlier one only if text, length and every byte are equal, so distinct words are
counted exactly.  Texts longer than ``SLICE`` bytes are cut at white space and the machine goes
on with the next part.

Equal texts are told by a 128-bit digest.  Rows become counts by digest, part, failures and
labels before they meet by digest, and only few such rows of one digest can remain, so neither
a text with a third of all rows nor a hot part is a hot spot; then counts by part and failures
(at most 32) are all that the orders are applied to.

Defined cases: a null text is empty, a null part is the empty string; a row without an id is
identical to no smaller id and makes nothing a copy; rows that share an id are counted each,
are no copies of each other, and share their labels; labels that are repeated count if one of
them says so; an empty table gives no rows; other columns of either table are ignored.
"""

from __future__ import annotations

import hashlib
import json
from functools import reduce
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import map_batches, table, written
from footfall.llm.shingles import mix

SLICE = 1 << 20
LONG_WORD = 64  # words of more bytes are hashed and compared one by one
#: Characters that filter D looks for.
SYMBOLS = b"#$%&*|"

BETWEEN, IN_WORD = 0, 1
END_OF_TEXT = 0xFF  # a byte that UTF-8 never uses
STARTS, ENDS, CAPITAL, POINT, SYMBOL = 1, 2, 4, 8, 16
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.uint64(8)

#: The filter that needs the other rows: equal to a text with a smaller id.
COPY = "E"
#: Filters by name, as SQL conditions on the counts; a row fails where the condition holds.
FILTERS = {
    "A": "n_words < 200",
    "B": "100 * n_distinct < 50 * n_words",
    "C": "100 * n_capitals > 3 * n_points",
    "D": "n_symbols > 0",
    COPY: "copied",
}


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """(next state by byte, events by state and byte)."""
    step = np.full(256, IN_WORD, np.uint8)
    step[[0x20, *range(0x09, 0x0E), END_OF_TEXT]] = BETWEEN
    emit = np.zeros((2, 256), np.uint8)
    emit[BETWEEN, step == IN_WORD] |= STARTS
    emit[IN_WORD, step == BETWEEN] |= ENDS
    byte = np.arange(256)
    emit[:, (byte >= ord("A")) & (byte <= ord("Z"))] |= CAPITAL
    emit[:, ((byte & 0xC0) != 0x80) & (byte != END_OF_TEXT)] |= POINT
    emit[:, list(SYMBOLS)] |= SYMBOL
    return step, emit


STEP, EMIT = _machine()


class WordTable:
    """Word spans of one buffer in a table with open addressing; spans of one text and the same
    bytes share an entry."""

    def __init__(self, buffer: bytes):
        """``buffer`` ends with eight bytes that belong to no span."""
        self.buffer = buffer
        self.eights = np.ndarray(len(buffer) - 7, "<u8", buffer, strides=(1,))

    def _block(self, at: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Up to eight bytes from ``at`` on as integers, zero after ``left`` bytes."""
        unused = np.maximum(8 - left, 0).astype(np.uint64) * _BYTES
        return (self.eights[at] << unused) >> unused

    def _hash(self, texts, starts, lengths) -> np.ndarray:
        out = mix(texts.astype(np.uint64) * _ODD + lengths.astype(np.uint64))
        long = lengths > LONG_WORD
        for i in np.flatnonzero(long).tolist():
            word = self.buffer[starts[i]:starts[i] + lengths[i]]
            out[i] ^= np.uint64(xxhash.xxh3_64_intdigest(word))
        rows, k = np.flatnonzero(~long), 0
        while len(rows):
            out[rows] = mix(out[rows] * _ODD + self._block(starts[rows] + k, lengths[rows] - k))
            k += 8
            rows = rows[lengths[rows] > k]
        return out

    def _equal(self, starts, others, lengths) -> np.ndarray:
        """Whether the bytes of spans of equal lengths are equal."""
        out = np.ones(len(starts), bool)
        rows, k = np.flatnonzero(starts != others), 0
        for i in rows[lengths[rows] > LONG_WORD].tolist():
            a, b, n = starts[i], others[i], lengths[i]
            out[i] = self.buffer[a:a + n] == self.buffer[b:b + n]
        rows = rows[lengths[rows] <= LONG_WORD]
        while len(rows):
            left = lengths[rows] - k
            out[rows] = self._block(starts[rows] + k, left) == self._block(others[rows] + k, left)
            k += 8
            rows = rows[out[rows] & (lengths[rows] > k)]
        return out

    def insert(self, texts: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The spans that got an entry of their own: one of each distinct word of each text."""
        n = len(starts)
        size = 1 << max(1, 2 * n - 1).bit_length()
        hashes = self._hash(texts, starts, lengths)
        slots, entry = (hashes & np.uint64(size - 1)).astype(np.int64), np.full(size, -1, np.int64)
        own, waiting = [], np.arange(n)
        while len(waiting):
            at = slots[waiting]
            free = entry[at] < 0
            entry[at[free]] = waiting[free]
            holder = entry[at]
            own.append(waiting[holder == waiting])
            same = (hashes[holder] == hashes[waiting]) & (texts[holder] == texts[waiting]) & (
                lengths[holder] == lengths[waiting])
            at = np.flatnonzero(same)
            same[at] = self._equal(starts[waiting[at]], starts[holder[at]], lengths[waiting[at]])
            waiting = waiting[~same]
            slots[waiting] = (slots[waiting] + 1) & (size - 1)
        return np.concatenate(own) if own else waiting


def transduce(texts: list[bytes]) -> tuple[np.ndarray, WordTable, tuple[np.ndarray, ...]]:
    """Counts (words, distinct words, capitals, points, symbols) of each text, a row each, and the
    table with the spans (text, start, length) of the distinct words."""
    end = bytes([END_OF_TEXT])
    buffer = end.join([*texts, b"\0" * 8])
    content = np.frombuffer(buffer, np.uint8, len(buffer) - 8)
    states = STEP[content]
    before = np.empty_like(states)
    before[:1], before[1:] = BETWEEN, states[:-1]
    events = EMIT.reshape(-1)[before.astype(np.uint16) * 256 + content]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    firsts = np.cumsum(sizes) - sizes
    count = lambda event: np.add.reduceat(((events & event) != 0).astype(np.int32), firsts)
    starts, ends = np.flatnonzero(events & STARTS), np.flatnonzero(events & ENDS)
    owners = np.searchsorted(firsts, starts, "right") - 1
    words = WordTable(buffer)
    own = words.insert(owners, starts, ends - starts)
    distinct = np.bincount(owners[own], minlength=len(texts))
    counts = np.stack([np.bincount(owners, minlength=len(texts)), distinct, count(CAPITAL), count(POINT), count(SYMBOL)], 1)
    return counts, words, (owners[own], starts[own], (ends - starts)[own])


def _long(text: bytes) -> np.ndarray:
    """Counts of a text that is cut at white space, part after part."""
    total, seen, at = np.zeros(5, np.int64), set(), 0
    while at < len(text):
        end = at + SLICE
        while end < len(text) and STEP[text[end]] == IN_WORD:
            end += 1
        counts, words, (_, starts, lengths) = transduce([text[at:end]])
        total += counts[0]
        seen.update(words.buffer[s:s + n] for s, n in zip(starts.tolist(), lengths.tolist()))
        at = end
    total[1] = len(seen)
    return total


def counts(texts: list[bytes]) -> np.ndarray:
    """Counts of each text; several texts go through the machine at once."""
    out, first, size = [], 0, 0
    for i, t in enumerate([*texts, None]):
        if size and (t is None or size + len(t) > SLICE):
            out.append(transduce(texts[first:i])[0] if i - first > 1 or size <= SLICE else _long(texts[first])[None])
            first, size = i, 0
        size += 0 if t is None else len(t) + 1
    return np.concatenate(out) if out else np.zeros((0, 5), np.int64)


_COUNTS = ["n_words", "n_distinct", "n_capitals", "n_points", "n_symbols"]


def measures(docs: DataFrame, keep=("doc_id", "lang"), text: str = "text") -> DataFrame:
    """The columns ``keep``, the counts of ``text`` and its ``digest``."""
    held = [docs.schema[c] for c in keep]
    schema = T.StructType([*held, *[T.StructField(c, T.LongType()) for c in _COUNTS], T.StructField("digest", T.BinaryType())])

    def run(batches):
        for b in batches:
            texts = [t or b"" for t in b.column("_content").to_pylist()]
            found = counts(texts).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(f.name) for f in held], *[pa.array(found[:, i].copy()) for i in range(5)],
                 pa.array([hashlib.blake2b(t, digest_size=16).digest() for t in texts], pa.binary())], schema.names)

    return map_batches(docs.select(*[f.name for f in held], F.col(text).cast("binary").alias("_content")), run, schema)


def failures(docs: DataFrame, labels: DataFrame, filters: dict[str, str] = FILTERS, key: str = "doc_id",
             text: str = "text", part: str = "lang") -> DataFrame:
    """``part``, ``mask`` (bit i: the i-th filter fails), ``good``, ``toxic`` and the number ``n`` of
    such rows; ``labels`` has the key, ``quality`` and ``toxic``."""
    bits = [F.when(F.expr(c), F.lit(1 << i)).otherwise(0) for i, (name, c) in enumerate(filters.items()) if name != COPY]
    alone = reduce(lambda a, b: a + b, bits, F.lit(0))
    d = docs.select(F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("text"))
    m = measures(d, ("id", "part")).select("id", "part", "digest", alone.alias("alone"))
    # repeated rows become one; a key that is null meets nothing
    m = written(m.groupBy("digest", "part", "alone", "id").agg(F.count("*").alias("n")), "filter-failures")
    said = labels.groupBy(F.col(key).alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    no = F.lit(False)
    named = m.where(F.col("id").isNotNull()).join(said, "id", "left").select(
        *m.columns, F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))
    labelled = named.unionByName(m.where(F.col("id").isNull()).select("*", no.alias("good"), no.alias("toxic")))
    cells = ["part", "alone", "good", "toxic"]
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("first")
    alike = labelled.groupBy("digest", *cells).agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"), first)
    least = alike.groupBy("digest").agg(F.min("first.id").alias("least"))
    alike = alike.join(least, "digest")
    kept = F.col("nameless") + F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = alike.select(*cells, F.inline(F.array(F.struct(F.lit(False).alias("copied"), kept.alias("m")),
                                                  F.struct(F.lit(True).alias("copied"), (F.col("n") - kept).alias("m")))))
    copy = F.when(F.expr(filters[COPY]), F.lit(1 << list(filters).index(COPY))).otherwise(0) if COPY in filters else F.lit(0)
    return split.groupBy("part", (F.col("alone") + copy).alias("mask"), "good", "toxic").agg(F.sum("m").alias("n"))


def audit(found: DataFrame, names: str = "".join(FILTERS)) -> DataFrame:
    """One row per part, ``filter_order`` and ``step`` from the counts of ``failures``."""
    parts = found.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("cells"))
    steps = []
    for order in permutations(range(len(names))):
        letters = "".join(names[i] for i in order)
        steps += [{"filter_order": letters, "step": s + 1, "bit": 1 << i, "prior": sum(1 << j for j in order[:s])}
                  for s, i in enumerate(order)]
    # one literal once folded, however many steps
    rows = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order: string, step: int, bit: int, prior: int>>")
    each = parts.select("part", "cells", F.inline(rows))

    def total(condition) -> Column:
        chosen = F.filter("cells", condition)
        return F.aggregate(chosen, F.lit(0).cast("long"), lambda a, c: a + c["n"])

    fails = lambda c: c["mask"].bitwiseAND(F.col("bit")) != 0
    there = lambda c: c["mask"].bitwiseAND(F.col("prior")) == 0
    stays = F.col("bit") + F.col("prior")
    out = each.select(
        "part", "filter_order", "step", "bit",
        total(lambda c: c["mask"].bitwiseAND(stays) == 0).alias("kept"),
        total(lambda c: fails(c) & there(c)).alias("removed"),
        total(lambda c: fails(c) & ~there(c)).alias("redundant"),
        total(lambda c: c["mask"] == F.col("bit")).alias("unique_fails"),
        total(lambda c: fails(c) & there(c) & c["good"]).alias("good_lost"),
        total(lambda c: fails(c) & there(c) & c["toxic"]).alias("toxic_lost"))
    share = out.groupBy("part", "bit").agg(F.sum("removed").alias("shapley"))
    return out.join(share, ["part", "bit"]).drop("bit")


def op11_filter_audit(spark, sf_dir):
    found = failures(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return audit(written(found, "filter-cells"))
