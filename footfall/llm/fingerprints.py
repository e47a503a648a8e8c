"""Homomorphic multiset fingerprints of documents (operator 1, native).

Every unit of a text (a paragraph, cut further at sentence ends so that long paragraphs do
not hide what they share) is hashed to a wide vector: 126 counters of 0 or 1 and 4 lanes of
32 bits.  A fingerprint is the sum of the vectors, counters modulo 2^20 and lanes modulo
2^32, and the number of units.  Sums do not depend on order, and ``add``/``subtract`` insert
or delete units, or whole fingerprints, without the text.  The centred counters are +-1 sums,
so differences of two fingerprints estimate how many units two texts do not share.

A fingerprint is an array of 47 longs: 42 hold three counters each (bits 0, 21 and 42, one
guard bit each), 4 hold a lane, the last the number of units modulo 2^32.

Defined cases: a null text counts as empty; the empty text has the zero vector, equal to
itself (likeness 1) and unlike any other text (0).  Repeated rows get equal fingerprints;
other columns pass through, whatever their names; a column named like a result is overwritten.  More than 2^20
units of one text wrap around, as defined by the sums; equality is unaffected.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import partitions, table

SLICES = 21
ONES = 1 | 1 << 21 | 1 << 42
GUARDED = sum((2**20 - 1) << s for s in (0, 21, 42))
COUNTERS = 2 * SLICES
LANES = 4
LOW = 2**32 - 1
UNIT_ENDS = r"\n+|(?<=[.!?])[\x20\t]+"


def units(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), UNIT_ENDS), lambda u: u != "")


def _hashes(text_units: Column) -> Column:
    return F.transform(text_units, lambda u: F.struct(
        F.xxhash64(F.lit(0), u).alias("p"), F.xxhash64(F.lit(1), u).alias("q"),
        F.xxhash64(F.lit(2), u).alias("r"), F.xxhash64(F.lit(3), u).alias("s")))


def _sum(hashes: str, term, mask: int) -> Column:
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: (a + term(h)).bitwiseAND(F.lit(mask)))


def _bits(h: Column, i: Column) -> Column:
    return F.call_function("shiftrightunsigned", h, i).bitwiseAND(F.lit(ONES))


def _counters(hashes: str, part: str) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(SLICES - 1)),
                       lambda i: _sum(hashes, lambda h: _bits(h[part], i), GUARDED))


def _lane(hashes: str, part: str, shift: int) -> Column:
    return _sum(hashes, lambda h: F.call_function("shiftrightunsigned", h[part], F.lit(shift)).bitwiseAND(
        F.lit(LOW)), LOW)


def _vector(hashes: str) -> Column:
    """Sum of the vectors of an array of unit hashes."""
    lanes = [_lane(hashes, part, shift) for part in "rs" for shift in (0, 32)]
    return F.concat(_counters(hashes, "p"), _counters(hashes, "q"),
                    F.array(*lanes, F.size(hashes).cast("long")))


def fingerprinted(df: DataFrame, text: str, name: str = "fp") -> DataFrame:
    """``df`` with the fingerprint of ``text`` in the column ``name``."""
    held = [c for c in df.columns if c != name]
    d = df.select(F.struct(*held).alias("d"), units(F.col(text)).alias("u"))
    d = d.select("d", _hashes(F.col("u")).alias("h"))
    return d.select(*[F.col("d")[c].alias(c) for c in held], _vector("h").alias(name))


def _combine(a: Column, b: Column, sign: int) -> Column:
    mask = lambda i: F.when(i < COUNTERS, GUARDED).otherwise(LOW)
    spare = lambda i: F.when(i < COUNTERS, sum(1 << s for s in (20, 41, 62))).otherwise(1 << 32)
    both = F.zip_with(a, b, (lambda x, y: F.struct(x.alias("x"), y.alias("y"))))
    return F.transform(both, lambda e, i: (
        (e["x"] + e["y"]) if sign > 0 else (e["x"] + spare(i) - e["y"])).bitwiseAND(mask(i)))


def add(a: Column, b: Column) -> Column:
    """Fingerprint of the units of both."""
    return _combine(a, b, 1)


def subtract(a: Column, b: Column) -> Column:
    """Fingerprint of the units of ``a`` without those of ``b``."""
    return _combine(a, b, -1)


def as_string(fp: Column) -> Column:
    return F.array_join(F.transform(fp, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def _centred(fp: Column) -> Column:
    """The 126 counters as +-1 sums."""
    n = F.get(fp, F.lit(COUNTERS + LANES))
    return F.flatten(F.transform(F.slice(fp, 1, COUNTERS), lambda x: F.transform(
        F.array(F.lit(0), F.lit(21), F.lit(42)),
        lambda s: 2 * F.call_function("shiftright", x, s).bitwiseAND(F.lit(2**20 - 1)) - n)))


def likeness(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """``df`` with one column per pair of fingerprint columns: the estimated share of units
    in common, 2|A and B| / (|A| + |B|), from the vectors alone; 1 for equal, 0 at least."""
    for name, (a, b) in pairs.items():
        held = [c for c in df.columns if c != name]
        d = df.select(F.struct(*df.columns).alias("d"), _centred(F.col(a)).alias("x"), _centred(F.col(b)).alias("y"))
        sq = lambda c: F.aggregate(c, F.lit(0.0), lambda t, v: t + v * v)
        d = d.select("d", sq(F.zip_with("x", "y", lambda x, y: (x - y).cast("double"))).alias("apart"),
                     (sq(F.col("x").cast("array<double>")) + sq(F.col("y").cast("array<double>"))).alias("all"))
        est = F.greatest(F.lit(0.0), 1 - F.col("apart") / F.nullif(F.col("all"), F.lit(0.0)))
        same = F.col("d")[a] == F.col("d")[b]
        df = d.select(*[F.col("d")[c].alias(c) for c in held],
                      F.when(same, 1.0).otherwise(F.coalesce(est, F.lit(0.0))).alias(name))
    return df


def _range(key: str, kind: str, ends: list) -> tuple[Column, Column]:
    """Number of the range that ``key`` falls in (0 for null), and whether it is the range's end.

    The ends are one literal, whatever their number, in groups: a row looks through the groups'
    last ends and through one group.
    """
    step = max(1, math.isqrt(len(ends)))
    groups = [ends[i:i + step] for i in range(0, len(ends), step)]
    held = F.from_json(F.lit(json.dumps([{"last": g[-1], "ends": g} for g in groups])), f"array<struct<last: {kind}, ends: array<{kind}>>>")
    k = F.col(key)
    before = lambda x: F.coalesce(F.size(F.filter(x, lambda e: e < k)), F.lit(0))
    group = F.coalesce(F.size(F.filter(held, lambda g: g["last"] < k)), F.lit(0))
    inside = before(F.get(held, group)["ends"])
    return (F.when(k.isNull(), 0).otherwise(group * step + inside),
            F.coalesce(F.get(F.get(held, group)["ends"], inside) == k, F.lit(False)))


def with_next(df: DataFrame, key: str, carry: list[str]) -> DataFrame:
    """``df`` with ``next``: a struct of ``carry`` of the next row in descending ``key``, that
    of the first row after the last.

    Rows are dealt into ranges of the key that end at quantiles of it (a bounded list, sized
    by the shuffle partitions, is all that the driver sees).  The row at the end of a range is
    copied into the range above it, where it follows the last row, so each range is complete
    and one shuffle suffices.  Ties of the key go by the first of ``carry``; null keys come
    last.
    """
    n = 4 * partitions(df.sparkSession)
    ends = df.select(F.percentile_approx(key, [(i + 1) / n for i in range(n)], 100_000).alias("q"),
                     F.max(key).alias("m")).first()
    ends = sorted({*(ends["q"] or []), ends["m"]} - {None})
    d = df.select(F.struct(*df.columns).alias("d"), F.struct(*carry).alias("c"), F.col(key).alias("k"))
    if not ends:  # null keys only
        w = Window.orderBy(F.col("c")[carry[0]])
        return d.select("d.*", F.coalesce(F.lead("c").over(w), F.first("c").over(w)).alias("next"))
    at, is_end = _range("k", df.schema[key].dataType.simpleString(), ends)
    d = d.withColumns({"r": at, "end": is_end})
    copies = F.array(F.struct(F.col("r").alias("r"), F.lit(False).alias("copy")))
    more = F.array(F.struct(((F.col("r") + 1) % len(ends)).alias("r"), F.lit(True).alias("copy")))
    d = d.select("d", "c", "k", F.explode(F.when(F.col("end"), F.concat(copies, more)).otherwise(copies)).alias("x"))
    d = d.select("d", "c", "k", "x.r", "x.copy")
    w = Window.partitionBy("r").orderBy("copy", F.col("k").desc_nulls_last(), F.col("c")[carry[0]])
    return d.withColumn("next", F.lead("c").over(w)).where(~F.col("copy")).select("d.*", "next")


def op1_fingerprints(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = with_next(fingerprinted(docs, "text"), "doc_id", ["text", "fp"])
    half = F.floor(F.col("n_chars") / 2).cast("int")
    d = d.withColumn("n_chars", F.length("text").cast("long"))
    d = d.select("doc_id", "n_chars", "fp", F.col("next")["fp"].alias("next_fp"), F.concat(
        F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
        F.substring(F.col("next")["text"], F.lit(1), half)).alias("edited"))
    d = fingerprinted(d, "edited", "edited_fp")
    d = likeness(d, {"near_edited": ("fp", "edited_fp"), "near_next": ("fp", "next_fp")})
    return d.select("doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"),
                    as_string(F.col("fp")).alias("fingerprint"),
                    as_string(F.col("edited_fp")).alias("edited_fingerprint"), "near_edited", "near_next")
