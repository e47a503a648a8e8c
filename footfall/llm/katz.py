"""Katz backoff language model (operator 2).

Counts of n-grams up to ``order`` are gathered over all training texts, discounted by
Good-Turing for counts up to ``MAX_DISCOUNTED``, and every context gets the weight that makes
its probabilities sum to one over the vocabulary and the unknown word.  A token's probability
is the discounted one if its n-gram was seen, else the context's weight times the probability
in the shorter context, down to the single word.

How it runs: texts are read in chunks of about ``CHUNK`` tokens.  For each order, every chunk
sends its distinct n-grams (as packed columns, not row by row) to the buckets of their
contexts; a bucket sums the counts of all chunks, keeps its part of the model table and
answers each chunk: ids, counts and context sums in the order it asked.  The chunks are then
met with their answers, and the next order or the scores follow.  Nothing else travels, so
the shuffle is a few bytes per distinct n-gram and chunk.  A context with more than its share
of the tokens is spread over several buckets, whose sums the chunk adds up.  The driver sees
the totals and the counts of counts only.  The number of buckets follows the bytes of the texts,
so a bucket does not grow with the input.

Chunks are cut from scan partitions, and cut again for each order rather than stored: a chunk
is named after its partition and content, and a run whose second reading differs stops with
an error instead of mixing answers.  Words are identified by 64-bit hashes.

Model tables: one folder per order with ``kind=model`` rows (packed contexts, words, counts)
per bucket.

Defined cases: a null or empty text is the end token alone; a null id is allowed (its row
trains, or not, as ``held_out`` says); repeated rows count again; with no training text every
token is unknown and has probability one; an empty table gives no rows.  Other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import map_batches, map_groups, partitions, scratch_path, table
from footfall.llm.shingles import hashed_words, mix

ORDER = 2
MAX_DISCOUNTED = 5
CHUNK = 1_000_000
#: Bytes of text behind a bucket: its n-grams are what a task holds at once.
BUCKET = 16 * 2**20
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: The end token's key: a string with a space in it is no word.
_END = np.uint64(xxhash.xxh3_64_intdigest(b"the end"))
_ROW = "chunk string, level int, bucket int, a binary, b binary, c binary, d binary, e binary"
_ANSWER = _ROW + ", stats array<long>, kind string"


def _pack(x: np.ndarray) -> bytes:
    """An array in the narrowest unsigned (or 8-byte float) form, compressed."""
    if x.dtype.kind != "f":
        x = x.astype(np.uint64) if not len(x) or int(x.max()) >= 1 << 32 else x.astype(
            np.uint32 if int(x.max()) >= 1 << 16 else np.uint16 if int(x.max()) >= 1 << 8 else np.uint8)
    code = {"u1": b"1", "u2": b"2", "u4": b"4", "u8": b"8", "f8": b"f"}[x.dtype.str[1:]]
    planes = x.view(np.uint8).reshape(len(x), x.itemsize).T  # bytes of equal weight together
    return code + zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(planes).tobytes())


def _unpack(data: bytes, floats: bool = False) -> np.ndarray:
    kind = {b"1": "u1", b"2": "u2", b"4": "u4", b"8": "u8", b"f": "f8"}[data[:1]]
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8)
    width = int(kind[1:])
    x = np.ascontiguousarray(raw.reshape(width, len(raw) // width).T).reshape(-1).view(f"<{kind}")
    return x if floats else x.astype(np.uint64 if kind == "u8" else np.int64)


def _table_of(x: np.ndarray) -> tuple[bytes, bytes]:
    """Floats as the list of distinct values and the places in it."""
    values, at = np.unique(x, return_inverse=True)
    return _pack(values), _pack(at)


def _chunks(batches, buckets: int, tokens: int):
    """(name, ids, null ids, held out, lengths, vocabulary keys, word places) of each chunk;
    the vocabulary is ordered by bucket and key."""
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    ids, none, held, lengths, parts, n, k = [], [], [], [], [], 0, 0

    def flush():
        nonlocal ids, none, held, lengths, parts, n, k
        keys, at = np.unique(np.concatenate(parts), return_inverse=True)
        order = np.lexsort((keys, keys % np.uint64(buckets)))
        place = np.empty(len(keys), np.int64)
        place[order] = np.arange(len(keys))
        at = place[at]
        name = f"{part}-{k}-{xxhash.xxh3_64_hexdigest(at.tobytes() + keys.tobytes() + repr(ids).encode())}"
        out = name, np.array(ids, np.int64), np.array(none, bool), np.array(held, bool), np.array(lengths), keys[order], at
        ids, none, held, lengths, parts, n, k = [], [], [], [], [], 0, k + 1
        return out

    for b in batches:
        for i, h, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            hashes = np.append(hashed_words(text.as_py())[0], _END)
            ids.append(i or 0)
            none.append(i is None)
            held.append(bool(h))
            lengths.append(len(hashes))
            parts.append(hashes)
            n += len(hashes)
            if n >= tokens:
                yield flush()
    if n:
        yield flush()


def _first_messages(docs: DataFrame, buckets: int, tokens: int) -> DataFrame:
    """Words and their training counts, by chunk and bucket."""

    def run(batches):
        for name, _, _, held, lengths, keys, at in _chunks(batches, buckets, tokens):
            counts = np.bincount(at[np.repeat(~held, lengths)], minlength=len(keys))
            cuts = np.searchsorted(keys % np.uint64(buckets), np.arange(buckets + 1, dtype=np.uint64))
            rows = [(name, 1, b, keys[x:y].tobytes(), _pack(counts[x:y]), None, None, None)
                    for b, (x, y) in enumerate(zip(cuts, cuts[1:])) if x < y]
            yield _batch(rows)

    return map_batches(docs, run, _ROW)


def _batch(rows) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.int32()] + [pa.binary()] * 5
    cols = [*zip(*rows)] or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                      ["chunk", "level", "bucket", "a", "b", "c", "d", "e"])


def _contents(docs: DataFrame, buckets: int, tokens: int) -> DataFrame:
    """The chunks themselves: word places, lengths, flags, ids."""

    def run(batches):
        for name, ids, none, held, lengths, keys, at in _chunks(batches, buckets, tokens):
            yield _batch([(name, 0, len(keys), _pack(at), _pack(lengths), _pack(held + 2 * none), ids.tobytes(), None)])

    return map_batches(docs, run, _ROW)


def _counts_of_counts(totals: np.ndarray) -> list[int]:
    return np.bincount(totals[(totals > 0) & (totals <= MAX_DISCOUNTED + 1)],
                       minlength=MAX_DISCOUNTED + 2)[1:].tolist()


def _answer_first(buckets: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(a, np.uint64) for a in rows["a"]]
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.concatenate([_unpack(b) for b in rows["b"]]).astype(np.int64)
        totals = np.bincount(at, weights=counts, minlength=len(distinct)).astype(np.int64)
        bucket = int(rows["bucket"].iat[0])
        ids = np.arange(len(distinct), dtype=np.uint64) * np.uint64(buckets) + np.uint64(bucket + 1)
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        out = [(chunk, 1, bucket, _pack(ids[x]), _pack(totals[x]), None, None, None, None, "answer")
               for chunk, x in zip(rows["chunk"], np.split(at, cuts))]
        seen = totals > 0
        out.append((None, 1, bucket, distinct[seen].tobytes(), _pack(totals[seen]), None, None, None,
                    [int(totals.sum()), int(seen.sum()), *_counts_of_counts(totals)], "model"))
        return pd.DataFrame(out, columns=_ANSWER_NAMES)

    return run


_ANSWER_NAMES = [x.split()[0] for x in _ANSWER.split(", ")]


def _answer(level: int, buckets: int):
    """Sums of a bucket: per n-gram its id and count; per context the sums that discounts and
    weights need: tokens, n-grams by small count, tokens of larger counts, lower-order mass."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        bucket = int(rows["bucket"].iat[0])
        contexts, runs, words, counts, lowers = [], [], [], [], []
        for a, b, c, d, e in zip(rows["a"], rows["b"], rows["c"], rows["d"], rows["e"]):
            contexts.append(_unpack(a).astype(np.uint64))
            runs.append(_unpack(b).astype(np.int64))
            words.append(_unpack(c).astype(np.uint64))
            counts.append(_unpack(d).astype(np.int64))
            cut = int.from_bytes(e[:4], "little")
            lowers.append(_unpack(e[4:4 + cut], True)[_unpack(e[4 + cut:]).astype(np.int64)])
        context = np.concatenate([np.repeat(x, r) for x, r in zip(contexts, runs)])
        word, count, lower = np.concatenate(words), np.concatenate(counts), np.concatenate(lowers)
        order = np.lexsort((word, context))
        new = np.ones(len(order), bool)
        new[1:] = (context[order][1:] != context[order][:-1]) | (word[order][1:] != word[order][:-1])
        at = np.empty(len(order), np.int64)
        at[order] = np.cumsum(new) - 1
        first = order[new]
        totals = np.bincount(at, weights=count, minlength=len(first)).astype(np.int64)
        gram_context, gram_word, gram_lower = context[first], word[first], lower[first]
        heads, head_at = np.unique(np.concatenate([gram_context, *contexts]), return_inverse=True)
        head_at = head_at[:len(first)]
        per = lambda w: np.bincount(head_at, weights=w, minlength=len(heads))
        sums = [per(totals).astype(np.int64)] + [per(totals == j).astype(np.int64) for j in range(1, MAX_DISCOUNTED + 1)]
        sums.append(per(totals * (totals > MAX_DISCOUNTED)).astype(np.int64))
        mass = per(gram_lower * (totals > 0))
        ids = np.arange(len(first), dtype=np.uint64) * np.uint64(buckets) + np.uint64(bucket + 1)
        out = []
        for chunk, x, own in zip(rows["chunk"], np.split(at, np.cumsum([len(w) for w in words])[:-1]), contexts):
            h = np.searchsorted(heads, own)
            out.append((chunk, level, bucket, _pack(ids[x]), _pack(totals[x]), _pack(own),
                        _pack(np.concatenate([s[h] for s in sums])), _pack(mass[h]), None, "answer"))
        seen = totals > 0
        out.append((None, level, bucket, _pack(gram_context[seen]), _pack(gram_word[seen]), _pack(totals[seen]), None, None,
                    [int(totals.sum()), int(seen.sum()), *_counts_of_counts(totals)], "model"))
        return pd.DataFrame(out, columns=_ANSWER_NAMES)

    return run


def discounts(counts_of_counts: list[int]) -> list[float]:
    """Katz's factors for counts 0 to ``MAX_DISCOUNTED``, from counts of counts smoothed by a line
    through their logarithms (as they fall with the count, each factor is above the last).  Where the
    counts of counts allow no such line, half of the singletons' mass goes, or none without singletons."""
    k, n = MAX_DISCOUNTED, np.array(counts_of_counts, float)
    out = [0.0] + [1.0] * k
    if not n[0]:
        return out
    seen = np.flatnonzero(n) + 1
    power = 0.0
    if len(seen) > 1:  # Good-Turing's (r + 1) n[r + 1] / (r n[r]) is ((r + 1) / r) ** power on the line
        power = np.polyfit(np.log(seen), np.log(n[seen - 1]), 1)[0] + 1
    if power > -1e-6:
        out[1] = 0.5
        return out
    rest = (k + 1) ** power
    return [0.0] + [float((((r + 1) / r) ** power - rest) / (1 - rest)) for r in range(1, k + 1)]


def _discounted(factors: list[float], counts: np.ndarray) -> np.ndarray:
    f = np.array([*factors, 1.0])
    return f[np.minimum(counts, MAX_DISCOUNTED + 1)] * counts


class _Chunk:
    """A chunk with the answers of its buckets: state of every order up to the last answered."""

    def __init__(self, rows: pd.DataFrame, params: list[dict], buckets: int):
        self.buckets, self.params = buckets, params
        content = rows[rows["level"] == 0]
        if len(content) != 1:
            raise RuntimeError("the chunks of this reading differ from those of the last; the input changed")
        _, _, size, a, b, c, d, _ = content.iloc[0][["chunk", "level", "bucket", "a", "b", "c", "d", "e"]]
        self.name = content["chunk"].iat[0]
        self.at = _unpack(a).astype(np.int64)
        self.lengths = _unpack(b).astype(np.int64)
        flags = _unpack(c).astype(np.int64)
        self.held, self.none, self.ids = flags % 2 == 1, flags >= 2, np.frombuffer(d, np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        first = rows[rows["level"] == 1].sort_values("bucket")
        self.word_ids = np.concatenate([_unpack(x).astype(np.uint64) for x in first["a"]])
        self.word_counts = np.concatenate([_unpack(x).astype(np.int64) for x in first["b"]])
        if len(self.word_ids) != size:
            raise RuntimeError("a chunk's answers are incomplete")
        p = params[0]
        self.gram, self.gram_ids, self.gram_counts = self.at, self.word_ids, self.word_counts
        self.gram_probs = np.where(self.word_counts > 0, _discounted(p["discounts"], self.word_counts) / p["whole"],
                                   p["unknown"])
        for level in range(2, len(params) + 1):
            self._grams()
            self._take(rows[rows["level"] == level], params[level - 1])

    def _grams(self):
        """Distinct n-grams of the next order: context and word of each, and of each token."""
        before = np.empty_like(self.gram)
        before[1:] = self.gram[:-1]
        start = len(self.gram_ids)  # the context of a first word
        before[self.starts] = start
        width = len(self.word_ids)
        codes, first, self.next = np.unique(before * width + self.at, return_index=True, return_inverse=True)
        self.context, self.word = codes // width, codes % width
        self.lower = self.gram_probs[self.gram[first]]
        self.context_ids = np.append(self.gram_ids, np.uint64(0))
        self.context_counts = np.append(self.gram_counts, self.params[0]["texts"])
        self.asked = (self.context_counts[self.context] > 0) & (self.word_counts[self.word] > 0)

    def _shares(self, counts: np.ndarray) -> np.ndarray:
        """Over how many buckets a context is spread, by its count."""
        n = max(1, self.params[0]["tokens"])
        return np.clip(-(-counts * 4 * self.buckets // n), 1, self.buckets).astype(np.int64)

    def _bucket(self, context_ids: np.ndarray, share: np.ndarray) -> np.ndarray:
        return (mix(context_ids * _ODD + share.astype(np.uint64)) % np.uint64(self.buckets)).astype(np.int64)

    def _dealt(self):
        """Asked n-grams in order of bucket, context id and word id, with their buckets; and the
        (bucket, context) pairs asked about, in that order."""
        asked = np.flatnonzero(self.asked)
        context, word = self.context[asked], self.word[asked]
        shares = self._shares(self.context_counts[context])
        share = (mix(self.word_ids[word]) % shares.astype(np.uint64)).astype(np.int64)
        bucket = self._bucket(self.context_ids[context], share)
        order = np.lexsort((self.word_ids[word], self.context_ids[context], bucket))
        known = np.unique(context)
        many = self._shares(self.context_counts[known])
        all_contexts = np.repeat(known, many)
        share = np.arange(len(all_contexts)) - np.repeat(np.cumsum(many) - many, many)
        pairs = np.stack([self._bucket(self.context_ids[all_contexts], share), all_contexts], 1)
        pairs = np.unique(pairs, axis=0)
        pairs = pairs[np.lexsort((self.context_ids[pairs[:, 1]], pairs[:, 0]))]
        return asked[order], bucket[order], pairs

    def messages(self, level: int) -> list[tuple]:
        self._grams()
        grams, bucket, pairs = self._dealt()
        counts = np.bincount(self.next[np.repeat(~self.held, self.lengths)], minlength=len(self.context))
        cuts = np.searchsorted(bucket, np.arange(self.buckets + 1))
        heads = np.searchsorted(pairs[:, 0], np.arange(self.buckets + 1))
        out = []
        for b in range(self.buckets):
            own, g = pairs[heads[b]:heads[b + 1], 1], grams[cuts[b]:cuts[b + 1]]
            if not len(own):
                continue
            ids = self.context_ids[own]
            runs = np.bincount(np.searchsorted(ids, self.context_ids[self.context[g]]), minlength=len(ids))
            values, places = _table_of(self.lower[g])
            out.append((self.name, level, b, _pack(ids), _pack(runs), _pack(self.word_ids[self.word[g]]),
                        _pack(counts[g]), len(values).to_bytes(4, "little") + values + places))
        return out

    def _take(self, answers: pd.DataFrame, p: dict):
        grams, bucket, pairs = self._dealt()
        n = len(self.context_ids)
        ids, counts = np.zeros(len(self.context), np.uint64), np.zeros(len(self.context), np.int64)
        sums, mass = np.zeros((MAX_DISCOUNTED + 2, n), np.int64), np.zeros(n)
        cuts = np.searchsorted(bucket, np.arange(self.buckets + 1))
        heads = np.searchsorted(pairs[:, 0], np.arange(self.buckets + 1))
        by = {int(r.bucket): r for r in answers.itertuples()}
        for b in range(self.buckets):
            own = pairs[heads[b]:heads[b + 1], 1]
            if not len(own):
                continue
            g, r = grams[cuts[b]:cuts[b + 1]], by[b]
            if not np.array_equal(_unpack(r.c).astype(np.uint64), self.context_ids[own]):
                raise RuntimeError("a chunk's answers are not those it asked for")
            ids[g], counts[g] = _unpack(r.a), _unpack(r.b)
            sums[:, own] += _unpack(r.d).astype(np.int64).reshape(MAX_DISCOUNTED + 2, -1)
            mass[own] += _unpack(r.e, True)
        used = sums[-1].astype(float)
        for j in range(1, MAX_DISCOUNTED + 1):
            used += p["discounts"][j] * j * sums[j]
        whole, weight = weights(sums[0].astype(float), used, mass)
        seen = counts > 0
        probs = np.where(seen, _discounted(p["discounts"], counts) / np.maximum(whole[self.context], 1e-300),
                         weight[self.context] * self.lower)
        self.gram, self.gram_ids, self.gram_counts, self.gram_probs = self.next, ids, counts, probs

    def scores(self) -> pd.DataFrame:
        p = self.params[0]
        c = self.word_counts[self.at]
        base = np.log10((c + 0.5) / (p["tokens"] + 0.5 * (p["words"] + 1)))
        per = lambda x: np.add.reduceat(x, self.starts)
        return pd.DataFrame({
            "doc_id": pd.Series(self.ids, dtype="Int64").mask(self.none), "held_out": self.held, "n_tokens": self.lengths,
            "n_known": per((c > 0).astype(np.int64)), "train_tokens": p["tokens"], "base_score": per(base),
            "score": per(np.log10(self.gram_probs)[self.gram])})


def weights(tokens: np.ndarray, used: np.ndarray, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(denominator, backoff weight) of contexts by their tokens, discounted tokens and the
    lower-order mass of the words seen after them.

    The weight hands the mass left to the words not seen, so that all sum to one.  Where
    discounting leaves nothing, the denominator grows by one; where every word was seen, the
    seen share the whole mass.  A context that was not seen has weight one.
    """
    seen = tokens > 0
    whole = np.where(used > tokens * (1 - 1e-9), used + 1, tokens)
    rest = 1 - mass
    full = seen & (rest < 1e-12)
    whole = np.where(full, used, whole)
    left = 1 - used / np.maximum(whole, 1e-300)
    weight = np.where(seen, np.where(full, 0.0, left / np.where(full, 1.0, rest)), 1.0)
    return whole, weight


def _stored(rows: DataFrame, name: str) -> DataFrame:
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, name)
    rows.write.partitionBy("kind").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _stats(stored: DataFrame) -> list[int]:
    """Sums over the buckets: tokens, distinct n-grams, counts of counts."""
    found = stored.where(F.col("kind") == "model").select(F.posexplode("stats")).groupBy("pos").agg(F.sum("col").alias("n"))
    return [r["n"] for r in found.orderBy("pos").collect()] or [0] * (MAX_DISCOUNTED + 3)


def _ask(params: list[dict], buckets: int, level: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_Chunk(rows, params, buckets).messages(level), columns=_ANSWER_NAMES[:8])

    return run


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", held_out: str = "held_out", order: int = ORDER,
          chunk: int = CHUNK, bucket: int = BUCKET) -> DataFrame:
    """Scores of all rows under the model of those that are not held out (null counts as not).
    There is a bucket for every ``bucket`` bytes of text, and one per shuffle partition at least."""
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("long"), F.col(held_out), F.col(text))
    trained = ~F.coalesce(F.col(held_out), F.lit(False))
    texts, size = docs.agg(F.count_if(trained), F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()
    buckets = max(partitions(spark), -(-size // bucket))
    first = _stored(map_groups(_first_messages(docs, buckets, chunk), ["bucket"], _answer_first(buckets), _ANSWER),
                    "katz-1")
    tokens, words, *n = _stats(first)
    d = discounts(n)
    used = sum(d[j] * j * n[j - 1] for j in range(1, MAX_DISCOUNTED + 1)) + (
        tokens - sum(j * n[j - 1] for j in range(1, MAX_DISCOUNTED + 1)))
    whole = tokens if used < tokens * (1 - 1e-9) else used + 1
    params = [{"discounts": d, "whole": whole, "unknown": 1 - used / whole, "tokens": tokens, "words": words, "texts": texts}]
    answers = first.where(F.col("kind") == "answer").drop("kind", "stats")
    for level in range(2, order + 1):
        met = _contents(docs, buckets, chunk).unionByName(answers)
        asked = map_groups(met, ["chunk"], _ask(list(params), buckets, level), _ROW)
        stored = _stored(map_groups(asked, ["bucket"], _answer(level, buckets), _ANSWER), f"katz-{level}")
        _, _, *n = _stats(stored)
        params.append({"discounts": discounts(n)})
        answers = answers.unionByName(stored.where(F.col("kind") == "answer").drop("kind", "stats"))
    met = _contents(docs, buckets, chunk).unionByName(answers)
    return map_groups(met, ["chunk"], lambda rows: _Chunk(rows, params, buckets).scores(),
                      "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                      "base_score double, score double")


def op2_katz(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 1
    return score(docs.withColumn("held_out", held))
