"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation (operator 10).

Texts are classified code point by code point through a table; the pieces of the splitting
pattern are found by a finite automaton whose transition functions are composed by an
associative scan over blocks, without any regex.  Pieces feed a cache of merged pairs; ids
and, if asked for, the byte offsets of the tokens come out, and ``decode`` reverses them.

Each task works on one batch of texts at a time (``BATCH_CHARS`` code points, or one longer
text) and keeps at most ``CACHE_PIECES`` pieces.  The rank file is read on the driver once
and travels in the task closure (its size is that of the vocabulary).  No shuffle.

Defined cases: a null text counts as empty and gives no tokens; texts are encoded whole,
whatever their length; repeated rows are encoded alike; input columns pass through.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import map_batches, table

BATCH_CHARS = 2_000_000
CACHE_PIECES = 400_000
BLOCK = 512

#: Code points with the White_Space property.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
               0x202F, 0x205F, 0x3000]
#: What may follow an apostrophe as a piece of its own.
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]

# Symbols of the automaton.  "Last": white space followed by something else than white space.
LETTER, NUMBER, OTHER, GAP, LAST_GAP, LAST_SPACE, SHORT1, SHORT2, BREAK = range(9)
# States: what the last code point left open.
SHUT, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_GAP, SPACE, ONE_MORE, TWO_MORE = range(8)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, whether a piece starts) by symbol and state."""
    to, starts = np.zeros((9, 8), np.uint8), np.ones((9, 8), bool)
    runs = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, SHORT1: IN_OTHERS, SHORT2: IN_OTHERS}
    for symbol, run in runs.items():
        to[symbol] = run
        starts[symbol, [run, SPACE]] = False
    for symbol, left in ((SHORT1, ONE_MORE), (SHORT2, TWO_MORE)):
        to[symbol] = np.where(starts[symbol], left, IN_OTHERS)
    for state, then in ((ONE_MORE, SHUT), (TWO_MORE, ONE_MORE)):
        to[LETTER, state], starts[LETTER, state] = then, False
    to[GAP], starts[GAP, IN_GAP] = IN_GAP, False
    to[LAST_GAP], to[LAST_SPACE], to[BREAK] = SHUT, SPACE, SHUT
    return to, starts


NEXT, STARTS = _automaton()


@lru_cache(1)
def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)),
                      np.uint8, sys.maxunicode + 1)
    out[WHITE_SPACE] = GAP
    return out


def _states_before(symbols: np.ndarray) -> np.ndarray:
    """The automaton's state before each symbol, by an associative scan.

    Blocks of symbols are composed into transition functions side by side; a doubling scan
    composes the functions of all blocks before each; then the blocks run from their states.
    """
    n = len(symbols)
    rows = -(-n // BLOCK)
    grid = np.full(rows * BLOCK, BREAK, np.uint8)
    grid[:n] = symbols
    steps = np.ascontiguousarray(grid.reshape(rows, BLOCK).T)
    flat = NEXT.reshape(-1)
    whole = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for column in steps:
        whole = flat[(column.astype(np.intp) * 8)[:, None] + whole]
    reach = 1
    while reach < rows:
        whole[reach:] = np.take_along_axis(whole[reach:], whole[:-reach].astype(np.intp), 1)
        reach *= 2
    state = np.empty(rows, np.uint8)
    state[0], state[1:] = SHUT, whole[:-1, SHUT]
    before = np.empty((BLOCK, rows), np.uint8)
    for k, column in enumerate(steps):
        before[k] = state
        state = flat[column.astype(np.intp) * 8 + state]
    return before.T.reshape(-1)[:n]


def split_points(codes: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Positions where pieces start; ``breaks``: positions of separators between texts."""
    symbols = _classes()[codes]
    symbols[breaks] = BREAK
    gap = symbols == GAP
    last = gap[:-1] & ~gap[1:] & (symbols[1:] != BREAK)
    at = np.flatnonzero(last)
    symbols[at] = np.where(codes[at] == 0x20, LAST_SPACE, LAST_GAP)
    quotes = np.flatnonzero(codes[:-1] == ord("'"))
    after = codes[quotes + 1]
    second = codes[np.minimum(quotes + 2, len(codes) - 1)]
    for c in CONTRACTIONS:
        hit = after == ord(c[0])
        if len(c) == 2:
            hit &= (second == ord(c[1])) & (quotes + 2 < len(codes))
        symbols[quotes[hit]] = SHORT1 if len(c) == 1 else SHORT2
    return np.flatnonzero(STARTS[symbols, _states_before(symbols)])


def read_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: the adjacent pair of least rank is joined, the leftmost first, until
    none is known.  A heap over linked parts keeps long pieces at n log n."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i:i + 1] for i in range(len(piece))]
    if len(parts) < 40:
        pairs = [ranks.get(a + b, sys.maxsize) for a, b in zip(parts, parts[1:])]
        while pairs and (least := min(pairs)) != sys.maxsize:
            i = pairs.index(least)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], sys.maxsize)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], sys.maxsize)
        return [ranks[p] for p in parts]
    n = len(parts)
    after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
    heap = [(r, i, p) for i in range(n - 1) if (r := ranks.get(p := parts[i] + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, joined = heapq.heappop(heap)
        j = after[i] if parts[i] else n
        if j >= n or parts[i] + parts[j] != joined:
            continue
        parts[i], parts[j] = joined, b""
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for a in (before[i], i):
            if a >= 0 and after[a] < n and (r := ranks.get(p := parts[a] + parts[after[a]])) is not None:
                heapq.heappush(heap, (r, a, p))
    return [ranks[p] for p in parts if p]


class Codec:
    """Encoder and decoder of one rank table, with a bounded cache of merged pieces.

    The cache has two generations: when the young one is full it becomes the old one, from
    which pieces that occur again move back.  ``merger`` may replace ``merge``.
    """

    def __init__(self, ranks: dict[bytes, int], merger=None):
        self.merger = merger or (lambda piece: merge(piece.encode(), ranks))
        self.tokens = {i: t for t, i in ranks.items()}
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        if len(self.cache) >= CACHE_PIECES:
            self.old, last = self.cache, self.old
            last.clear()
            self.cache = last  # _encode looks the cache up once per text
        ids = self.old.get(piece) or np.array(self.merger(piece), "<u4").tobytes()
        self.cache[piece] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out, batch, size = [], [], 0
        for text in texts:
            if batch and size + len(text) > BATCH_CHARS:
                out += self._encode(batch)
                batch, size = [], 0
            batch.append(text)
            size += len(text) + 1
        return out + self._encode(batch) if batch else out

    def _encode(self, texts: list[str]) -> list[bytes]:
        whole = "\0".join(texts)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        if not whole:
            return [b""] * len(texts)
        codes = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        starts = split_points(codes, ends[:-1])
        cuts = np.searchsorted(starts, ends).tolist()
        at = [*starts.tolist(), len(whole)]
        out, low = [], 0
        for end, high in zip(ends.tolist(), cuts):
            if low < high:
                get = self.cache.get
                bounds = at[low:high] + [end]
                pieces = [whole[a:b] for a, b in zip(bounds, bounds[1:])]
                out.append(b"".join([get(p) or self._piece(p) for p in pieces]))
            else:
                out.append(b"")
            low = high + 1  # the separator is a piece of its own
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def offsets(self, ids: bytes) -> list[int]:
        """Byte offset of each token in the UTF-8 text."""
        sizes = [len(self.tokens[i]) for i in np.frombuffer(ids, "<u4").tolist()]
        return (np.cumsum([0, *sizes])[:-1]).tolist()


_codecs: dict[tuple, Codec] = {}


def _library(ranks: dict[bytes, int]):
    """The tokenizer library's merging of a single piece (the pattern takes all of it)."""
    import tiktoken

    return tiktoken.Encoding("pieces", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def codec(content: bytes, library: bool = False) -> Codec:
    """The codec of a rank file's content, one per worker; ``library`` lets the tokenizer
    library merge the pieces that are not cached."""
    key = hash(content), library
    if key not in _codecs:
        _codecs.clear()
        ranks = read_ranks(content)
        _codecs[key] = Codec(ranks, _library(ranks) if library else None)
    return _codecs[key]


def _rank_file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(df, ranks_path: str, text: str = "text", with_offsets: bool = False):
    """``df`` with ``ids`` (array<int>) and, if asked for, ``offsets`` (array<int>) of ``text``."""
    content = _rank_file(ranks_path)
    extra = [T.StructField("ids", T.ArrayType(T.IntegerType(), False))]
    if with_offsets:
        extra.append(T.StructField("offsets", T.ArrayType(T.IntegerType(), False)))
    held = [f for f in df.schema.fields if f.name not in ("ids", "offsets")]

    def run(batches):
        c = codec(content)
        for b in batches:
            ids = c.encode([t or "" for t in b.column(text).to_pylist()])
            cols = [b.column(f.name) for f in held]
            cols.append(pa.array([np.frombuffer(i, "<i4") for i in ids], pa.list_(pa.int32())))
            if with_offsets:
                cols.append(pa.array([c.offsets(i) for i in ids], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, [f.name for f in held] + [f.name for f in extra])

    return map_batches(df, run, T.StructType(held + extra))


def decode(df, ranks_path: str, ids: str = "ids"):
    """``df`` with ``decoded`` (binary): the bytes of the token ids."""
    content = _rank_file(ranks_path)
    held = [f for f in df.schema.fields if f.name != "decoded"]

    def run(batches):
        c = codec(content)
        for b in batches:
            out = [c.decode(np.array(i or [], "<u4").tobytes()) for i in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in held], pa.array(out, pa.binary())],
                                             [*[f.name for f in held], "decoded"])

    return map_batches(df, run, T.StructType([*held, T.StructField("decoded", T.BinaryType())]))


def digests(df, ranks_path: str, text: str = "text", key: str = "doc_id"):
    """Per row: the key, the number of tokens, and digests of the ids and of the decoded bytes.

    The round trip of ``encode`` and ``decode`` in one pass over the texts.
    """
    content = _rank_file(ranks_path)
    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType())])

    def run(batches):
        c = codec(content)
        for b in batches:
            ids = c.encode([t or "" for t in b.column(text).to_pylist()])
            yield pa.RecordBatch.from_arrays([
                b.column(key), pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                pa.array([hashlib.sha256(c.decode(i)).hexdigest() for i in ids], pa.string()),
            ], schema.names)

    return map_batches(df.select(key, F.col(text).alias(text)), run, schema)


def op10_byte_bpe(spark, sf_dir):
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
