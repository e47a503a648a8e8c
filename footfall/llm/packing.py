"""Packing token pieces into sequences by first-fit decreasing (operator 6).

Documents are encoded and cut into pieces of at most ``capacity`` ids; pieces are dealt at
random into groups of about ``GROUP`` pieces, and each group is packed on its own: longest
piece first, into the first bin that holds it, found by descending a tournament tree over
the remaining capacities of the bins.  Only piece lengths travel, not texts or ids, and the
number of groups grows with the input, so a group stays small whatever the source or the
copies; a counter in the group hash also spreads rows that are equal in everything.

Defined cases: a null text counts as empty and is the end token alone; a document of any
length is cut, never dropped; repeated rows are packed one by one; an empty table gives no
pieces; columns other than the key and the text are not used.  A sequence shorter than the
capacity is padded by whoever writes it, unless its length is a power of two.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.bpe import codec
from footfall.llm.common import map_batches, map_groups, table, written

CAPACITY = 2048
END_ID = 1
GROUP = 8192


def pieces(docs: DataFrame, ranks_path: str, key: str = "doc_id", text: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of the documents' ids: key, start, length, ids_crc32, doc_tokens, salt (, ids).

    ``salt`` counts rows of a task; write the result before dealing pieces by it.
    """
    with open(ranks_path, "rb") as f:
        content = f.read()
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType)] + [
        T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "salt")])
    if with_ids:
        schema.add("ids", T.ArrayType(T.IntegerType(), False))
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * capacity

    def run(batches):
        c, salt = codec(content, library=True), 0
        for b in batches:
            rows = []
            for k, ids in zip(b.column(key).to_pylist(), c.encode([t or "" for t in b.column(text).to_pylist()])):
                ids += end
                for at in range(0, len(ids), step):
                    part = ids[at:at + step]
                    rows.append((k, at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4, salt) + (
                        (np.frombuffer(part, "<i4"),) if with_ids else ()))
                    salt += 1
            cols = [*zip(*rows)] or [()] * len(schema.names)
            kinds = [b.schema.field(key).type] + [pa.int64()] * 5 + [pa.list_(pa.int32())] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, kinds)], schema.names)

    return map_batches(docs.select(key, text), run, schema)


class FirstFit:
    """Bins under a tournament tree: each node holds the largest remaining capacity below it."""

    def __init__(self, n: int, capacity: int):
        self.width = 1 << max(0, (n - 1).bit_length())
        self.tree = [capacity] * (2 * self.width)

    def place(self, length: int) -> tuple[int, int]:
        """(bin, its remaining capacity before) of the first bin that holds ``length``."""
        node, tree = 1, self.tree
        while node < self.width:
            node *= 2
            if tree[node] < length:
                node += 1
        room = tree[node]
        tree[node] = room - length
        at = node // 2
        while at:
            best = max(tree[2 * at], tree[2 * at + 1])
            if tree[at] == best:
                break
            tree[at] = best
            at //= 2
        return node - self.width, room


def pack(df: DataFrame, capacity: int = CAPACITY, n_pieces: int | None = None, length: str = "length",
         deal: list[str] | None = None) -> DataFrame:
    """``df`` with ``sequence_id`` (group and bin) and ``offset``; lengths are 1 to ``capacity``.

    ``deal``: columns whose hash deals the rows into groups; give enough of them to tell rows apart.
    """
    deal = deal or [c for c in ("doc_id", "start", "salt") if c in df.columns]
    n = df.count() if n_pieces is None else n_pieces
    groups = max(1, -(-n // GROUP))
    held = [f for f in df.schema.fields if f.name not in ("sequence_id", "offset", "_group")]
    schema = T.StructType([*held, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def fill(key, rows: pd.DataFrame) -> pd.DataFrame:
        lengths = rows[length].to_numpy()
        tree, bins, offsets = FirstFit(len(rows), capacity), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for i in np.argsort(-lengths, kind="stable").tolist():
            bins[i], room = tree.place(int(lengths[i]))
            offsets[i] = capacity - room
        rows["sequence_id"], rows["offset"] = (int(key[0]) << 32) + bins, offsets
        return rows[schema.names]

    dealt = df.select(*[f.name for f in held], F.pmod(F.xxhash64(*deal), F.lit(groups)).alias("_group"))
    return map_groups(dealt, ["_group"], fill, schema)


def pack_documents(docs: DataFrame, ranks_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    cut = written(pieces(docs, ranks_path, key, text), "pieces")
    return pack(cut, deal=[key, "start", "salt"]).drop("salt")


def op6_packing(spark, sf_dir):
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
