"""Token ids in binary files with a shared compression dictionary (operator 12).

A folder holds ``tokens/part-N*`` files, in ascending order of document id, and ``dictionary/``
with one zstandard dictionary, trained on serialized id arrays.  Each document is compressed
on its own with it, so a short document still compresses well and can be read alone.

A token file is a header, a frame a document, an index and a trailer; each is followed by one
byte (the line end of Spark's text writer, which writes the files).  All integers are little-endian:

* header: ``MAGIC``, bytes an id takes (u4), SHA-256 of the dictionary (32 bytes);
* frame: zstandard frame of the document's ids, ``bytes an id takes`` each;
* index: a zstandard frame of ``INDEX`` records (id, whether there is one, place and size of
  the frame, number of ids, number of ids before it in this file);
* trailer: place and size of the index, number of documents, number of ids (u8 each), ``MAGIC``.

Scale: texts are encoded and compressed where they are read, a thousand rows at a time, and only
the frames shuffle: once, by ranges of the id (and of a hash, so that rows which share an id are
spread); a range is one file of about ``FILE_BYTES`` of text.  The dictionary is trained on the
driver on at most ``SAMPLE_ROWS`` documents of at most ``SAMPLE_IDS`` ids each (those of least
hash), the only thing that is sampled; hashes above a bound are left out before rows move, so
the task that takes the least gets about twice as many, however large the table (rows equal in
id and text share a hash, so there may be fewer or more).  Readers hold one file at a time.  A
task that is lost writes its file again; Spark's commit shows whole files only.

Defined cases: a null text is empty, so the end id alone; rows without an id come first; rows
that share an id stand in the order of their texts' hashes; texts of any length are encoded
whole, and strings of special tokens in a text are ordinary text; an empty table gives an
empty dictionary and no documents; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.bpe import Codec
from footfall.llm.common import map_batches, scratch_path, small_batches, table, written
from footfall.sources import fs

END_ID = 2
FILE_BYTES = 32 << 20  # of text
SAMPLE_ROWS = 1024
SAMPLE_IDS = 2048
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
MAGIC = b"ids1"
INDEX = np.dtype([("id", "<i8"), ("named", "<u1"), ("at", "<u8"), ("size", "<u8"), ("n", "<u8"), ("before", "<u8")])
_HEADER, _HEADER_SIZE = "<4sI32s", 40
_TRAILER, _TRAILER_SIZE = "<QQQQ4s", 36

SLICE_ROWS = 512  # rows encoded at a time

_codecs: dict[int, Codec] = {}


def byte_signs() -> dict[int, str]:
    """The characters that byte-level vocabularies use for the 256 bytes: printable Latin-1 characters
    stand for themselves, the other bytes for the characters from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)}


def library_codec(content: str) -> Codec:
    """Encoder of a ``tokenizers`` file, one per worker: the library's model encodes each piece of the
    pattern that is not cached."""
    from tokenizers import Tokenizer

    key = hash(content)
    if key not in _codecs:
        _codecs.clear()
        model, signs = Tokenizer.from_str(content).model, byte_signs()
        _codecs[key] = Codec({}, lambda piece: [t.id for t in model.tokenize(piece.encode().decode("latin-1").translate(signs))])
    return _codecs[key]


def _width(content: str) -> int:
    """Bytes an id takes: two if every id of the vocabulary fits."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_str(content).get_vocab_size() <= 1 << 16 else 4


def _serial(ids: bytes, width: int) -> bytes:
    """Little-endian 32-bit ids in ``width`` bytes each."""
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def train(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary of the samples; a few samples, too few to train on, are one themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _shared(dictionary: bytes, level: int | None = None) -> zstandard.ZstdCompressionDict | None:
    """The dictionary, made ready once for a level."""
    if len(dictionary) < 8:
        return None
    shared = zstandard.ZstdCompressionDict(dictionary)
    if level is not None:
        shared.precompute_compress(level=level)
    return shared


def candidates(d: DataFrame, rows: int) -> DataFrame:
    """``d`` (``id``, ``text``) with ``chance``, a hash of both; of a large table of ``rows`` rows only
    those of the least hashes, about twice ``SAMPLE_ROWS``."""
    found = d.withColumn("chance", F.xxhash64(F.lit(7), "id", "text"))
    return found if rows <= 2 * SAMPLE_ROWS else found.where(F.col("chance") < (2 * SAMPLE_ROWS << 64) // rows - (1 << 63))


def _as_files(rows: DataFrame, path: str) -> None:
    """The binary column ``row`` of each partition as a file, one byte after each."""
    rows.select(F.col("row").cast("string")).write.text(path, lineSep="\n")


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, key: str = "doc_id", text: str = "text",
                 end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> None:
    """Writes the ids of every text, with ``end_id`` after each, under the new folder ``path``."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        content = f.read()
    width, end = _width(content), struct.pack("<I", end_id)
    d = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows, size = d.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()

    def ids_of(batches):
        codec = library_codec(content)
        for b in batches:
            found = codec.encode(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([_serial((i + end)[:4 * SAMPLE_IDS], width) for i in found], pa.binary())], ["ids"])

    some = written(candidates(d, rows).orderBy("chance", "id").limit(SAMPLE_ROWS).select("text"), "token-sample")
    dictionary = train([r.ids for r in map_batches(some, ids_of, "ids binary").collect()])
    mark = hashlib.sha256(dictionary).digest()
    _as_files(spark.createDataFrame([(dictionary,)], "row binary").coalesce(1), f"{path}/dictionary")

    def pack(batches):
        codec, packer = library_codec(content), zstandard.ZstdCompressor(level=LEVEL, dict_data=_shared(dictionary, LEVEL))
        for b in (b.slice(low, SLICE_ROWS) for b in batches for low in range(0, b.num_rows, SLICE_ROWS)):
            found = [ids + end for ids in codec.encode(b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(ids) // 4 for ids in found], pa.int64()),
                 pa.array([packer.compress(_serial(ids, width)) for ids in found], pa.binary())], ["id", "salt", "n", "frame"])

    def run(batches):
        header = struct.pack(_HEADER, MAGIC, width, mark)
        at, total, index = len(header) + 1, 0, [np.empty(0, INDEX)]
        yield pa.RecordBatch.from_arrays([pa.array([header], pa.binary())], ["row"])
        for b in batches:
            frames, n = b.column(2), b.column(1).to_numpy()
            part, steps = np.empty(b.num_rows, INDEX), pc.binary_length(frames).to_numpy().astype(np.int64) + 1
            part["id"], part["named"] = pc.fill_null(b.column(0), 0), pc.is_valid(b.column(0))
            part["at"], part["size"] = at + np.cumsum(steps) - steps, steps - 1
            part["n"], part["before"] = n, total + np.cumsum(n) - n
            index.append(part)
            at, total = at + int(steps.sum()), total + int(n.sum())
            yield pa.RecordBatch.from_arrays([frames], ["row"])
        index = np.concatenate(index)
        listed = zstandard.ZstdCompressor(level=LEVEL).compress(index.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array([listed, struct.pack(_TRAILER, at, len(listed), len(index), total, MAGIC)], pa.binary())], ["row"])

    with small_batches(spark):
        framed = written(map_batches(d.select("id", F.xxhash64("text").alias("salt"), "text"), pack,
                                     "id long, salt long, n long, frame binary"), "token-frames")
        dealt = framed.repartitionByRange(max(1, -(-size // file_bytes)), "id", "salt").sortWithinPartitions("id", "salt")
        _as_files(map_batches(dealt.select("id", "n", "frame"), run, "row binary"), f"{path}/tokens")


def read_dictionary(spark: SparkSession, path: str) -> bytes:
    """The dictionary of a folder of token files."""
    found = spark.read.format("binaryFile").load(f"{path}/dictionary").where("length > 0").select("content").first()
    return bytes(found.content)[:-1]


def read_index(tail, size: int) -> tuple[np.ndarray, int]:
    """The index of a token file of ``size`` bytes and its number of ids; ``tail(at, n)`` reads."""
    at, length, _, total, magic = struct.unpack(_TRAILER, tail(size - 1 - _TRAILER_SIZE, _TRAILER_SIZE))
    if magic != MAGIC:
        raise ValueError("not a token file")
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(tail(at, length)), INDEX), total


def _width_of(header: bytes, dictionary: bytes) -> int:
    magic, width, mark = struct.unpack(_HEADER, header)
    if magic != MAGIC or mark != hashlib.sha256(dictionary).digest():
        raise ValueError("the file was written with another dictionary")
    return width


def _ids(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{width}").astype("<u4")


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """The documents of the files: ``file`` (its number), ``doc_id``, ``before`` (ids before it in the
    file), ``n_tokens``, ``ids_crc32``, and with ``with_ids`` the ``ids``."""
    dictionary = read_dictionary(spark, path)
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("file", "doc_id", "before", "n_tokens", "ids_crc32")])
    if with_ids:
        schema.add("ids", T.ArrayType(T.IntegerType(), False))

    def run(batches):
        reader = zstandard.ZstdDecompressor(dict_data=_shared(dictionary))
        for b in batches:
            for number, cell in zip(b.column(0).to_pylist(), b.column(1)):
                data = memoryview(cell.as_buffer())
                index, _ = read_index(lambda at, n: data[at:at + n], len(data))
                width = _width_of(data[:_HEADER_SIZE], dictionary)
                for low in range(0, len(index), SLICE_ROWS):
                    part = index[low:low + SLICE_ROWS]
                    arrays = [_ids(reader.decompress(data[a:a + s]), width) for a, s in zip(part["at"].tolist(), part["size"].tolist())]
                    cols = [pa.array([number] * len(part), pa.int64()),
                            pa.array(part["id"].astype(np.int64), mask=part["named"] == 0), pa.array(part["before"].astype(np.int64)),
                            pa.array([len(a) for a in arrays], pa.int64()), pa.array([zlib.crc32(a) for a in arrays], pa.int64())]
                    if with_ids:
                        cols.append(pa.array([a.astype(np.int32) for a in arrays], pa.list_(pa.int32())))
                    yield pa.RecordBatch.from_arrays(cols, schema.names)

    files = spark.read.format("binaryFile").load(f"{path}/tokens").where("length > 0")
    number = F.regexp_extract(F.element_at(F.split("path", "/"), -1), r"part-(\d+)", 1).cast("long")
    return map_batches(files.select(number.alias("file"), "content"), run, schema)


def with_starts(found: DataFrame, block: int = 1024) -> DataFrame:
    """``found`` (of ``read_tokens``, written) with ``start``: the ids of all documents before.

    The sums run over files, ``block`` of them at a time, and over the blocks.
    """
    files = found.groupBy("file").agg(F.max(F.col("before") + F.col("n_tokens")).alias("n")).withColumn(
        "block", F.floor(F.col("file") / block))
    blocks = files.groupBy("block").agg(F.sum("n").alias("n"))
    earlier = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select("block", earlier(Window.orderBy("block")).alias("first"))
    files = files.select("file", "block", earlier(Window.partitionBy("block").orderBy("file")).alias("inner"))
    bases = files.join(blocks, "block").select("file", (F.col("first") + F.col("inner")).alias("base"))
    return found.join(bases, "file").withColumn("start", F.col("base") + F.col("before")).drop("base")


def fetch(spark: SparkSession, path: str, doc_ids: list[int]) -> dict[int, list[np.ndarray]]:
    """Ids of a few documents, read from their places in the files: of each file the trailer and
    the index, and no frame but theirs.  For a handful of ids; ``read_tokens`` reads them all."""
    dictionary, wanted, out = read_dictionary(spark, path), np.array(sorted(set(doc_ids)), np.int64), {}
    reader = zstandard.ZstdDecompressor(dict_data=_shared(dictionary))
    for file, size in fs.list_files(spark, f"{path}/tokens"):
        if not file.rsplit("/", 1)[-1].startswith("part-") or not size:
            continue
        with fs.opened(spark, file) as tail:
            index, _ = read_index(tail, size)
            hits = index[(index["named"] == 1) & np.isin(index["id"], wanted)]
            if len(hits):
                width = _width_of(tail(0, _HEADER_SIZE), dictionary)
            for r in hits:
                out.setdefault(int(r["id"]), []).append(_ids(reader.decompress(tail(int(r["at"]), int(r["size"]))), width))
    return out


def op12_token_files(spark, sf_dir):
    import public_tokenizers

    path = scratch_path(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    with small_batches(spark, 1):
        found = written(read_tokens(spark, path, with_ids=False), "token-index")
    return with_starts(found).select("doc_id", "start", "n_tokens", "ids_crc32")
