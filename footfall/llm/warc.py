"""WARC archives and transaction assembly (operator 4).

``write_archive`` turns captures into request, response (or revisit) and metadata records;
Spark's text writer puts them into gzip files, its line separator being the end of a record.
``read_archive`` reads any WARC 1.x text back: the reader cuts files at blank lines and a
streaming parser in the task puts the bytes together again by Content-Length, so payloads
may hold anything.  ``assemble`` joins records through their concurrent-to identifiers, in
either direction and across one record in between, into one nested row per capture.

Files are gzip, so one task reads a file from front to end and holds one record at a time.
Payloads travel once when written (to meet the list of equal payloads); digests and sizes are
taken while reading, so assembly shuffles headers only unless payloads are asked for.  The
join on a payload's digest may be skewed (a third of all pages equal); it is a plain outer
join, which adaptive execution splits.

Defined cases: a null payload is empty; a null url writes no target, read back as null; line
breaks in a url are percent-encoded; a null page id comes back null; rows that tie for the
smallest page id of a payload are all responses, and repeated rows give one capture each;
records that name no known capture come out as captures without a response; an empty table
writes no record and reads back no row.  Other input columns are not written.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import map_batches, scratch_path, table, written

LEAST_REVISIT = 100
#: End of a header block, which is also the end of a record.
END = "\r\n\r\n"
ANCHORS = ["response", "revisit", "resource"]

RECORD = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("target_uri", T.StringType()), T.StructField("date", T.StringType()),
    T.StructField("concurrent_to", T.ArrayType(T.StringType())), T.StructField("refers_to", T.StringType()),
    T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("http_headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("payload", T.BinaryType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("malformed", T.BooleanType()),
])


def _record_id(kind: str, page: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), F.coalesce(page.cast("string"), F.lit("none")), digest))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)),
                    F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _record(kind: str, record_id: Column, uri: Column, content_type: str, block: Column, *lines: Column) -> Column:
    return F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\n"), _line("WARC-Record-ID", record_id),
        _line("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _line("WARC-Target-URI", uri), *lines, F.lit(f"Content-Type: {content_type}\r\n"),
        _line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)


def write_archive(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
                  least: int = LEAST_REVISIT) -> None:
    """Writes three records per row under ``path``; equal payloads of ``least`` bytes or more
    are stored once, with the smallest key, and revisited by the others."""
    p = pages.select(F.col(key).alias("k"), F.col(url).alias("u"), F.coalesce(payload, F.lit("")).alias("t"))
    p = p.withColumns({"digest": F.sha2(F.col("t"), 256), "n": F.octet_length("t")})
    first = (p.where(F.col("n") >= least).groupBy("digest").agg(F.count("*").alias("copies"), F.min("k").alias("first"))
             .where(F.col("copies") > 1).select("digest", "first"))
    p = p.join(first, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("k").eqNullSafe(F.col("first"))
    uri = F.replace(F.replace("u", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    capture = F.when(again, _record_id("revisit", F.col("k"), F.col("digest"))).otherwise(
        _record_id("response", F.col("k"), F.col("digest")))
    p = p.select("k", "digest", "first", "t", again.alias("again"), uri.alias("uri"), capture.alias("id"),
                 F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                          F.col("n").cast("string"), F.lit(END)).alias("http"))
    digest = _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))
    page = F.concat(F.lit("page-id: "), F.coalesce(F.col("k").cast("string"), F.lit("")), F.lit("\r\n"))
    to = _line("WARC-Concurrent-To", F.col("id"))
    http = "application/http; msgtype=response"
    records = F.array(
        _record("request", _record_id("request", F.col("k"), F.col("digest")), F.col("uri"),
                "application/http; msgtype=request",
                F.concat(F.lit("GET "), F.coalesce("uri", F.lit("/")), F.lit(" HTTP/1.1" + END)), to),
        F.when(F.col("again"), _record(
            "revisit", F.col("id"), F.col("uri"), http, F.col("http"), digest,
            _line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            _line("WARC-Refers-To", _record_id("response", F.col("first"), F.col("digest"))))).otherwise(
            _record("response", F.col("id"), F.col("uri"), http, F.concat("http", "t"), digest)),
        _record("metadata", _record_id("metadata", F.col("k"), F.col("digest")), F.col("uri"),
                "application/warc-fields", page, to))
    p.select(F.explode(records)).write.option("lineSep", END).option("compression", "gzip").text(path)


def _fields(block: bytes) -> dict[str, str]:
    """Header lines by lower-case name; repeated names are joined by a line break."""
    out: dict[str, str] = {}
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            name, value = name.strip().lower(), value.strip()
            out[name] = f"{out[name]}\n{value}" if name in out else value
    return out


class Archive:
    """Streaming parser: bytes go in, records come out."""

    def __init__(self):
        self.buffer = bytearray()

    def feed(self, data: bytes):
        self.buffer += data
        while (record := self._next()) is not None:
            yield record

    def _next(self):
        buf = self.buffer
        start = 0
        while buf[start:start + 2] == b"\r\n":
            start += 2
        head = buf.find(b"\r\n\r\n", start)
        if head < 0:
            return None
        head_bytes = bytes(buf[start:head])
        fields = _fields(head_bytes)
        size = fields.get("content-length", "")
        if not head_bytes.startswith(b"WARC/") or not size.isdigit():
            del buf[:head + 4]
            return fields, head_bytes, True
        end = head + 4 + int(size)
        if len(buf) < end + 4:
            return None
        block = bytes(buf[head + 4:end])
        del buf[:end]
        return fields, block, False

    def rest(self):
        """What is left at the end of a file, as a malformed record."""
        left = bytes(self.buffer).strip(b"\r\n")
        self.buffer.clear()
        if left:
            yield {}, left, True


def _row(fields: dict[str, str], block: bytes, malformed: bool) -> tuple:
    kind = None if malformed else fields.get("warc-type")
    http, payload = {}, block
    if fields.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        http = _fields(head)
    size, digest = len(payload), None
    if kind == "revisit":
        size = int(http["content-length"]) if http.get("content-length", "").isdigit() else None
        digest = fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
        payload = None
    else:
        digest = hashlib.sha256(payload).hexdigest()
    to = fields.get("warc-concurrent-to")
    return (fields.get("warc-record-id"), kind, fields.get("warc-target-uri"), fields.get("warc-date"),
            to.split("\n") if to else [], fields.get("warc-refers-to"), [*fields.items()], [*http.items()],
            payload, size, digest, malformed)


def read_archive(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row of ``RECORD`` per record; ``with_payload=False`` keeps sizes and digests only,
    and the blocks of metadata records."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(RECORD)
    raw = spark.read.option("lineSep", END).option("pathGlobFilter", "*.gz").text(path).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"))
    # files that are not compressed would be cut anywhere: they are read whole
    whole = spark.read.format("binaryFile").option("pathGlobFilter", "*[!z]").load(path).where("length > 0")
    raw = raw.unionByName(whole.select(F.col("content").alias("value"), F.col("path").alias("file")))

    def run(batches):
        archive, name = Archive(), None

        def rows(b):
            nonlocal name
            for value, file in zip(b.column(0), b.column(1).to_pylist()):
                if file != name:
                    yield from archive.rest()
                    name = file
                yield from archive.feed(value.as_py() + END.encode())

        def batch(found):
            out = [_row(*r) for r in found]
            if not with_payload:
                out = [r if r[1] == "metadata" else (*r[:8], None, *r[9:]) for r in out]
            cols = [*zip(*out)] or [()] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, kinds)], kinds.names)

        for b in batches:
            yield batch(rows(b))
        yield batch(archive.rest())

    return map_batches(raw, run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id``, ``response``, ``request``, ``metadata`` (those of
    least id) and ``records``: all other records of the capture than its response, by id, of any type.
    Records that name no capture, directly or through one record in between, are one of their own.

    ``records`` is used more than once; pass a written table.
    """
    whole = F.struct(*records.columns)
    r = records.where(~F.col("malformed"))
    anchor = F.col("type").isin(ANCHORS)
    anchors = r.where(anchor).select(F.col("record_id").alias("capture_id"), whole.alias("response"))
    others = r.where(~anchor).select(F.col("record_id").alias("id"), F.col("type").alias("kind"), whole.alias("r"))
    named = r.select(F.col("record_id").alias("a"), anchor.alias("main"), F.explode("concurrent_to").alias("b"))
    mains = anchors.select(F.col("capture_id").alias("m")).distinct()
    # another record -> capture: it names the capture, or the capture names it
    near = named.where(~F.col("main")).join(mains, F.col("b") == F.col("m")).select(
        F.col("a").alias("id"), F.col("m").alias("capture"))
    near = near.unionByName(named.where("main").select(F.col("b").alias("id"), F.col("a").alias("capture")))
    near = near.groupBy("id").agg(F.min("capture").alias("capture"))
    # another record -> a record in between -> capture, for those that name no capture themselves
    step = named.where(~F.col("main")).join(mains, F.col("b") == F.col("m"), "left_anti")
    step = step.select("a", "b").unionByName(step.select(F.col("b").alias("a"), F.col("a").alias("b")))
    far = step.join(near.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(
        F.min("capture").alias("far"))
    linked = (others.join(near, "id", "left").join(far, "id", "left")
              .withColumn("capture_id", F.coalesce("capture", "far", "id")))
    side = linked.groupBy("capture_id").agg(
        F.min_by(F.when(F.col("kind") == "request", F.col("r")), F.when(F.col("kind") == "request", F.col("id"))).alias("request"),
        F.min_by(F.when(F.col("kind") == "metadata", F.col("r")), F.when(F.col("kind") == "metadata", F.col("id"))).alias("metadata"),
        F.transform(F.array_sort(F.collect_list(F.struct("id", "r")), lambda a, b: F.when(a["id"] < b["id"], -1).when(
            a["id"] > b["id"], 1).otherwise(0)), lambda x: x["r"]).alias("records"))
    return anchors.join(side, "capture_id", "full")


def op4_warc(spark, sf_dir):
    path = scratch_path(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path)
    records = written(read_archive(spark, path, with_payload=False), "warc-records")
    page = F.regexp_extract(F.decode(F.col("metadata")["payload"], "utf-8"), r"page-id: (-?\d+)", 1)
    c = assemble(records).select(
        "capture_id", F.col("response")["refers_to"].alias("to"), F.nullif(page, F.lit("")).cast("bigint").alias("page_id"),
        F.col("response")["payload_bytes"].alias("payload_bytes"),
        F.col("response")["payload_digest"].alias("payload_digest"), F.col("response")["type"].alias("record_type"))
    c = written(c, "warc-captures")
    known = c.where(F.col("record_type") == "response").groupBy(F.col("capture_id").alias("to")).agg(
        F.min("page_id").alias("refers_to"))
    return c.join(known, "to", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
