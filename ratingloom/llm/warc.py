"""Web archives: pages written as records, whole-file gzip streams normalised to one gzip member per
record with a sidecar offset index, and records read back by offset.

Files are written by tasks through pyarrow's file systems (local, HDFS, object stores), below a folder
all executors share. Every attempt of a task writes files of its own name, and only those that a
finished task has reported are used, so a lost executor leaves at most files that nobody reads.
"""

from __future__ import annotations

import json
import re
import sys
import uuid
import zlib
from collections.abc import Iterator
from hashlib import sha256
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from ratingloom.llm.shared import join_counted, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_REVISIT = 100
# A new archive is begun beyond so many bytes of records, as a whole-file stream is one task's work.
ROLL = 64 << 20
CHUNK = 1 << 20
MAX_HEADER = 1 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FILES = "name string, records long, bytes long"
INDEX = ("archive string, offset long, length long, type string, record_id string, uri string, "
         "digest string, page string")
RECORDS = ("page_id long, url string, record_type string, payload binary, payload_bytes long, "
           "payload_digest string, refers_to long, archive string, offset long")


def with_roles(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload, payload_digest, refers_to (null for a response) for every page.

    Of equal payloads of at least ``min_bytes`` bytes the page with the smallest id is the response.
    A null id is larger than any other; if no equal page has an id, all are responses, as are rows
    that repeat the response's id. Null html is an empty payload.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"), payload.alias("payload"))
    digested = rows.withColumn("payload_digest", F.sha2("payload", 256))
    groups = written(digested.where(F.octet_length("payload") >= min_bytes)
                     .groupBy("payload_digest").agg(F.min("page_id").alias("first"),
                                                    F.count("*").alias("n")).where("n > 1"), "payloads")
    total = groups.agg(F.sum("n")).first()[0] or 0
    spread = F.concat_ws("/", "page_id", "url")
    return (join_counted(digested, groups, "payload_digest", "n", total, spread)
            .withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("_group.first")),
                                            F.col("_group.first"))).drop("_group"))


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """A response with its payload, or a revisit with the HTTP header only."""
    header = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
              b"Content-Length: %d\r\n\r\n" % len(payload))
    block = header if refers_to is not None else header + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"),
              ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", DATE),
              ("WARC-Payload-Digest", f"sha256:{digest}")]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url)))
    if page_id is not None:
        fields.append(("X-Page-ID", page_id))
    if refers_to is not None:
        fields += [("WARC-Refers-To", record_id(refers_to, digest)), ("WARC-Profile", PROFILE),
                   ("X-Refers-To-Page-ID", refers_to)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + head.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def write_archives(records: DataFrame, folder: str, roll: int = ROLL) -> DataFrame:
    """Writes the rows of ``with_roles`` as whole-file gzip streams; name, records, bytes per file."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = opened(folder)
        store.create_dir(root, recursive=True)
        name, out, gzip, count, size = "", None, None, 0, 0

        def finished() -> pd.DataFrame:
            out.write(gzip.flush())
            out.close()
            return pd.DataFrame({"name": [name], "records": [count], "bytes": [size]})

        for batch in batches:
            for row in batch.itertuples(index=False):
                if out is None:
                    name, count, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                    gzip = zlib.compressobj(wbits=31)
                data = record(None if pd.isna(row.page_id) else int(row.page_id), row.url, row.payload,
                              row.payload_digest,
                              None if pd.isna(row.refers_to) else int(row.refers_to))
                out.write(gzip.compress(data))
                count, size = count + 1, size + len(data)
                if size >= roll:
                    yield finished()
                    out = None
        if out is not None:
            yield finished()

    rows = records.select(F.col("page_id").cast("string").alias("page_id"), "url", "payload",
                          "payload_digest", F.col("refers_to").cast("string").alias("refers_to"))
    return written(rows.mapInPandas(write, FILES), "archives")


class Inflated:
    """A gzip stream of one or many members, inflated once, in pieces, from front to back."""

    def __init__(self, source):
        self.source, self.held, self.at = source, bytearray(), 0
        self.gzip, self.rest, self.ended = zlib.decompressobj(wbits=31), b"", False

    def more(self) -> bool:
        while not self.ended:
            data = self.gzip.unconsumed_tail or self.rest or self.source.read(CHUNK)
            self.rest = b""
            if not data:
                if not self.gzip.eof and self.at + len(self.held):
                    raise ValueError("the gzip stream is cut off")
                self.ended = True
                return False
            if self.gzip.eof:
                self.gzip = zlib.decompressobj(wbits=31)
            got = self.gzip.decompress(data, CHUNK)
            if self.gzip.eof:
                self.rest = self.gzip.unused_data
            if got:
                self.held += got
                return True
        return False

    def take(self, n: int) -> bytes:
        out = bytes(self.held[:n])
        del self.held[:n]
        self.at += len(out)
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self.more():
                raise ValueError(f"the record that reaches over byte {self.at} is cut off")
            part = self.take(min(n, len(self.held)))
            n -= len(part)
            yield part

    def header(self) -> bytes | None:
        """The next record's header with the blank line behind it; None at the end."""
        while True:
            while self.held[:2] == b"\r\n":  # blank lines between records
                self.take(2)
            end = self.held.find(b"\r\n\r\n")
            if end >= 0:
                return self.take(end + 4)
            if len(self.held) > MAX_HEADER:
                raise ValueError(f"no record header at byte {self.at}")
            if not self.more():
                if bytes(self.held).strip():
                    raise ValueError(f"the record at byte {self.at} is cut off")
                return None


def header_fields(header: bytes) -> dict[str, str]:
    version, *lines = header.decode("utf-8", "surrogatepass").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    return {name.strip().lower(): value.strip()
            for name, _, value in (line.partition(":") for line in lines if line)}


def normalise(files: DataFrame, source: str, folder: str) -> DataFrame:
    """Inflates each file (its name below ``source``) once and writes it to ``folder`` again with every
    record as a gzip member of its own, and beside it ``<name>.idx.json`` with a line per record: offset
    and length of its member, type, id, URI, digest, page. Returns name, records, bytes per new file.

    A file is one task's work, and a task holds a piece of a record at a time. Truncated streams and
    records without a WARC header raise.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (store, root), (target, out_root) = opened(source), opened(folder)
        target.create_dir(out_root, recursive=True)
        for batch in batches:
            for old in batch["name"]:
                name, at, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                with (store.open_input_stream(f"{root}/{old}", compression=None) as raw,
                      target.open_output_stream(f"{out_root}/{name}", compression=None) as out,
                      target.open_output_stream(f"{out_root}/{name}.idx.json", compression=None) as index):
                    stream = Inflated(raw)
                    while (header := stream.header()) is not None:
                        fields, gzip = header_fields(header), zlib.compressobj(wbits=31)
                        start = at
                        out.write(gzip.compress(header))
                        for part in stream.pieces(int(fields["content-length"])):
                            out.write(gzip.compress(part))
                        out.write(gzip.compress(b"\r\n\r\n") + gzip.flush())
                        at = out.tell()
                        index.write(json.dumps({
                            "archive": name, "offset": start, "length": at - start,
                            "type": fields.get("warc-type"), "record_id": fields.get("warc-record-id"),
                            "uri": fields.get("warc-target-uri"), "page": fields.get("x-page-id"),
                            "digest": fields.get("warc-payload-digest")}).encode() + b"\n")
                        count += 1
                yield pd.DataFrame({"name": [name], "records": [count], "bytes": [at]})

    parts = max(1, min(files.count(), 100_000))
    return written(files.select("name").repartition(parts).mapInPandas(run, FILES), "normalised")


def read_index(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """The sidecar lines of the reported ``files``."""
    lines = spark.read.schema(INDEX).json(f"{folder}/*.idx.json")
    return lines.join(files.select(F.col("name").alias("archive")), "archive", "left_semi")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that ``index`` lists, each read and inflated by its offset, with the payload's
    length and digest: computed for a response, from the headers for a revisit."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = opened(folder)
        name, source = None, None
        for batch in batches:
            rows, held = [], 0
            for line in batch.itertuples(index=False):
                if line.archive != name:
                    if source is not None:
                        source.close()
                    name, source = line.archive, store.open_input_file(f"{root}/{line.archive}")
                source.seek(line.offset)
                data = zlib.decompress(source.read(line.length), wbits=31)
                end = data.index(b"\r\n\r\n") + 4
                fields = header_fields(data[:end])
                block = data[end:end + int(fields["content-length"])]
                http, _, payload = block.partition(b"\r\n\r\n")
                refers = fields.get("x-refers-to-page-id")
                if fields["warc-type"] == "revisit":
                    size = int(re.search(rb"(?i)content-length: *(\d+)", http)[1])
                    digest = fields["warc-payload-digest"].partition(":")[2]
                else:
                    size, digest = len(payload), sha256(payload).hexdigest()
                rows.append((fields.get("x-page-id"), fields.get("warc-target-uri"),
                             fields["warc-type"], payload, size, digest, refers, name, line.offset))
                held += len(payload)
                if held >= 16 * CHUNK:
                    yield frame(rows)
                    rows, held = [], 0
            if rows:
                yield frame(rows)
        if source is not None:
            source.close()

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=[part.split()[0] for part in RECORDS.split(", ")])
        for column in ("page_id", "refers_to"):
            out[column] = pd.array([None if x is None else int(x) for x in out[column]], "Int64")
        return out

    return index.select("archive", "offset", "length").mapInPandas(read, RECORDS)


def archive_pages(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT,
                  roll: int = ROLL) -> DataFrame:
    """Writes ``pages`` as whole-file streams below ``folder``/raw, normalises them to ``folder``/records
    and returns the records read back. Repeated rows are records of their own; an empty table writes
    nothing and gives no rows; further columns are not read."""
    spark = pages.sparkSession
    made = write_archives(with_roles(pages, min_bytes), f"{folder}/raw", roll)
    files = normalise(made, f"{folder}/raw", f"{folder}/records")
    if files.isEmpty():
        return spark.createDataFrame([], RECORDS)
    return read_records(read_index(spark, files, f"{folder}/records"), f"{folder}/records")
