"""WARC archives, index first.

Writing: pages are grouped by payload digest to find each payload's response
(the page with the largest id); every task then streams its pages into archive
files, one gzip member a record, and returns an index row per record - file,
offset, length, URL, digest - which is written as a table.  Files carry a
unique name and are known through the index alone, so what a lost or repeated
attempt leaves behind is never read.

Reading starts from the index: selected records are sorted by file and offset,
neighbours closer than ``GAP`` bytes are coalesced into ranges of at most about
``SPAN`` bytes, and each range is one seek and one read.  Tasks are as many as
the ranges' summed bytes ask for (an index row is small, so its own size says
nothing), each with neighbouring ranges.  Records are parsed and their payload
digests verified.  An archive begins with a warcinfo record, and a revisit names
the record id and URL of its response, so that other readers can follow it.

Archives are opened through pyarrow's file systems by URI, so any store that it
knows works; they go under the shared folder of the cluster.

Scale: one join of pages with one row per payload (payloads that very many pages
share are combined before the shuffle and split by AQE after it), no gathering;
an archive is closed at ``ARCHIVE`` bytes.

Cases: null html is an empty payload; payloads below ``least`` bytes are always
responses; rows with equal page_id and payload are all responses, and so are
copies of a payload if none has an id; a page without an id revisits one that
has; a null url is written as an empty URI; other columns are ignored; an empty
table gives an empty index.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodgelake.llm.common import bounded_batches, stored, texts_of
from lodgelake.session import scratch_path

#: Payloads from this size on are written once and revisited.
LEAST = 0
#: Bytes after which an archive is closed, gap that is read over, and bytes of a range.
ARCHIVE, GAP, SPAN = 256 << 20, 64 << 10, 4 << 20
#: Bytes of archives that a reading task takes at most, about.
TASK = 128 << 20

_DATE = "2020-01-01T00:00:00Z"
INDEX = ("page_id bigint, url string, payload_digest string, payload_bytes bigint, record_type string, "
         "refers_to bigint, file string, offset bigint, length bigint")


def store_of(uri: str):
    """File system and path of a URI; a plain path is a shared mount."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(url: str | None) -> str:
    """URL as a header value: line ends and controls percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")


def record_id(page_id: int | None, url: str | None, sha: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{url}:{sha}')}>"


def _record(head: list[str], body: bytes) -> bytes:
    return "\r\n".join(["WARC/1.1", *head, f"Content-Length: {len(body)}"]).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def info_record(name: str) -> bytes:
    """The record that an archive begins with."""
    return _record(["WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>",
                    f"WARC-Date: {_DATE}", f"WARC-Filename: {name.rpartition('/')[2]}",
                    "Content-Type: application/warc-fields"], b"format: WARC File Format 1.1\r\n")


def record(page_id: int | None, url: str | None, payload: bytes, sha: str, refers_to: tuple[int, str | None] | None,
           size: int) -> bytes:
    """One WARC/1.1 record, without compression; ``refers_to``: page and URL of
    the response that it revisits."""
    head = [
        f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: {record_id(page_id, url, sha)}",
        f"WARC-Date: {_DATE}", f"WARC-Target-URI: {_one_line(url)}", f"WARC-Payload-Digest: sha1:{sha}",
        f"X-Page-Id: {'' if page_id is None else page_id}", f"X-Payload-Length: {size}",
    ]
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if refers_to:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(*refers_to, sha)}", f"WARC-Refers-To-Target-URI: {_one_line(refers_to[1])}",
                 f"WARC-Refers-To-Date: {_DATE}", f"X-Refers-To-Page: {refers_to[0]}"]
    else:
        body += payload
    return _record([*head, "Content-Type: application/http; msgtype=response"], body)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    body = rest[:int(fields["Content-Length"])]
    if len(body) != int(fields["Content-Length"]) or rest[len(body):] != b"\r\n\r\n":
        raise ValueError("a WARC record has a wrong length")
    return fields, body.partition(b"\r\n\r\n")[2]


def _payload(html: str) -> Column:
    return F.coalesce(F.col(html), F.lit("")).cast("binary")


def write_archives(pages: DataFrame, folder: str, least: int = LEAST) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) under ``folder``;
    returns the index, stored as a table."""
    pages = pages.select("page_id", "url", "html").withColumn("sha", F.sha1(_payload("html")))
    big = F.octet_length(_payload("html")) >= least
    newest = pages.where(big).groupBy("sha").agg(F.max(F.struct("page_id", "url")).alias("newest"))
    revisit = big & F.col("newest.page_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest.page_id"))
    told = pages.join(newest, "sha", "left").select(
        "page_id", "url", "html", F.when(revisit, F.col("newest.page_id")).alias("refers_to"),
        F.when(revisit, F.col("newest.url")).alias("refers_url"))

    def write(batches):
        out = name = None
        offset = 0
        try:
            for b in batches:
                rows = []
                for page_id, url, payload, refers_to, refers_url in zip(
                        b["page_id"].to_pylist(), b["url"].to_pylist(), texts_of(b["html"]),
                        b["refers_to"].to_pylist(), b["refers_url"].to_pylist()):
                    if out is not None and offset >= ARCHIVE:
                        out.close()
                        out = None
                    if out is None:
                        name = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                        fs, path = store_of(name)
                        out, info = fs.open_output_stream(path, compression=None), gzip.compress(info_record(name), mtime=0)
                        out.write(info)
                        offset = len(info)
                    sha = digest(payload)
                    response = None if refers_to is None else (refers_to, refers_url)
                    member = gzip.compress(record(page_id, url, payload, sha, response, len(payload)), 6, mtime=0)
                    out.write(member)
                    rows.append((page_id, url, sha, len(payload), "revisit" if response else "response", refers_to,
                                 name, offset, len(member)))
                    offset += len(member)
                cols = list(zip(*rows)) or [()] * 9
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(),
                         pa.int64(), pa.int64()]
                if out is not None:
                    out.flush()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds)], [f.split()[0] for f in INDEX.split(", ")])
        finally:
            if out is not None:
                out.close()

    bounded_batches()
    fs, path = store_of(folder)
    fs.create_dir(path, recursive=True)
    return stored(told.mapInArrow(write, INDEX), "warc-index")


def ranges(index: DataFrame, gap: int = GAP, span: int = SPAN) -> DataFrame:
    """(file, start, size, records): the index's records coalesced into byte
    ranges, sorted by file and place."""
    along = Window.partitionBy("file").orderBy("offset")  # an archive has a bounded size
    end = F.col("offset") + F.col("length")
    far = F.coalesce(F.col("offset") - F.lag(end).over(along) > gap, F.lit(True))
    part = index.withColumn("far", far.cast("int"))
    part = part.withColumn("run", F.sum("far").over(along)).withColumn("piece", F.floor(F.col("offset") / span))
    return part.groupBy("file", "run", "piece").agg(
        F.min("offset").alias("start"), F.max(end).alias("end"),
        F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("records")
    ).select("file", "start", (F.col("end") - F.col("start")).alias("size"), "records")


def read_records(index: DataFrame, gap: int = GAP, span: int = SPAN) -> DataFrame:
    """The records of the index's rows, read back and verified: page_id, url,
    record_type, refers_to, payload (null for a revisit), payload_bytes,
    payload_digest."""
    schema = ("page_id bigint, url string, record_type string, refers_to bigint, payload binary, "
              "payload_bytes bigint, payload_digest string")
    number = lambda v: int(v) if v else None

    def read(batches):
        opened, at = None, None
        for b in batches:
            for file, start, size, records in zip(*(b[c].to_pylist() for c in ("file", "start", "size", "records"))):
                if at != file:
                    if opened is not None:
                        opened.close()
                    fs, path = store_of(file)
                    opened, at = fs.open_input_file(path), file
                opened.seek(start)
                data = opened.read(size)
                rows = []
                for r in records:
                    k = r["offset"] - start
                    fields, payload = parse(gzip.decompress(data[k:k + r["length"]]))
                    revisit = fields["WARC-Type"] == "revisit"
                    sha = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if not revisit and digest(payload) != sha:
                        raise ValueError(f"payload of the record at {r['offset']} of {file} was altered")
                    rows.append((number(fields["X-Page-Id"]), fields["WARC-Target-URI"], fields["WARC-Type"],
                                 number(fields.get("X-Refers-To-Page")), None if revisit else payload,
                                 int(fields["X-Payload-Length"]) if revisit else len(payload), sha))
                kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [f.split()[0] for f in schema.split(", ")])
        if opened is not None:
            opened.close()

    return spread(stored(ranges(index, gap, span), "warc-ranges")).mapInArrow(read, schema)


def spread(parts: DataFrame, task: int = TASK) -> DataFrame:
    """Ranges dealt to as many tasks as their bytes ask for, and to all cores if
    there are so many; neighbours stay together, in order."""
    n, size = parts.agg(F.count("*"), F.sum("size")).first()
    tasks = max(1, -(-(size or 0) // task), min(n, parts.sparkSession.sparkContext.defaultParallelism))
    return parts.repartitionByRange(tasks, "file", "start").sortWithinPartitions("file", "start")


def round_trip(spark: SparkSession, pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back:
    page_id, payload_bytes, payload_digest, record_type, refers_to."""
    index = write_archives(pages, scratch_path(spark, "warc"), least)
    return read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
