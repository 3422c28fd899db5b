"""WARC archives: writing, normalising monolithic gzip, reading back by index.

A page whose payload equals that of a page of smaller id is a revisit record. Tasks write archives whose whole
file is one gzip stream, as many crawlers leave them. The normaliser inflates such a stream once, in pieces,
writes each record as a member of its own and a sidecar index of offsets, so that a record can be read without
those before it. Record ids are urn:x-page:<page_id>.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, salted_join, shared_dir, small_batches

FILE_BYTES, PIECE = 64 << 20, 1 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(url: str | None) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "urn:x-none")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit of ``refers_to`` without the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:x-page:{'none' if page_id is None else page_id}>", "WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Target-URI: {_uri(url)}", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:x-page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(data: bytes) -> dict[str, str]:
    """Header lines after the first, names in lower case."""
    lines = data.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def _writer(folder: str, file_bytes: int):
    def run(batches):
        fs, path = pafs.FileSystem.from_uri(folder)
        fs.create_dir(path, recursive=True)
        out = None
        for b in batches:
            for page_id, url, html, refers_to in zip(*(b.column(i).to_pylist() for i in range(4))):
                if out is None:
                    name, n, size, gz = f"{uuid.uuid4().hex}.warc.gz", 0, 0, zlib.compressobj(6, zlib.DEFLATED, 31)
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                data = record(page_id, url, (html or "").encode("utf-8", "surrogatepass"), refers_to)
                out.write(gz.compress(data))
                n, size = n + 1, size + len(data)
                if size >= file_bytes:
                    out.write(gz.flush())
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"], "n": pa.array([n], pa.int64())})
        if out is not None:
            out.write(gz.flush())
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"], "n": pa.array([n], pa.int64())})

    return run


def write(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row of ``pages(page_id, url, html)``; returns the archives: (file, n).

    Of equal payloads of at least ``min_bytes`` bytes that of the smallest page_id is the response and the others
    revisit it. Very long payloads are written whole and extra columns are ignored. Null html is an empty payload; rows without a page_id never are the response that others refer to;
    rows that repeat the smallest id with the same payload are responses as well. No rows give no archives.
    """
    spark = small_batches(pages).sparkSession
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.col("html").alias("html"))
    rows = rows.withColumn("sha", F.unhex(F.sha1(F.encode(F.coalesce("html", F.lit("")), "UTF-8"))))
    long_enough = F.octet_length(F.coalesce("html", F.lit(""))) >= min_bytes
    first = rows.where(long_enough).groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    met = salted_join(rows, first, ["sha"], "left", hash_right=True)
    refers_to = F.when(long_enough & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    out = met.select("page_id", "url", "html", refers_to.alias("refers_to")).mapInArrow(_writer(folder or shared_dir(spark, "warc"), file_bytes), "file string, n long")
    return materialise(out, "warc-files")


def records(stream):
    """The records of a gzip stream of one or many members, each with its closing blank lines."""
    inflate, held, need = zlib.decompressobj(31), bytearray(), 0
    while piece := stream.read(PIECE):
        while piece:
            held += inflate.decompress(piece)
            piece = inflate.unused_data
            if inflate.eof:
                inflate = zlib.decompressobj(31)
        at = 0
        while True:
            if not need:
                end = held.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                need = end + 4 - at + int(headers(bytes(held[at : end + 2]))["content-length"]) + 4
            if len(held) - at < need:
                break
            yield bytes(held[at : at + need])
            at, need = at + need, 0
        del held[:at]
    if held:
        raise ValueError("the stream ends within a record")


def _normaliser(folder: str):
    def run(batches):
        for b in batches:
            for file in b.column(0).to_pylist():
                source, source_path = pafs.FileSystem.from_uri(file)
                fs, path = pafs.FileSystem.from_uri(folder)
                fs.create_dir(path, recursive=True)
                name, at, index = uuid.uuid4().hex, 0, []
                with source.open_input_stream(source_path, compression=None) as stream, fs.open_output_stream(f"{path}/{name}.warc.gz", compression=None) as out:
                    for data in records(stream):
                        gz = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = gz.compress(data) + gz.flush()
                        out.write(member)
                        index.append(b"%d\t%d\n" % (at, len(member)))
                        at += len(member)
                with fs.open_output_stream(f"{path}/{name}.idx", compression=None) as out:
                    out.write(b"".join(index))
                yield pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}.warc.gz"], "index": [f"{folder}/{name}.idx"], "n": pa.array([len(index)], pa.int64())})

    return run


def normalise(files: DataFrame, folder: str | None = None) -> DataFrame:
    """Rewrite archives with a member per record: (file, index, n) for the new archives and their indexes."""
    n = max(1, files.count())
    out = files.select("file").repartitionByRange(n, "file").mapInArrow(_normaliser(folder or shared_dir(files.sparkSession, "warc")), "file string, index string, n long")
    return materialise(out, "warc-normal")


def _page(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").rpartition(":")[2]
    return int(number) if number.lstrip("-").isdigit() else None


def _reader(batches):
    for b in batches:
        for file, index in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            fs, path = pafs.FileSystem.from_uri(file)
            with fs.open_input_stream(pafs.FileSystem.from_uri(index)[1], compression=None) as f:
                places = [tuple(map(int, x.split(b"\t"))) for x in f.read().splitlines()]
            out = []
            with fs.open_input_file(path) as f:
                for at, size in places:
                    data = zlib.decompress(f.read_at(size, at), 31)
                    end = data.index(b"\r\n\r\n")
                    h, block = headers(data[:end]), data[end + 4 : -4]
                    http = block.index(b"\r\n\r\n")
                    payload, digest = block[http + 4 :], h["warc-payload-digest"].removeprefix("sha1:")
                    if h["warc-type"] == "response" and base32_sha1(payload) != digest:
                        raise ValueError(f"{file}: the payload at {at} differs from its digest")
                    out.append((_page(h["warc-record-id"]), int(headers(block[: http + 2])["content-length"]), digest, h["warc-type"], _page(h.get("warc-refers-to"))))
                    if len(out) == 5000:
                        yield _rows(out)
                        out = []
            if out:
                yield _rows(out)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def read(files: DataFrame) -> DataFrame:
    """A row per record of normalised archives, each found by its index entry: responses checked against their digest, revisits against a response of the page they name.

    A revisit whose page has no response of the digest and length it states fails the job. No archives give no rows.
    """
    n = max(1, files.count())
    rows = files.select("file", "index").repartitionByRange(n, "file").mapInArrow(_reader, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    rows = materialise(rows, "warc-rows")
    responses, revisits = rows.where("record_type = 'response'"), rows.where("record_type <> 'response'")
    named = responses.where("page_id is not null").select(F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload_bytes").alias("_bytes")).distinct()
    met = salted_join(revisits, named, ["refers_to", "payload_digest"], "left", hash_right=True)
    wrong = F.raise_error(F.concat(F.lit("a revisit refers to no response like it: page "), F.coalesce(F.col("page_id").cast("string"), F.lit("null")))).cast("long")
    checked = F.when(F.col("_bytes").isNull() | (F.col("_bytes") != F.col("payload_bytes")), wrong).otherwise(F.col("payload_bytes"))
    return responses.union(met.select("page_id", checked.alias("payload_bytes"), "payload_digest", "record_type", "refers_to"))
