"""WARC archives as a table of record chunks.

Payloads are handled in chunks of a fixed size, one row for each (record, chunk
number). Spark cuts the payloads into chunk rows; the writer streams these rows into
archives, one record after the other, each a gzip member of its own, and checks the
running digest at a record's end; the reader streams an archive and yields chunk rows
again, each with the digest of the payload up to its end. Records are an aggregation of
the chunk table. No Python task joins a record's chunks, so its memory does not depend
on the size of a record.

Of records with equal payloads one is written in full (`response`), the others refer
to it (`revisit`) and have no payload; their HTTP header tells its size.

Archives go to the shared folder under names of their own for each attempt of a task.
The landed list of archives names those of the attempts that Spark committed, and only
those are read, so a lost or repeated task leaves no record twice.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.common import land, new_path

CHUNK = 1 << 16
#: An archive is closed when it has grown to this size.
ARCHIVE = 1 << 30
_SCHEMA = "archive string, record_no long, record_id string, record_type string, refers_to string, payload_bytes long, chunk_no int, chunk binary, digest string, last boolean"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode("ascii")


def payload_chunks(records: DataFrame, size: int = CHUNK) -> DataFrame:
    """The rows of a table with a binary `payload`, once for each of its chunks: instead of the payload `chunk_no`, `chunk`, `last`.

    Chunks of a row follow each other in one partition; an empty payload is one empty chunk.
    """
    others = [c for c in records.columns if c != "payload"]
    count = F.greatest(F.lit(1), F.ceil(F.octet_length("payload") / F.lit(size)).cast("int"))
    cut = records.select(*others, "payload", count.alias("n_chunks")).select(*others, "payload", "n_chunks", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)).alias("chunk_no"))
    return cut.select(*others, "chunk_no", F.substring("payload", F.col("chunk_no") * F.lit(size) + 1, F.lit(size)).alias("chunk"), (F.col("chunk_no") + 1 == F.col("n_chunks")).alias("last"))


class ArchiveWriter:
    """Records into archives below a folder; `archives` lists (uri, records)."""

    def __init__(self, folder: str, stem: str, most: int = ARCHIVE):
        self.most = most
        self.fs, self.base = pyarrow.fs.FileSystem.from_uri(folder)
        self.folder, self.stem, self.archives = folder, stem, []
        self.fs.create_dir(self.base, recursive=True)
        self.out: BinaryIO | None = None
        self.size = 0

    def begin(self, headers: list[tuple[str, str]], http: bytes, payload_bytes: int) -> None:
        """Begin a record whose payload of so many bytes follows by `chunk`."""
        if self.out is None or self.size > self.most:
            self.close()
            name = f"{self.stem}-{len(self.archives):05d}.warc.gz"
            self.out, self.size = self.fs.open_output_stream(f"{self.base}/{name}", compression=None), 0
            self.archives.append([f"{self.folder}/{name}", 0])
        self.archives[-1][1] += 1
        self.member, self.digest, self.left = zlib.compressobj(1, zlib.DEFLATED, 31), hashlib.sha1(), payload_bytes
        head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(http) + payload_bytes))]) + "\r\n"
        self._put(self.member.compress(head.encode() + http))

    def chunk(self, chunk: memoryview) -> None:
        self.digest.update(chunk)
        self.left -= len(chunk)
        self._put(self.member.compress(chunk))

    def end(self, digest: str | None) -> None:
        """End the record; its payload must have the size that was told, and the digest if one is given."""
        if self.left or (digest is not None and self.digest.hexdigest() != digest):
            raise ValueError("the chunks of a record are not its payload")
        self._put(self.member.compress(b"\r\n\r\n") + self.member.flush())

    def _put(self, data: bytes) -> None:
        if data:
            self.out.write(data)
            self.size += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0, archive_bytes: int = ARCHIVE) -> DataFrame:
    """Write a record for each row; the landed list of archives (uri, records).

    Of rows with equal payloads of at least `least_bytes` bytes, those with the largest
    id are responses and the others revisit it; smaller payloads are all responses. A
    null payload is an empty one. Rows with a null id are never the one referred to; among
    null ids alone all are responses. A null URL is written as an empty target.
    """
    rows = pages.select(F.col(id_col).cast("string").alias("id"), F.col(id_col).alias("order"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))
    # Payloads that occur more than once: one row each, as small as the number of copied texts.
    copied = rows.filter(F.col("payload_bytes") >= least_bytes).groupBy(F.col("payload_digest").alias("of")).agg(F.max("order").alias("newest"), F.count("*").alias("n")).filter("n > 1 AND newest IS NOT NULL")
    copied = land(copied.select("of", F.col("newest"), F.col("newest").cast("string").alias("refers_to")), "copied-payloads")
    again = F.col("newest").isNotNull() & (F.col("order").isNull() | (F.col("order") < F.col("newest")))
    planned = rows.join(copied, rows["payload_digest"] == copied["of"], "left").select(
        "id", "url", "payload_bytes", "payload_digest", F.when(again, F.col("refers_to")).alias("refers_to"), F.when(again, F.lit(b"")).otherwise(F.col("payload")).alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            ids, urls, sizes, digests, refers, places, lasts = (batch.column(k).to_pylist() for k in (0, 1, 2, 3, 4, 5, 7))
            for i, url, size, digest, to, k, chunk, last in zip(ids, urls, sizes, digests, refers, places, batch.column(6), lasts, strict=True):
                out = out or ArchiveWriter(folder, f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}", archive_bytes)
                if k == 0:
                    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
                    clean = "".join(c for c in url or "" if c not in "\r\n")
                    headers = [("WARC-Type", "revisit" if to is not None else "response"), ("WARC-Record-ID", f"<urn:page:{'' if i is None else i}>"), ("WARC-Target-URI", clean),
                               ("WARC-Payload-Digest", f"sha1:{base32(bytes.fromhex(digest))}"), ("Content-Type", "application/http; msgtype=response")]
                    if to is not None:
                        headers += [("WARC-Refers-To", f"<urn:page:{to}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
                    out.begin(headers, http, size if to is None else 0)
                out.chunk(memoryview(chunk.as_buffer()))
                if last:
                    out.end(digest if to is None else None)
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out.archives]), pa.array([n for _, n in out.archives], pa.int64())], names=["uri", "records"])

    return land(payload_chunks(planned).mapInArrow(run, "uri string, records long"), "archives")


class _Members:
    """The bytes of a gzip file with many members, in pieces."""

    def __init__(self, raw: BinaryIO, size: int):
        self.raw, self.size, self.held, self.member = raw, size, b"", zlib.decompressobj(31)

    def read(self) -> bytes:
        """Up to `size` bytes; none at the end."""
        while True:
            data = self.member.decompress(self.member.unconsumed_tail or self.held, self.size)
            self.held = b"" if not self.member.eof else self.member.unused_data
            if self.member.eof:
                self.member = zlib.decompressobj(31)
            if data:
                return data
            if not self.held and not self.member.unconsumed_tail:
                self.held = self.raw.read(self.size)
                if not self.held:
                    return b""


class _Stream:
    """Lines and counted pieces of a stream that arrives in pieces."""

    def __init__(self, members: _Members):
        self.members, self.held = members, b""

    def line(self) -> bytes:
        """The next line with its end; empty at the end of the stream."""
        while b"\n" not in self.held:
            more = self.members.read()
            if not more:
                line, self.held = self.held, b""
                return line
            self.held += more
        line, end, self.held = self.held.partition(b"\n")
        return line + end

    def pieces(self, count: int, size: int) -> Iterator[bytes]:
        """Exactly `count` bytes, in pieces of `size`."""
        while count:
            wanted = min(count, size)
            while len(self.held) < wanted:
                more = self.members.read()
                if not more:
                    raise EOFError("the archive ends within a record")
                self.held += more
            piece, self.held = self.held[:wanted], self.held[wanted:]
            count -= wanted
            yield piece

    def headers(self) -> tuple[dict[str, str], int]:
        """The header lines up to the empty one, and how many bytes they took."""
        found, size = {}, 0
        while True:
            line = self.line()
            if not line:
                raise EOFError("the archive ends within a header")
            size += len(line)
            if not line.strip():
                return found, size
            name, _, value = line.decode().partition(":")
            found[name.strip().lower()] = value.strip()


def archive_chunks(raw: BinaryIO, size: int = CHUNK) -> Iterator[tuple]:
    """The chunk rows of one archive, in the order of _SCHEMA from record_id on; a record begins where chunk_no is 0. The digest is that of the payload up to the chunk's end.

    A revisit is one row without a chunk, with the digest and size that its headers give.
    """
    stream = _Stream(_Members(raw, size))
    while first := stream.line():
        if not first.strip():
            continue
        if not first.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should begin")
        headers, _ = stream.headers()
        record, refers_to = (headers.get(k, "").removeprefix("<urn:page:").removesuffix(">") or None for k in ("warc-record-id", "warc-refers-to"))
        kind = headers["warc-type"]
        http, taken = stream.headers()
        left = int(headers["content-length"]) - taken
        if kind == "revisit":
            for _ in stream.pieces(left, size):
                pass
            yield record, kind, refers_to, int(http["content-length"]), 0, None, headers["warc-payload-digest"].removeprefix("sha1:"), True
            continue
        digest, done, k = hashlib.sha1(), 0, 0
        for piece in stream.pieces(left, size):
            digest.update(piece)
            done += len(piece)
            yield record, kind, None, done, k, piece, base32(digest.digest()), done == left
            k += 1
        if not left:
            yield record, kind, None, 0, 0, b"", base32(digest.digest()), True


def read_archives(archives: DataFrame) -> DataFrame:
    """The chunk table of the listed archives: archive, record_no (its place in the archive), record_id, record_type, refers_to, payload_bytes (so far), chunk_no, chunk, digest (so far), last."""
    names = [c.strip().split(" ")[0] for c in _SCHEMA.split(",")]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.string(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for uri in batch.column(0).to_pylist():
                fs, path = pyarrow.fs.FileSystem.from_uri(uri)
                with fs.open_input_stream(path, compression=None) as raw:
                    rows: list[tuple] = []
                    held, record = 0, -1
                    for row in archive_chunks(raw):
                        record += row[4] == 0
                        rows.append((uri, record, *row))
                        held += len(row[5] or b"") + 200
                        if held > 1 << 22:
                            yield out(rows)
                            rows, held = [], 0
                    if rows:
                        yield out(rows)

    count = archives.count()
    return archives.select("uri").repartition(max(1, count)).mapInArrow(run, _SCHEMA)


def records_of(chunks: DataFrame) -> DataFrame:
    """One row for each record of a chunk table: record_id, record_type, refers_to, payload_bytes, payload_digest, n_chunks.

    Sizes are sums over the chunks (a revisit has none and tells its own), the digest is
    the last chunk's. A record whose chunks are not complete is an error.
    """
    size = F.coalesce(F.octet_length("chunk").cast("long"), F.col("payload_bytes"))
    found = chunks.select("archive", "record_no", "record_id", "record_type", "refers_to", "payload_bytes", "chunk_no", "digest", "last", size.alias("size")).groupBy(
        "archive", "record_no", "record_id", "record_type", "refers_to").agg(
        F.sum("size").alias("size"), F.max("payload_bytes").alias("told"), F.count("*").alias("n_chunks"), F.max("chunk_no").alias("at"), F.max(F.when(F.col("last"), F.col("digest"))).alias("payload_digest"))
    whole = F.col("payload_digest").isNotNull() & (F.col("n_chunks") == F.col("at") + 1) & (F.col("size") == F.col("told"))
    return found.select("record_id", "record_type", "refers_to", F.when(whole, F.col("size")).otherwise(F.raise_error(F.lit("chunks of a record are missing")).cast("long")).alias("payload_bytes"), "payload_digest", "n_chunks")


def archived_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write archives of the rows, read them back; per record: the id, payload_bytes, payload_digest, record_type, refers_to.

    A null payload is an empty one, null ids stay null, repeated rows are records of
    their own (all of them responses, where theirs is the largest id of their payload),
    other columns are not read, an empty table gives an empty one.
    """
    kind = pages.schema[id_col].dataType
    archives = write_archives(pages, new_path(pages.sparkSession, "warc"), id_col, url_col, payload_col, least_bytes)
    return records_of(read_archives(archives)).select(
        F.col("record_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
