"""WARC archives: a deterministic sharded writer, and a reader.

Records are range-sorted by page; every task writes gzip members to files that roll at a compressed
size. Files get temporary names of their own for each attempt; the manifest, a Parquet table that Spark
commits, names those of the attempts that count, and a second pass moves them to their final names, which
can be repeated safely. Readers take the files that the manifest lists and check sizes and digests.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes the smallest page_id's is a response, the
others revisit it without the payload; shorter ones are all responses.

Odd input: a null html is an empty payload; a null url is empty; pages without an id are written, read back
without one, and count as the largest ids; rows that repeat a page are written each. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.session import materialize, work_dir

MIN_REVISIT = 100
ROLL_BYTES = 64_000_000
#: Fixed value: the date of every record, as the table has none.
DATE = "2024-01-01T00:00:00Z"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "attempt string, name string, records bigint, bytes bigint, sha256 string"


def _place(path: str):
    """File system and path; also for stores that only their own client reaches."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:", "file://", 1))


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data, usedforsecurity=False).digest()).decode()


def _record_id(page: int | None) -> str:
    return f"<urn:x-page:{'none' if page is None else page}>"


def record(page: int | None, url: str, payload: bytes, digest: str, length: int, refers: int | None) -> bytes:
    """One record, headers regenerated. A revisit has the HTTP header but no payload."""
    uri = "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if refers is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: {_digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers is not None:
        head += [f"WARC-Refers-To: {_record_id(refers)}", f"WARC-Profile: {_REVISIT}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _own(pages: DataFrame) -> DataFrame:
    html = F.coalesce("html", F.lit("")).cast("binary")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), html.alias("payload"))
    return own.withColumns({"length": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})


def revisits(own: DataFrame) -> DataFrame:
    """(page_id, digest, refers): the pages that revisit another, decided on rows without payloads."""
    large = own.where(F.col("length") >= MIN_REVISIT).select("page_id", "digest")
    first = large.groupBy("digest").agg(F.min("page_id").alias("refers"), F.count("*").alias("n"))
    first = first.where("n > 1 AND refers IS NOT NULL").select("digest", "refers")
    return large.distinct().join(first, "digest").where("NOT page_id <=> refers").select("page_id", "digest", "refers")


def write(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Writes the archives into ``folder``, which must not hold any, and returns the manifest."""
    if _archives(folder):
        raise ValueError(f"{folder} holds archives already")
    own = _own(pages)
    # what a page revisits goes with the payloads to the page's range and stands before it: payloads move once
    told = revisits(own).select("page_id", F.lit("").alias("url"), F.lit(None).cast("binary").alias("payload"), F.lit(0).cast("long").alias("length"), "digest", "refers")
    rows = own.withColumn("refers", F.lit(None).cast("long")).unionByName(told)
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    page = F.col("page_id").asc_nulls_last()
    rows = rows.repartitionByRange(parts, page).sortWithinPartitions(page, "digest", F.col("refers").asc_nulls_last(), "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _place(folder)
        files.create_dir(f"{base}/tmp", recursive=True)
        part, out, done, number = TaskContext.get().partitionId(), None, [], 0
        told = None

        def close() -> None:
            out.close()
            done.append((attempt, f"part-{part:05d}-{number:05d}.warc.gz", records, size, sha.hexdigest()))

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "length", "refers"))
            for page, url, payload, digest, length, refers in zip(*columns):
                if refers is not None:
                    told = (page, digest, refers)
                    continue
                if told is not None and told[:2] == (page, digest):
                    refers = told[2]
                if out is None:
                    attempt, records, size, sha = f"{uuid.uuid4().hex}.tmp", 0, 0, hashlib.sha256()
                    out = files.open_output_stream(f"{base}/tmp/{attempt}", compression=None)
                pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = pack.compress(record(page, url, payload or b"", digest, length, refers)) + pack.flush()
                out.write(member)
                sha.update(member)
                records, size = records + 1, size + len(member)
                if size >= roll_bytes:
                    close()
                    out, number = None, number + 1
        if out is not None:
            close()
        columns = list(zip(*done)) or [()] * 5
        types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        names = [c.split()[0] for c in MANIFEST.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    manifest = materialize(rows.mapInArrow(run, MANIFEST), "manifest")

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, base = _place(folder)
        for batch in batches:
            for attempt, name in zip(batch.column("attempt").to_pylist(), batch.column("name").to_pylist()):
                if files.get_file_info(f"{base}/{name}").type == fs.FileType.NotFound:
                    files.move(f"{base}/tmp/{attempt}", f"{base}/{name}")
            yield batch

    return materialize(manifest.mapInArrow(commit, MANIFEST), "committed")


def _archives(folder: str) -> bool:
    from pyarrow import fs

    files, base = _place(folder)
    found = files.get_file_info(fs.FileSelector(base, allow_not_found=True))
    return any(f.base_name.endswith(".warc.gz") for f in found)


class _Measured:
    """A stream whose bytes are counted and hashed as they are read."""

    def __init__(self, stream):
        self.stream, self.size, self.sha = stream, 0, hashlib.sha256()

    def read(self, size: int) -> bytes:
        data = self.stream.read(size)
        self.size += len(data)
        self.sha.update(data)
        return data


def parse(data, size: int = 1 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a stream of gzip members, read piece by piece."""
    inflate, held, plain, more = zlib.decompressobj(31), b"", b"", True
    while more or held:
        if not held:
            held = data.read(size)
            more = bool(held)
            if not more:
                if not inflate.eof and plain:
                    raise ValueError("an archive ends inside a record")
                return
        plain += inflate.decompress(held)
        held = inflate.unused_data if inflate.eof else b""
        if inflate.eof:
            head, _, rest = plain.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            headers = dict(line.split(": ", 1) for line in lines[1:])
            length = int(headers["Content-Length"])
            if lines[0] != "WARC/1.1" or rest[length:] != b"\r\n\r\n":
                raise ValueError("not a record")
            yield headers, rest[:length]
            inflate, plain = zlib.decompressobj(31), b""


def read_back(manifest: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of all archives."""
    kind = (
        "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
        "refers_to bigint, payload binary"
    )
    names = [c.split()[0] for c in kind.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def page(text: str | None) -> int | None:
        found = text and text[len("<urn:x-page:") : -1]
        return None if not found or found == "none" else int(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _place(folder)
        for batch in batches:
            for name, records, size, sha in zip(*(batch.column(c).to_pylist() for c in ("name", "records", "bytes", "sha256"))):
                rows, seen = [], 0
                with files.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    data = _Measured(stream)
                    for headers, block in parse(data):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        length = int(http.decode().rsplit("Content-Length: ", 1)[1])
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                        full = headers["WARC-Type"] == "response"
                        if headers["WARC-Block-Digest"] != _digest(block) or full and (
                            len(payload) != length or hashlib.sha256(payload).hexdigest() != digest
                        ):
                            raise ValueError(f"{name}: a record does not match its digest")
                        refers = page(headers.get("WARC-Refers-To"))
                        own = (page(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], length, digest)
                        rows.append((*own, headers["WARC-Type"], refers, payload if full else None))
                        seen += 1
                        if len(rows) == 500:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                            rows = []
                if (seen, data.size, data.sha.hexdigest()) != (records, size, sha):
                    raise ValueError(f"{name} is not the file of the manifest: {seen} records, {data.size} bytes")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return manifest.repartition(F.col("name")).mapInArrow(run, kind)


def round_trip(pages: DataFrame, folder: str | None = None, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    folder = folder or f"{work_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    found = read_back(write(pages, folder, roll_bytes), folder)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
