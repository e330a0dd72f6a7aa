"""WARC archives of pages: written with one gzip member per record, and read back as a stream.

Tasks write archives of bounded size to the shared folder through pyarrow's file systems and return
a row for each; only rows of tasks that ended count, so what a lost task left behind is never read.
The reader goes through an archive once: it inflates piece by piece, parses a record's header, takes
as many bytes as its content length says, and compares the payload's SHA-1 with the header.

Of records with equal payloads the one with the largest key holds it (``response``); the others name
it (``revisit``) and hold none.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import keep
from barloom.session import scratch_path

ARCHIVE_BYTES = 64 << 20
PIECE = 1 << 20
LEVEL = 4
DATE = "1970-01-01T00:00:00Z"
ARCHIVES = "path string, records long, bytes long"
RECORDS = "page_id long, uri string, record_type string, refers_to long, payload_bytes long, payload_digest string, verified boolean"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header(fields: dict[str, str | None], first: str) -> bytes:
    """Header lines; line breaks and other controls in a value become spaces, fields without value are left out."""
    clean = lambda v: re.sub(r"[\x00-\x1f\x7f]+", " ", v).strip()
    lines = [first, *(f"{k}: {clean(v)}" for k, v in fields.items() if v is not None)]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def record(page_id: int | None, uri: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record: a response with its payload, or a revisit of the page it refers to."""
    head = header({"Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(payload))}, "HTTP/1.1 200 OK")
    block = head if refers_to is not None else head + payload
    name = lambda n: None if n is None else f"<urn:page:{n}>"
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": name(page_id) or f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, uri or '')}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": uri,
        "WARC-Refers-To": name(refers_to),
        "WARC-Profile": None if refers_to is None else _REVISIT,
        "WARC-Payload-Digest": f"sha1:{sha1_base32(payload)}",
        "X-Payload-Length": str(len(payload)),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    return header(fields, "WARC/1.1") + block + b"\r\n\r\n"


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", uri: str = "url", payload: str = "html", size: int = ARCHIVE_BYTES
) -> DataFrame:
    """Writes the pages, with a ``refers_to`` column, as archives below ``folder``; their paths as rows.

    A null payload is empty; a null key or address leaves that header field out.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        out, name, done, records = None, "", 0, 0
        for batch in batches:
            for page_id, address, text, refers_to in batch.itertuples(index=False):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, done, records = files.open_output_stream(f"{root}/{name}", compression=None), 0, 0
                member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                number = None if pd.isna(page_id) else int(page_id)
                target = None if pd.isna(refers_to) else int(refers_to)
                packed = member.compress(record(number, address, (text or "").encode(), target)) + member.flush()
                out.write(packed)
                done, records = done + len(packed), records + 1
                if done >= size:
                    out.close()
                    out = None
                    yield pd.DataFrame([(f"{folder}/{name}", records, done)], columns=["path", "records", "bytes"])
        if out is not None:
            out.close()
            yield pd.DataFrame([(f"{folder}/{name}", records, done)], columns=["path", "records", "bytes"])

    # Ids as text: a pandas column of numbers with gaps would turn into floats.
    rows = pages.select(F.col(key).cast("string").alias("k"), uri, payload, F.col("refers_to").cast("string").alias("r"))
    return keep(rows.mapInPandas(write, ARCHIVES), "archives")


class Members:
    """The inflated bytes of a gzip file, member by member, read on demand."""

    def __init__(self, stream):
        self.stream, self.raw, self.ahead = stream, b"", b""
        self.inflate = None

    def more(self) -> bool:
        """Inflates a further piece of the member; false at its end."""
        while not self.inflate.eof:
            if not self.raw:
                self.raw = self.stream.read(PIECE)
                if not self.raw:
                    raise EOFError("the archive ends within a record")
            piece = self.inflate.decompress(self.raw, PIECE)
            self.raw = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if piece:
                self.ahead += piece
                return True
        return False

    def next_member(self) -> bool:
        """Goes on to the next member; false at the end of the file."""
        if self.inflate is not None and (self.ahead or self.more()):
            raise ValueError("a record goes on after its content length")
        self.inflate = zlib.decompressobj(31)
        self.raw = self.raw or self.stream.read(PIECE)
        return bool(self.raw)

    def until(self, mark: bytes) -> bytes:
        while (at := self.ahead.find(mark)) < 0:
            if not self.more():
                raise ValueError("a record's header has no end")
        out, self.ahead = self.ahead[:at], self.ahead[at + len(mark) :]
        return out

    def take(self, length: int) -> Iterator[bytes]:
        """The next ``length`` bytes, in pieces."""
        while length:
            if not self.ahead and not self.more():
                raise EOFError("a record is shorter than its content length")
            piece, self.ahead = self.ahead[:length], self.ahead[length:]
            length -= len(piece)
            yield piece


def fields_of(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def read_record(source: Members) -> tuple:
    """One record as a row of RECORDS; its payload passes through in pieces."""
    head = fields_of(source.until(b"\r\n\r\n"))
    rest = int(head["content-length"])
    http = source.until(b"\r\n\r\n")
    length, digest = rest - len(http) - 4, hashlib.sha1()
    for piece in source.take(length):
        digest.update(piece)
    if b"".join(source.take(4)) != b"\r\n\r\n":
        raise ValueError("a record does not end after its content length")
    kind, named = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:")
    whole = int(head["x-payload-length"])
    page = lambda v: int(m[1]) if v and (m := re.fullmatch(r"<urn:page:(-?\d+)>", v)) else None
    right = length == 0 if kind == "revisit" else length == whole and base64.b32encode(digest.digest()).decode() == named
    return page(head["warc-record-id"]), head.get("warc-target-uri"), kind, page(head.get("warc-refers-to")), whole, named, right


def read_archives(archives: DataFrame) -> DataFrame:
    """The records of the archives named in ``path``; ``verified`` tells whether payload and header agree.

    Every archive is one task's stream and is never held as a whole. A broken archive is an error.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split(" ")[0] for c in RECORDS.split(", ")]
        rows = []
        for batch in batches:
            for path in batch["path"]:
                files, place = fs.FileSystem.from_uri(path)
                with files.open_input_stream(place, compression=None) as stream:
                    source = Members(stream)
                    while source.next_member():
                        rows.append(read_record(source))
                        if len(rows) >= 10_000:
                            yield framed(rows, columns)
                            rows = []
        if rows:
            yield framed(rows, columns)

    def framed(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
        # Through objects: numbers with gaps would turn into floats on the way.
        out = pd.DataFrame(rows, columns=columns, dtype=object)
        return out.astype({"page_id": "Int64", "refers_to": "Int64"})

    # Paths are few bytes, so partitions made by size would put all archives in one task.
    return archives.select("path").repartition(max(1, archives.count())).mapInPandas(read, RECORDS)


def with_revisits(pages: DataFrame, key: str = "page_id", payload: str = "html") -> DataFrame:
    """Adds ``refers_to``: for a row whose payload another one with a larger key holds too, the largest such key.

    Null payloads are empty and equal to each other. A row without a key refers to the largest key
    of its payload, and holds it if there is none. Rows that repeat the largest key all hold it.
    """
    hashed = pages.withColumn("_sha1", F.sha1(F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")))
    last = hashed.groupBy("_sha1").agg(F.max(key).alias("_last"), F.count("*").alias("_n")).where("_n > 1")
    out = hashed.join(last.drop("_n"), "_sha1", "left")
    other = F.col("_last").isNotNull() & ~F.col(key).eqNullSafe(F.col("_last"))
    return out.withColumn("refers_to", F.when(other, F.col("_last"))).drop("_sha1", "_last")


def archived(pages: DataFrame, key: str = "page_id", uri: str = "url", payload: str = "html") -> DataFrame:
    """Writes the pages as archives and reads them back: a row of RECORDS for each page.

    An empty table writes no archive and gives no rows.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    folder = folder if "://" in folder or folder.startswith(("/", "file:")) else f"/{folder}"
    rows = with_revisits(pages.select(key, uri, payload), key, payload)
    return read_archives(write_archives(rows, folder, key, uri, payload))
