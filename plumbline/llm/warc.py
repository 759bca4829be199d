"""WARC archives: records written in gzip members, and a reader that salvages what damage leaves.

Writing: payloads that are equal are found by their digests; the record of the smallest id is a
response, the others are revisits of it, which hold the response's HTTP header only. Each task packs
its records into archives of bounded size, which Spark writes, so that any store will do.

Reading: every member is checked (gzip's own sum, the version line, the lengths, the block's and the
payload's digest). After a failed check the reader goes on byte by byte to the next place where a
member or a version line stands that passes, so a damaged record costs no other one; the bytes
between are logged as a gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from uuid import uuid4

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import body, dealt, shared_dir, small_batches, table, written

#: Bytes from which an archive is closed; an archive is more only by its last record.
ARCHIVE_BYTES = 8 << 20
#: The format's version line, line end, what stands behind a block, and gzip's first bytes.
VERSION, LINE, BEHIND, MEMBER = b"WARC/1.0\r\n", b"\r\n", b"\r\n\r\n", b"\x1f\x8b\x08"
#: What a version line looks like, and the profile of a revisit of an equal payload.
VERSIONS, PROFILE = re.compile(rb"WARC/\d\.\d\r?\n"), "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
#: An empty gzip member; its last byte is a zero, as is that of every member of less than 16 MB.
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff03000000000000000000")


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, key: str, url: str, payload: bytes, refers: str | None) -> bytes:
    """One record as a gzip member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if kind == "response" else http
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{key}>"), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", url)]
    if refers is not None:
        head += [("WARC-Refers-To", f"<urn:page:{refers}>"), ("WARC-Profile", PROFILE)]
    head += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", "sha1:" + digest(payload)), ("WARC-Block-Digest", "sha1:" + digest(block)), ("Content-Length", str(len(block)))]
    lines = "".join(f"{name}: {' '.join(value.split())}\r\n" for name, value in head).encode()
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(VERSION + lines + LINE + block + BEHIND) + packer.flush()


def archives(rows: Iterator[tuple], limit: int = ARCHIVE_BYTES) -> Iterator[bytes]:
    """Archives of rows (kind, key, url, payload, refers): members end to end, each archive ending in a zero byte."""
    parts, size = [], 0
    for row in rows:
        member = record(*row)
        parts.append(member)
        size += len(member)
        if size >= limit:
            yield b"".join(parts if member[-1] == 0 else [*parts, EMPTY_MEMBER])
            parts, size = [], 0
    if parts:
        yield b"".join(parts if parts[-1][-1] == 0 else [*parts, EMPTY_MEMBER])


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0) -> None:
    """Writes a record for every row of pages to new archives under path.

    Payloads of `least` bytes or more that are equal make one response, by the smallest id; every row of
    that id and payload is one. A null page is an empty payload; a row without an id is a response only if
    no row of its payload has an id. An empty table leaves no archive with a record.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), body(html_col).alias("h"))
    rows = rows.withColumn("d", F.unhex(F.sha2("h", 256)))
    alike = rows.where(F.octet_length("h") >= least).groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    alike = written(alike.where((F.col("n") > 1) & F.col("first").isNotNull()), "payloads")
    joined = dealt(rows, alike.hint("shuffle_hash"), ["d"], "left", sizes=alike)
    ready = small_batches(joined.select(F.col("id").cast("string").alias("id"), "url", "h", F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")).cast("string").alias("refers")))

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (
            ("response" if r.refers is None or r.refers != r.refers else "revisit", r.id or "", r.url, r.h.encode(), r.refers or None)
            for b in batches
            for r in b.itertuples(index=False)
        )
        for archive in archives(rows):
            yield pd.DataFrame({"value": [archive[:-1]]})

    # Each row is an archive and gets a file of its own; the sink's line end is the zero byte taken off.
    out = ready.mapInPandas(packed, "value binary").select(F.col("value").cast("string").alias("value"))
    out.write.option("lineSep", "\u0000").option("maxRecordsPerFile", 1).option("compression", "none").text(path)


@dataclass
class Record:
    start: int
    end: int
    headers: dict[str, str]
    block: bytes
    problem: str = ""


@dataclass
class Reader:
    """Records and gaps of one archive."""

    data: bytes
    gaps: list[tuple[int, int, str]] = field(default_factory=list)
    zipped: int = -1  # the next start of a member that the search has seen

    def plain(self, data: bytes, at: int) -> tuple[Record | None, int, str]:
        """The record that starts at `at` of plain data, where it ends, or why there is none."""
        m = VERSIONS.match(data, at)
        if m is None:
            return None, at, "no version line"
        behind = re.compile(rb"\r?\n\r?\n").search(data, m.end() - 1)
        if behind is None:
            return None, at, "unfinished header"
        if VERSIONS.search(data, m.end(), behind.end()):
            return None, at, "a version line inside the header"
        headers = {}
        for line in data[m.end() : behind.start()].decode("utf-8", "replace").splitlines():
            name, colon, value = line.partition(":")
            if colon:
                headers[name.strip().lower()] = value.strip()
        size = headers.get("content-length", "")
        if not re.fullmatch("[0-9]{1,18}", size):
            return None, at, "no length"
        if not headers.get("warc-type") or not headers.get("warc-record-id"):
            return None, at, "no type or id"
        end = behind.end() + int(size)
        if end > len(data):
            return None, at, "shorter than its length"
        block = data[behind.end() : end]
        if data[end : end + 4] == BEHIND:
            end += 4
        elif end < len(data):
            return None, at, "no end behind the block"
        for name, what in (("warc-block-digest", block), ("warc-payload-digest", http(block)[1])):
            label, _, value = headers.get(name, "").partition(":")
            if label == "sha1" and value != digest(what) and not (name == "warc-payload-digest" and headers.get("warc-type") == "revisit"):
                return None, at, name.removeprefix("warc-") + " differs"
        return Record(at, end, headers, block), end, ""

    def member(self, at: int) -> tuple[list[Record], int, str]:
        """Records of the gzip member at `at`, where it ends, and what is wrong with it.

        All that a member of several records gives before a broken place is kept.
        """
        taker = zlib.decompressobj(31)
        try:
            head = taker.decompress(self.data[at : at + 512], 16)
            if head and not head.startswith(b"WARC/"[: len(head)]):
                return [], at, "no version line"
        except zlib.error:
            return [], at, "damaged member"
        # Pieces grow, so that a false start costs little and a long member few copies.
        taker, parts, pos, step, problem = zlib.decompressobj(31), [], at, 1 << 12, ""
        while not taker.eof and not problem:
            piece = self.data[pos : pos + step]
            if not piece:
                problem = "unfinished member"
                break
            try:
                parts.append(taker.decompress(piece))
            except zlib.error:
                problem = "damaged member"
            pos, step = pos + len(piece), min(2 * step, 1 << 20)
        end = pos - len(taker.unused_data)
        data, found, inner = b"".join(parts), [], 0
        while inner < len(data):
            r, inner, why = self.plain(data, inner)
            if r is None:
                problem = problem or why
                step = VERSIONS.search(data, inner + 1)
                if step is None:
                    break
                inner = step.start()
                continue
            found.append(Record(at, end, r.headers, r.block))
        return found, (at if problem and not found else end), problem

    def records(self) -> Iterator[Record]:
        data, at, broken, why = self.data, 0, None, ""
        while at < len(data):
            if data.startswith(MEMBER, at):
                if data.startswith(EMPTY_MEMBER, at):
                    at += len(EMPTY_MEMBER)
                    continue
                found, end, problem = self.member(at)
            else:
                r, end, problem = self.plain(data, at)
                found = [r] if r else []
            if problem and broken is None:
                broken, why = at, problem
            if found:
                if problem:
                    # A broken member of several records: its rest is a gap up to the next good place.
                    yield from found
                    end = at + 1
                else:
                    if broken is not None:
                        self.gaps.append((broken, at - broken, why))
                        broken = None
                    yield from found
            at = end if not problem else self.next_place(at + 1)
        if broken is not None:
            self.gaps.append((broken, len(data) - broken, why))

    def next_place(self, at: int) -> int:
        """The next place from `at` on where a member or a version line may start."""
        if self.zipped < at:
            found = self.data.find(MEMBER, at)
            self.zipped = found if found >= 0 else len(self.data)
        line = VERSIONS.search(self.data, at, self.zipped)
        return line.start() if line else self.zipped


def http(block: bytes) -> tuple[bytes, bytes]:
    """Header and payload of an HTTP message; a block that is none is all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    head, _, payload = block.partition(b"\r\n\r\n")
    return head, payload


def salvaged(data: bytes) -> Iterator[dict]:
    """What an archive holds, as rows of read_archives without the archive's name: records as they stand, then gaps."""
    reader = Reader(data)
    blank = dict.fromkeys(["record_type", "record_id", "refers_to", "target_uri", "payload_digest", "payload_bytes", "payload", "problem"])
    for r in reader.records():
        h = r.headers
        head, payload = http(r.block)
        size = len(payload)
        if h.get("warc-type") == "revisit":
            length = re.search(rb"(?im)^content-length:\s*([0-9]{1,18})\s*$", head)
            size, payload = int(length[1]) if length else None, None
        label, _, told = h.get("warc-payload-digest", "").partition(":")
        sha = told if label == "sha1" and told else digest(payload) if payload is not None else None
        row = {"start": r.start, "length": r.end - r.start, "gap": False, "record_type": h.get("warc-type"), "record_id": h.get("warc-record-id"), "refers_to": h.get("warc-refers-to")}
        yield blank | row | {"target_uri": h.get("warc-target-uri"), "payload_digest": sha, "payload_bytes": size, "payload": payload}
    for start, length, why in reader.gaps:
        yield blank | {"start": start, "length": length, "gap": True, "problem": why}


#: Columns of what is read.
FIELDS = "archive string, start long, length long, gap boolean, record_type string, record_id string, refers_to string, target_uri string, payload_digest string, payload_bytes long, payload binary, problem string"


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and gaps of all archives under path, whether of gzip members or plain.

    A record has its place in the archive (its member's, if it stands in one), its headers' main values and its payload (null
    for revisits, or without `payloads`); a gap (gap = true) has its first byte, its length and the
    first check that failed. An archive is read by one task, so it has to fit into its memory (the writer
    closes archives at ARCHIVE_BYTES); an empty one gives no row, one without any good record one gap.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, data in zip(b["path"], b["content"], strict=True):
                rows, size = [], 0
                for row in salvaged(bytes(data)):
                    if not payloads:
                        row["payload"] = None
                    rows.append({"archive": name, **row})
                    size += 500 + len(row["payload"] or b"")
                    if size > ARCHIVE_BYTES:
                        yield pd.DataFrame(rows)
                        rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows).astype({"payload_bytes": "Int64"})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(read, FIELDS)


def op11_warc(spark, sf_dir: str) -> DataFrame:
    """Every page's record, as the archives that were written give it back."""
    pages = table(spark, sf_dir, "pages")
    path = f"{shared_dir(spark)}/plumbline/{spark.sparkContext.applicationId}/archives-{uuid4().hex}"
    write_archives(pages, path)
    kind = pages.schema["page_id"].dataType.simpleString()
    key = lambda c: F.nullif(F.regexp_extract(c, "^<urn:page:(.*)>$", 1), F.lit("")).cast(kind)
    rows = read_archives(spark, path, payloads=False).where("not gap")
    return rows.select(key("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", key("refers_to").alias("refers_to"))
