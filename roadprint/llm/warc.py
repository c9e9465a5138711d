"""WARC archives: one gzip member per record, and a splittable reader."""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadprint.llm.common import keep
from roadprint.session import shared_dir

MIN_REVISIT = 1000  # payload bytes from which a repeated payload becomes a revisit
SPLIT_BYTES = 8 << 20  # of an archive read by one task
READ_BYTES = 1 << 18
MAGIC = b"\x1f\x8b\x08"  # Fixed value: gzip, deflate
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"  # Fixed value
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORD = "page_id bigint, uri string, record_type string, refers_to bigint, header_digest string, payload binary"


def _open(path: str):
    """File system and path of a URI; workers reach the shared folder through it."""
    from pyarrow import fs
    uri = re.sub(r"^file:/+", "file:///", path)
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _urn(page_id) -> str:
    return f"<urn:page:{'none' if page_id is None else int(page_id)}>"


def _page(urn: str | None):
    m = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(m[1]) if m else None


def record(page_id, uri: str | None, payload: bytes, digest: bytes, refers_to) -> bytes:
    """One WARC record as a gzip member; a revisit holds headers only."""
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _urn(page_id)),
            ("WARC-Date", DATE), ("WARC-Payload-Digest", "sha1:" + base64.b32encode(digest).decode())]
    if uri is not None:
        head.append(("WARC-Target-URI", re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", uri)))
    if refers_to is not None:
        head += [("WARC-Refers-To", _urn(refers_to)), ("WARC-Profile", PROFILE)]
    block = HTTP + (payload if refers_to is None else b"")
    head += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    text = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
    return gz.compress(text.encode("utf-8") + block + b"\r\n\r\n") + gz.flush()


def parse(data: bytes) -> dict | None:
    """The fields of one whole record; None if it isn't one."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    n = fields.get("content-length", "")
    if not lines[0].startswith("WARC/1.") or not n.isdigit() or rest[int(n):] != b"\r\n\r\n":
        return None
    payload = rest[:int(n)].partition(b"\r\n\r\n")[2]
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    return {"page_id": _page(fields.get("warc-record-id")), "uri": fields.get("warc-target-uri"),
            "record_type": fields.get("warc-type"), "refers_to": _page(fields.get("warc-refers-to")),
            "header_digest": base64.b32decode(digest).hex() if digest else None,
            "payload": payload if fields.get("warc-type") == "response" else None}


def write_archives(pages: DataFrame, folder: str, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as WARC archives; returns the manifest (path, size, records).

    Of pages with equal payloads of ``min_revisit`` bytes or more, that with the largest
    page_id is a response and the others revisit it.  Every task writes one archive under a
    name of its own attempt, and only archives of tasks that ended are in the manifest, so
    a lost executor leaves no half archive in it.

    A null html is an empty payload; a null url gives no target; a null page_id is kept as
    none; repeated pages give repeated records; an empty table gives an empty manifest.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))
    again = (rows.where(F.octet_length("html") >= min_revisit).groupBy("digest")
             .agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    marked = rows.join(again, "digest", "left").select(
        "page_id", "url", "html", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        task = TaskContext.get()
        path = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
        system, at = _open(path)
        system.create_dir(at.rsplit("/", 1)[0], recursive=True)
        size = n = 0
        none = lambda x: None if pd.isna(x) else x
        with system.open_output_stream(at, compression=None) as out:
            for b in batches:
                for p, u, h, d, r in zip(b["page_id"], b["url"], b["html"], b["digest"], b["refers_to"]):
                    size += out.write(data := record(none(p), none(u), h.encode("utf-8"), bytes.fromhex(d),
                                                     none(r))) or len(data)
                    n += 1
        if n:
            yield pd.DataFrame({"path": [path], "size": [size], "records": [n]})
        else:
            system.delete_file(at)

    # Ids go as nullable integers: a float would round large ones.
    return keep(marked.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
                .mapInPandas(write, "path string, size bigint, records bigint"), "warc-manifest")


class _Member:
    """Reads gzip members of an open archive from given offsets, in bounded pieces."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size

    def at(self, offset: int) -> tuple[int, bytes] | None:
        """End and content of the member at ``offset``; None if no WARC record begins there."""
        unzip, out, pos = zlib.decompressobj(31), bytearray(), offset
        self.file.seek(offset)
        try:
            while not unzip.eof:
                piece = self.file.read(READ_BYTES)
                if not piece:
                    return None
                pos += len(piece)
                out += unzip.decompress(piece)
                if len(out) >= 7 and not out.startswith(b"WARC/1."):
                    return None
        except zlib.error:
            return None
        return pos - len(unzip.unused_data), bytes(out)

    def magic(self, start: int, stop: int) -> int | None:
        """The first offset in [start, stop) where gzip magic stands."""
        while start < stop:
            self.file.seek(start)
            piece = self.file.read(min(READ_BYTES, stop - start) + len(MAGIC) - 1)
            found = piece.find(MAGIC)
            if found >= 0 and start + found < stop:
                return start + found
            start += min(READ_BYTES, stop - start)
        return None


def read_range(file, size: int, start: int, stop: int) -> Iterator[dict]:
    """Records of the members that begin in [start, stop).

    A range scans for magic until a member decodes to a WARC header; from there members
    follow each other.  Where one does not decode, scanning resumes after it.
    """
    member, pos = _Member(file, size), start
    while (at := member.magic(pos, min(stop, size))) is not None:
        got = member.at(at)
        row = parse(got[1]) if got else None
        if row is None:
            pos = at + 1
        else:
            yield row
            pos = got[0]


def read_archives(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """All records of the archives in ``manifest(path, size)``: see RECORD.

    Archives are cut into byte ranges of ``split_bytes``, one row each, dealt to tasks; a
    record belongs to the range in which its member begins.
    """
    ranges = keep(manifest.where("size > 0").select("path", "size", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("size") - 1, F.lit(split_bytes).cast("bigint"))).alias("start")), "warc-ranges")
    n = max(1, ranges.count())

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, size, start in zip(b["path"], b["size"], b["start"]):
                system, at = _open(path)
                held, weight = [], 0
                with system.open_input_file(at) as file:
                    for row in read_range(file, int(size), int(start), int(start) + split_bytes):
                        held.append(row)
                        weight += len(row["payload"] or b"")
                        if weight > READ_BYTES * 16:
                            yield _frame(held)
                            held, weight = [], 0
                if held:
                    yield _frame(held)

    return ranges.repartition(n).mapInPandas(read, RECORD)


def _frame(rows: list[dict]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["page_id", "uri", "record_type", "refers_to", "header_digest", "payload"],
                       dtype="object")
    return out.astype({"page_id": "Int64", "refers_to": "Int64"})


def round_trip(spark: SparkSession, pages: DataFrame, folder: str | None = None,
               min_revisit: int = MIN_REVISIT, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Write pages as archives, read them back: (page_id, payload_bytes, payload_digest, record_type, refers_to).

    Digest and size of a response are those of the payload read; a revisit has those of the
    response that it refers to.
    """
    manifest = write_archives(pages, folder or shared_dir(spark, "warc"), min_revisit)
    read = keep(read_archives(manifest, split_bytes).select(
        "page_id", "record_type", "refers_to", "header_digest",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.sha1("payload").alias("payload_digest")),
        "warc-read")
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    full = read.where("record_type = 'response'").select(cols)
    first = (full.where("page_id is not null").groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest"))
             .agg(F.max("payload_bytes").alias("payload_bytes")))
    revisits = (read.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to",
                                                             F.col("header_digest").alias("payload_digest"))
                .join(first, ["refers_to", "payload_digest"], "left").select(cols))
    return full.unionByName(revisits)
