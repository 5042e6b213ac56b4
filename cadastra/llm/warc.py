"""WARC archives: a writer with revisit records and a splittable reader.

Writing.  Every record is a gzip member of its own.  Members go through Spark's text writer, whose
line separator is set to an empty gzip member, so an archive is one valid gzip stream, any Hadoop
file system will do, and lost or repeated tasks are settled by Spark's commit protocol.

Reading.  Spark's text reader is given the three magic bytes of a gzip header as its separator: each
task scans its own byte range of a file for the magic, and owns the candidates that start inside it
(the last one is read past the end of the range).  A candidate counts as a member only if its gzip
header decodes and its content starts with ``WARC/``.  Magic bytes inside compressed data cut a
member in two; the pieces are put together again, and where such a cut falls between two tasks the
fragments (rare, small) meet by file in a second step.  Nothing reads a file as a whole.

Equal payloads are found by SHA-1 with map-side combined ``max(page_id)``: a hot payload is one row
per task.  Only payloads that occur more than once enter the join.

Damage.  A member that breaks off or does not decode gives no record; the whole members after it do.
Known limit: a whole WARC member that stands uncompressed inside another one is read as a record, and
the outer one lost, where a split falls between their starts.

Edge cases.  Null html: an empty payload.  Null ids are written as empty and read back as null.
Repeated rows of the winning id are all responses.  A hot payload's revisits carry no payload.
Archive files must not end in ``.gz``, since Hadoop's text reader would decode them as one stream.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import _runtime as rt

MAGIC = b"\x1f\x8b\x08"
SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
_DATE = "2024-01-01T00:00:00Z"


def gzip_member(content: bytes, level: int) -> bytes:
    """One gzip member with a plain ten-byte header and no time stamp."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(content) + z.flush()


EMPTY_MEMBER = gzip_member(b"", 9)


def warc_record(page_id, url: str | None, payload: bytes, refers_to, digest: str) -> bytes:
    """A response record, or a revisit (``refers_to`` given) that keeps only the HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    name = lambda x: f"<urn:page:{'' if x is None else x}>"
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {_DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(url.splitlines()))
    if revisit:
        head += [f"WARC-Refers-To: {name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(content: bytes) -> dict:
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        key, _, value = line.partition(":")
        fields[key.strip().lower()] = value.strip()
    block = rest[: int(fields.get("content-length", 0))]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next((int(x.split(b":", 1)[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), len(payload))
    ident = lambda k: (lambda v: int(v) if v.lstrip("-").isdigit() else None)(fields.get(k, "").removeprefix("<urn:page:").removesuffix(">"))
    return {
        "page_id": ident("warc-record-id"),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": length,
        "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:"),
        "record_type": fields.get("warc-type"),
        "refers_to": ident("warc-refers-to"),
        "payload": payload if fields.get("warc-type") != "revisit" else None,
    }


def _write_batches(level: int):
    def run(batches):
        for batch in batches:
            out = []
            for page_id, url, html, refers in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                payload = (html or "").encode()
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                out.append(gzip_member(warc_record(page_id, url, payload, refers, digest), level))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    return run


def write_warc(
    pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", revisit_from_bytes: int = 0, level: int = 4
) -> None:
    """Write a record per row below ``path``.  Among payloads of at least ``revisit_from_bytes``
    that are equal, the one with the largest id is the response and the others revisit it."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))
    long_enough = F.octet_length("html") >= revisit_from_bytes
    twins = rows.where(long_enough).groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("best")).where(F.col("n") > 1).select("digest", "best")
    twins = rt.materialize(twins, "twins")
    if not twins.isEmpty():
        joined = rows.join(rt.maybe_broadcast(twins, 96), "digest", "left")
        refers = F.when(long_enough & ~F.col("page_id").eqNullSafe(F.col("best")), F.col("best"))
    else:
        joined, refers = rows, F.lit(None).cast("long")
    members = joined.select("page_id", "url", "html", refers.alias("refers_to")).mapInArrow(_write_batches(level), "member binary")
    text = members.select(F.col("member").cast("string").alias("value"))
    text.write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(path)


class _Members:
    """Puts the pieces between magic bytes together to members.  Pieces come in file order.

    While a member is open, a second instance (``later``) reads the pieces after its start as if they
    began members of their own.  If the open member ends well those were parts of it; if it breaks,
    it is damaged, and what ``later`` found stands."""

    def __init__(self):
        self.head: list[bytes] = []  # pieces that begin no whole member
        self._close()

    def _close(self) -> None:
        self.raw: list[bytes] = []  # of a member that began here and has not ended yet
        self.content: list[bytes] = []
        self.inflate = self.later = None
        self.found: list[bytes] = []

    @property
    def open(self) -> bytes | None:
        return MAGIC + MAGIC.join(self.raw) if self.raw else None

    def add(self, piece: bytes) -> list[bytes]:
        """The contents of the members that end with this piece, or that it proves to be whole."""
        began = not self.raw
        if began:
            self.inflate = zlib.decompressobj(31)
        else:
            self.found += self.later.add(piece)
        try:
            self.content.append(self.inflate.decompress(MAGIC + piece))
            start = b"".join(self.content[:2])[:5] if len(self.content[0]) < 5 else self.content[0][:5]
            whole = self.inflate.eof
            broken = start != b"WARC/" and (start != b"" if whole else not b"WARC/".startswith(start))
        except zlib.error:
            whole, broken = False, True
        if broken:
            if began:
                self.head.append(piece)
                self._close()
                return []
            return self.give_up()
        if whole:
            content = b"".join(self.content)
            self._close()
            return [content]
        if began:
            self.later = _Members()
        self.raw.append(piece)
        return []

    def give_up(self) -> list[bytes]:
        """Drop the open member as damaged; what began after it takes its place."""
        found, later = self.found, self.later
        self.head += [self.raw[0], *later.head]  # they may belong to a member of the range before
        self.raw, self.content, self.inflate, self.later, self.found = later.raw, later.content, later.inflate, later.later, later.found
        return found

    def finish(self) -> list[bytes]:
        """No piece follows: whatever is still open is damaged."""
        out = []
        while self.raw:
            out += self.give_up()
        return out


def _read_batches(keep_payload: bool):
    def row(content: bytes) -> dict | None:
        return parse_record(content) | {"kind": 0} if content else None

    def run(batches):
        key, members, rows = None, _Members(), []

        def closed() -> list[dict]:
            if key is None:
                return []
            out = [{"kind": 1, "file": key[0], "start": key[1], "piece": i, "raw": x} for i, x in enumerate(members.head)]
            return out + ([{"kind": 2, "file": key[0], "start": key[1], "piece": 1 << 30, "raw": members.open}] if members.open is not None else [])

        def table(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema=_ARROW)

        for batch in batches:
            for value, file, start in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if (file, start) != key:
                    rows += closed()
                    key, members = (file, start), _Members()
                    if start == 0:  # what stands before a file's first magic: nothing
                        continue
                for content in members.add(value.as_py()):
                    parsed = row(content)
                    if parsed is None:
                        continue
                    if not keep_payload:
                        parsed["payload"] = None
                    rows.append(parsed)
                    if len(rows) >= (64 if keep_payload else 4096):
                        yield table(rows)
                        rows = []
        yield table(rows + closed())

    return run


_KINDS = "kind int, file string, start long, piece int, raw binary, "
_ARROW = pa.schema(
    [("kind", pa.int32()), ("file", pa.string()), ("start", pa.int64()), ("piece", pa.int32()), ("raw", pa.binary()), ("page_id", pa.int64()), ("url", pa.string()),
     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
)


def _rejoin(keep_payload: bool):
    """The fragments of one file: open ends meet the pieces at the head of the ranges after them."""

    def run(keys: tuple[pa.Scalar, ...], tab: pa.Table) -> pa.Table:
        members, whole = _Members(), []
        for x in sorted(tab.to_pylist(), key=lambda x: (x["start"], x["kind"], x["piece"])):
            for piece in x["raw"][len(MAGIC) :].split(MAGIC) if x["kind"] == 2 else [x["raw"]]:
                whole += members.add(piece)
        whole += members.finish()
        out = [parse_record(content) | ({} if keep_payload else {"payload": None}) for content in whole if content]
        return pa.Table.from_pylist(out, schema=pa.schema(list(_ARROW)[5:]))

    return run


def read_warc(spark: SparkSession, path: str, *, payload: bool = True) -> DataFrame:
    """Records below ``path``: see SCHEMA.  Without ``payload`` that column is null."""
    # the encoding only says how to read the separator; lines stay raw bytes
    lines = spark.read.option("encoding", "ISO-8859-1").option("lineSep", MAGIC.decode("latin-1")).text(path)
    pieces = lines.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    decoded = pieces.mapInArrow(_read_batches(payload), _KINDS + SCHEMA)
    if not payload:
        decoded = rt.materialize(decoded, "warc")
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    whole = decoded.where("kind = 0").select(*names)
    mended = decoded.where("kind > 0").select("file", "start", "kind", "piece", "raw").groupBy("file").applyInArrow(_rejoin(payload), SCHEMA)
    return whole.unionByName(mended)


def op7(spark, sf_dir: str) -> DataFrame:
    path = rt.scratch_path(spark, "warc")
    write_warc(rt.table(spark, sf_dir, "pages"), path)
    return read_warc(spark, path, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
