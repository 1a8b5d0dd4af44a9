"""WARC archives: written by Spark tasks, read back in byte ranges that need no index.

Every record is a gzip member of its own, so an archive is a run of members. Tasks read byte ranges of the
files through Spark's text source with the gzip magic as delimiter: a task gets what lies behind each magic in
its range, up to the next one, also beyond the range. A piece starts a member if it decodes as gzip and the
decoded bytes start as a WARC header does; a magic that turns up inside compressed data does neither, and is put
back into its member. A task owns the members that start in its range. Only where such a chance magic lies
behind the end of a range does a member reach into the next task: the two ends then leave the tasks as fragments
and are joined in file order, one record in memory at a time. All reading and writing goes through Spark's own
sources, so archives may lie in any store that Spark reaches.

``write_warc`` writes a page as a response record, or as a revisit record without the payload if an equal
payload of at least ``least_bytes`` bytes belongs to a smaller page id (null ids come last; of rows that repeat
id and payload one is the response). Null html is the empty payload; a null url leaves the target out. An empty
table gives an archive without records, which reads back as an empty table. Payloads are equal if SHA-256 and
length are. Other columns are not read. A record, header and payload, has to fit into a task's memory; a damaged
member or a payload that differs from its digest fails the read. Names that end in ``.gz`` are decoded by Spark
before the reader sees them: archives need another name.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from functools import partial
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm.common import ROW, as_bytes, save, small_batches

#: Fixed values of the formats: gzip magic with its only method, an empty member, the revisit profile.
MAGIC = b"\x1f\x8b\x08"
GZIP = 31
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
RECORD = ("record_id string, record_type string, target_uri string, refers_to string, payload_bytes long, "
          "payload_digest string, payload binary")
_SCANNED = "file string, start long, head binary, tail binary, closed boolean, record struct<" + \
    RECORD.replace(" ", ":").replace(",:", ",") + ">"
OUT_BYTES = 8 << 20


# ---- writing ---------------------------------------------------------------------------------

def member(data: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, GZIP)
    return z.compress(data) + z.flush()


def _record(kind: str, record_id: str, uri: str | None, digest: str, length: int, date: str, payload: bytes = b"",
            refers: str | None = None) -> bytes:
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length + payload
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {date}"]
    if uri is not None:
        lines.append("WARC-Target-URI: " + quote(uri, safe=":/?#[]@!$&'()*+,;=%-._~"))
    if refers is not None:
        lines += [f"WARC-Refers-To: {refers}", f"WARC-Profile: {PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response",
              f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _name(page_id, row: int) -> str:
    return f"<urn:page:{'' if page_id is None else quote(str(page_id), safe='')}:{row}>"


def page_of(record_id: Column) -> Column:
    """The page id in a record id of write_warc(), as text; null for a page without id."""
    return F.nullif(F.regexp_extract(record_id, r"^<urn:page:(.*):\d+>$", 1), F.lit(""))


def _line(data: bytes) -> bytes:
    """A member without its last byte, which is 0 and is what the text writer ends a line with.

    The last byte is the highest of the decoded size; where it is not 0, an empty member follows.
    """
    packed = member(data)
    return (packed if packed[-1] == 0 else packed + member(b""))[:-1]


def _response_batches(batches, date: str):
    import pyarrow as pa

    for batch in small_batches(batches, 256):
        page, uri, row = (batch[c].to_pylist() for c in ("page_id", "url", ROW))
        html = as_bytes(batch["html"])
        digest = [base64.b32encode(hashlib.sha1(h).digest()).decode() for h in html]
        lines = [_line(_record("response", _name(p, r), u, d, len(h), date, h))
                 for p, u, r, d, h in zip(page, uri, row, digest, html, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch[ROW], batch["page_id"], batch["url"], pa.array(digest, pa.string()),
             pa.array([hashlib.sha256(h).digest() for h in html], pa.binary()),
             pa.array([len(h) for h in html], pa.int64()), pa.array(lines, pa.binary())],
            [ROW, "page_id", "url", "digest", "key", "length", "line"])


def _revisit_batches(batches, date: str):
    import pyarrow as pa

    for batch in batches:
        lines = [_line(_record("revisit", _name(r["page_id"], r[ROW]), r["url"], r["digest"], r["length"], date,
                               refers=_name(r["first_id"], r["first_row"]))) for r in batch.to_pylist()]
        yield pa.RecordBatch.from_arrays([batch[ROW], pa.array(lines, pa.binary())], [ROW, "line"])


def write_warc(pages: DataFrame, path: str, least_bytes: int = 0, date: str = DATE) -> None:
    """Write page_id, url and html of ``pages`` as the archive ``path``, a folder of files; see the module."""
    kind = dict(pages.dtypes)["page_id"]
    rows = pages.select(F.monotonically_increasing_id().alias(ROW), "page_id", F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    rows = save(rows.mapInArrow(partial(_response_batches, date=date),
                                f"{ROW} long, page_id {kind}, url string, digest string, key binary, length long, line binary"),
                "warc-responses", compression="uncompressed")
    first = F.min(F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", ROW)).alias("first")
    groups = rows.where(F.col("length") >= least_bytes).groupBy("key", "length") \
        .agg(first, F.count(F.lit(1)).alias("n")).where(F.col("n") > 1) \
        .select("key", "length", F.col("first.page_id").alias("first_id"), F.col(f"first.{ROW}").alias("first_row"))
    again = rows.drop("line").join(groups, ["key", "length"]).where(F.col(ROW) != F.col("first_row"))
    again = save(again.mapInArrow(partial(_revisit_batches, date=date), f"{ROW} long, line binary"), "warc-revisits")
    rows.select(ROW, "line").join(again.select(ROW), ROW, "left_anti").unionByName(again) \
        .select(F.col("line").cast("string").alias("value")).write.option("lineSep", "\x00").text(path)


# ---- reading ---------------------------------------------------------------------------------

def _records(data: bytes, payloads: bool) -> list[dict]:
    """The records of one decoded member."""
    out, at = [], 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or end < 0:
            raise ValueError("no WARC header where a record should start")
        head = dict(line.partition(":")[::2] for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:])
        head = {k.strip().lower(): v.strip() for k, v in head.items()}
        size = int(head["content-length"])
        block = data[end + 4:end + 4 + size]
        if len(block) != size:
            raise ValueError("a record ends before its content does")
        at = end + 4 + size
        at += 4 if data.startswith(b"\r\n\r\n", at) else 0
        payload, length = block, size
        if head.get("content-type", "").startswith("application/http"):
            http, _, payload = block.partition(b"\r\n\r\n")
            sizes = [int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
            length = len(payload)
        kind, said = head.get("warc-type"), head.get("warc-payload-digest", "").removeprefix("sha1:") or None
        digest = said
        if kind == "revisit":
            length = sizes[0] if head.get("content-type", "").startswith("application/http") and sizes else None
        else:
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if said is not None and said != digest:
                raise ValueError(f"record {head.get('warc-record-id')}: the payload differs from its digest")
        uri = head.get("warc-target-uri")
        out.append({"record_id": head.get("warc-record-id"), "record_type": kind,
                    "target_uri": None if uri is None else unquote(uri), "refers_to": head.get("warc-refers-to"),
                    "payload_bytes": length, "payload_digest": digest,
                    "payload": payload if payloads and kind != "revisit" else None})
    return out


class _Candidate:
    """Bytes behind a magic: decoded as they come, and taken for a member once they decode to a WARC header."""

    def __init__(self):
        self.raw, self.text, self.z = [], b"", zlib.decompressobj(GZIP)

    def feed(self, piece: bytes) -> bool:
        """False if this cannot be a member; what began as a record must not break off."""
        self.raw.append(piece)
        try:
            more = self.z.decompress(piece)
        except zlib.error:
            if self.known:
                raise ValueError("a member is damaged") from None
            return False
        self.text = self.text + more if len(self.text) < 5 else self._long(more)
        return b"WARC/".startswith(self.text[:5]) and not (self.z.eof and self.z.unused_data)

    def _long(self, more: bytes):
        buffer = self.text if isinstance(self.text, bytearray) else bytearray(self.text)
        buffer += more
        return buffer

    @property
    def known(self) -> bool:
        return len(self.text) >= 5

    @property
    def done(self) -> bool:
        return self.z.eof


class _Range:
    """What one task finds in one byte range of one file."""

    def __init__(self, file: str, start: int):
        self.file, self.start, self.head, self.open, self.closed, self.pieces = file, start, [], None, False, 0

    def take(self, piece: bytes) -> bytes | None:
        """The decoded member that this piece completes, if it does."""
        self.pieces += 1
        if self.pieces == 1 and self.start == 0:
            if piece:
                raise ValueError(f"{self.file} does not start with a gzip member")
            return None
        piece = MAGIC + piece
        self.open = self.open or _Candidate()
        if not self.open.feed(piece):
            if self.closed:
                raise ValueError(f"{self.file}: bytes between members")
            self.head += self.open.raw
            self.open = None
        elif self.open.done:
            text, self.open, self.closed = bytes(self.open.text), None, True
            return text
        return None

    def fragment(self) -> dict | None:
        rest = self.open.raw if self.open else []
        if not self.closed:
            self.head, rest = self.head + rest, []
        if not self.head and not rest:
            return None
        return {"file": self.file, "start": self.start, "head": b"".join(self.head), "tail": b"".join(rest),
                "closed": self.closed, "record": None}


def _flush(rows: list[dict], schema):
    import pyarrow as pa

    return pa.RecordBatch.from_pylist(rows, schema)


def _limited(rows, schema):
    """Rows in batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        record = row.get("record") or row
        size += 500 + sum(len(row.get(c) or b"") for c in ("head", "tail")) + len(record.get("payload") or b"")
        if size > OUT_BYTES:
            yield _flush(held, schema)
            held, size = [], 0
    if held:
        yield _flush(held, schema)


def _arrow_schema(of: str):
    import pyarrow as pa

    record = [("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
              ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
              ("payload", pa.binary())]
    if of == "record":
        return pa.schema(record)
    return pa.schema([("file", pa.string()), ("start", pa.int64()), ("head", pa.binary()), ("tail", pa.binary()),
                      ("closed", pa.bool_()), ("record", pa.struct(record))])


def _scan_batches(batches, payloads: bool):
    def found():
        here = None
        for batch in batches:
            columns = (batch[c] for c in ("file", "start", "piece"))
            for file, start, piece in zip(*columns, strict=True):
                file, start = file.as_py(), start.as_py()
                if here is None or (here.file, here.start) != (file, start):
                    if here is not None and (rest := here.fragment()):
                        yield rest
                    here = _Range(file, start)
                text = here.take(piece.as_py())
                if text is not None:
                    for record in _records(text, payloads):
                        yield {"record": record}
        if here is not None and (rest := here.fragment()):
            yield rest

    yield from _limited(found(), _arrow_schema("scanned"))


def _joined_batches(batches, payloads: bool):
    """Fragments in file order -> the records that lie across ranges."""
    def parsed(file, data):
        while data:
            z = zlib.decompressobj(GZIP)
            try:
                text = z.decompress(data)
            except zlib.error:
                raise ValueError(f"{file}: a member is damaged") from None
            if not z.eof:
                raise ValueError(f"{file}: a member breaks off")
            data = z.unused_data
            yield from _records(text, payloads)

    def found():
        file, pending = None, b""
        for batch in batches:
            for row in batch.to_pylist():
                if row["file"] != file:
                    yield from parsed(file, pending)
                    file, pending = row["file"], b""
                pending += row["head"]
                if row["closed"]:
                    yield from parsed(file, pending)
                    pending = row["tail"]
        yield from parsed(file, pending)

    yield from _limited(found(), _arrow_schema("record"))


def read_warc(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of the archive ``path``: ids, type, target, payload size and digest, and the payload if asked for.

    A revisit has the size and digest of the payload it stands for, and never a payload.
    """
    pieces = spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path) \
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                F.col("value").cast("binary").alias("piece"))
    scanned = save(pieces.mapInArrow(partial(_scan_batches, payloads=payloads), _SCANNED), "warc-scanned")
    across = scanned.where(F.col("record").isNull()).select("file", "start", "head", "tail", "closed") \
        .repartition("file").sortWithinPartitions("file", "start") \
        .mapInArrow(partial(_joined_batches, payloads=payloads), RECORD)
    return scanned.where(F.col("record").isNotNull()).select("record.*").unionByName(across)


def page_records(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the records of write_warc()."""
    return records.select(page_of(F.col("record_id")).cast("long").alias("page_id"), "payload_bytes", "payload_digest",
                          "record_type", page_of(F.col("refers_to")).cast("long").alias("refers_to"))
