"""WARC archives: a record to a gzip member, and a reader that splits archives at any byte.

Archives are written and read through Spark's text source, which hands bytes on as they are: the
writer's rows are whole runs of gzip members, and the reader takes the gzip magic for the line separator, so
every task scans its own byte range for it and owns what starts there.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saltmarsh.llm.skew import join_keyed
from saltmarsh.session import cut_lineage, scratch_path

MAGIC = b"\x1f\x8b\x08"  # fixed value: first bytes of a gzip member
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value
LEAST = 1000  # payloads of fewer bytes are never revisits
RUN = 4 << 20  # compressed bytes in one row that is written
_OUTSIDE = re.compile(r"[^\x21-\x7e]")
_RECORD = "record_id string, record_type string, target_uri string, date string, refers_to string, payload_bytes long, payload_digest string, payload binary"
_FIELDS = [f.split(" ")[0] for f in _RECORD.split(", ")]


def page_urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _member(page_id, url, body: bytes, refers_to, date: str) -> bytes:
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    block = http if revisit else http + body
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {page_urn(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + _OUTSIDE.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url))
    head.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(hashlib.sha1(body).digest()).decode()}")
    if revisit:
        head += [f"WARC-Refers-To: {page_urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    record = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    member = gzip.compress(record, 6, mtime=0)
    # The last byte of a member is the highest of its length; it must be zero, see _members.
    return member if len(record) < 1 << 24 else member + gzip.compress(b"", mtime=0)


def _members(date: str):
    """Rows of whole members without their last byte, a zero, which the text writer puts back as its line separator."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for row in zip(*[batch.column(k) for k in range(4)]):
                page_id, url, body, refers_to = (x.as_py() for x in row)
                held.append(_member(page_id, url, body, refers_to, date))
                size += len(held[-1])
                if size >= RUN:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], ["run"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], ["run"])

    return run


def write_warc(pages: DataFrame, path: str, least: int = LEAST, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write every row of ``pages`` (page_id, url, html) as a record of gzipped WARC files in the folder ``path``.

    The payload is the html in UTF-8; null is empty. Of the rows with equal payloads of ``least`` bytes or more those of the
    largest page_id are responses (several, if rows repeat it) and the others revisits that refer to it. Rows without
    a page_id have a record id without one; among equal payloads of which no row has an id, all are responses.
    A null url gives no target. Other columns are not read. An empty table gives archives without records.

    Only payload hashes are grouped; they are counted before the shuffle, and copies that are frequent join by broadcast
    of a bounded table. The bodies are shuffled only if more than ``skew.MOST`` payloads occur more than once.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("body")
    )
    rows = rows.withColumn("same", F.when(F.length("body") >= least, F.sha2("body", 256)))
    copies = rows.where("same IS NOT NULL").groupBy("same").agg(F.max("id").alias("kept"), F.count("*").alias("n")).where("n > 1")
    rows = join_keyed(rows, cut_lineage(copies), ["same"], "n")
    refers = F.when(~F.col("id").eqNullSafe(F.col("kept")), F.col("kept"))
    runs = rows.select("id", "url", "body", refers.alias("refers")).mapInArrow(_members(date), "run binary")
    runs.select(F.col("run").cast("string").alias("value")).write.option("lineSep", "\x00").text(path)


def _fields(head: bytes) -> dict[str, str]:
    lines = re.sub(rb"\r\n[ \t]+", b" ", head).split(b"\r\n")[1:]
    pairs = [x.partition(b":") for x in lines if b":" in x]
    return {k.strip().lower().decode("latin-1"): v.strip().decode("utf-8", "replace") for k, _, v in pairs}


def _digest(text: str | None) -> str | None:
    """The hex form of a ``sha1:`` header in base 32 or in hex."""
    if not text or not text.lower().startswith("sha1:"):
        return None
    value = text[5:].strip()
    try:
        return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()
    except ValueError:
        return None


def _broken(raw: bytes) -> tuple:
    return None, "broken", None, None, None, len(raw), None, None


def parse_record(data: bytes) -> tuple:
    """One decoded member as a row: record_id, record_type, target_uri, date, refers_to, payload_bytes, payload_digest, payload.

    Of a response the payload is what follows the HTTP header, and its digest is computed; a revisit has no payload, and
    length and digest are those its headers give. Other records keep their block. A record whose length does
    not match is ``broken``.
    """
    head, blank, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    length = fields.get("content-length", "")
    if not blank or not length.isdigit() or len(rest) < int(length):
        return _broken(data)
    block, kind = rest[: int(length)], fields.get("warc-type")
    size, digest, payload = None, None, block
    if fields.get("content-type", "").lower().startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        given = _fields(http).get("content-length", "")
        size = int(given) if given.isdigit() else None
    if kind == "revisit":
        digest, payload = _digest(fields.get("warc-payload-digest")), None
    else:
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    return fields.get("warc-record-id"), kind, fields.get("warc-target-uri"), fields.get("warc-date"), fields.get("warc-refers-to"), size, digest, payload


class Member:
    """A candidate member: bytes from a gzip magic on, decoded as far as they reach."""

    def __init__(self):
        self.raw, self.out, self.inflate, self.complete = [], [], zlib.decompressobj(31), False

    def feed(self, data: bytes) -> bool:
        """Go on with ``data``; False if it can't be a member that holds a record, or nothing."""
        try:
            out = self.inflate.decompress(data)
        except zlib.error:
            return False
        self.raw.append(data)
        self.out.append(out)
        self.complete = self.inflate.eof
        start = b"".join(self.out[:8])[:5]
        return start == b"WARC/"[: len(start)] and not (self.complete and 0 < len(start) < 5)

    def record(self) -> list[tuple]:
        data = b"".join(self.out)
        return [parse_record(data)] if data else []


class Assembler:
    """Records from the pieces between magics of one byte range, in order.

    A magic inside a member, by chance or in stored bytes, cuts the member into pieces; they are put together again because
    the member goes on until its own end. What is left at the borders of the range are ``fragments``: pieces
    before the first member that starts here, and a last member that has not ended.
    """

    def __init__(self):
        self.now, self.started, self.fragments = None, False, []

    def feed(self, data: bytes) -> list[tuple]:
        if self.now is None:
            return self._open(data)
        if self.now.feed(data):
            if not self.now.complete:
                return []
            found, self.now, self.started = self.now.record(), None, True
            return found
        return self.flush() + self.feed(data)

    def flush(self) -> list[tuple]:
        """Give up what is open: no member, or a damaged one. The pieces after its first may be members of their own."""
        failed, self.now, found = self.now, None, []
        if failed is None:
            return found
        if any(failed.out):
            found.append(_broken(b"".join(failed.raw)))
            self.started = True
        elif not self.started:
            self.fragments.append(("head", failed.raw[0]))
        for piece in failed.raw[1:]:
            found += self.feed(piece)
        return found

    def _open(self, data: bytes) -> list[tuple]:
        member = Member()
        if not member.feed(data):
            if not self.started:
                self.fragments.append(("head", data))
        elif member.complete:
            self.started = True
            return member.record()
        else:
            self.now = member
        return []

    def end(self) -> None:
        """The pieces of a last open member: the range's own (``tail``) if one before it was, else maybe of one that began earlier."""
        for k, piece in enumerate(self.now.raw if self.now is not None else []):
            self.fragments.append(("tail" if self.started and not k else "more", piece))


def _batch(records: list, fragments: list, payloads: bool) -> pa.RecordBatch:
    """Rows of records, then of fragments (file, block, seq, kind, raw)."""
    cut = len(_FIELDS) if payloads else len(_FIELDS) - 1
    rows = [r[:cut] + (None,) * 5 for r in records] + [(None,) * cut + f for f in fragments]
    kinds = [pa.string()] * 5 + [pa.int64(), pa.string()] + ([pa.binary()] if payloads else []) + [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], [*_FIELDS[:cut], "file", "block", "seq", "kind", "raw"])


def _scan(payloads: bool):
    """Records of the pieces (piece, file, block) of byte ranges, with the fragments at their borders."""

    def run(batches):
        at, parts, records, size = None, None, [], 0

        def closed():
            if at is None:
                return []
            parts.end()
            return [(*at, k, kind, raw) for k, (kind, raw) in enumerate(parts.fragments)]

        for batch in batches:
            for piece, file, block in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = piece.as_py()
                fresh = (file, block) != at
                if fresh:
                    if left := closed():
                        yield _batch([], left, payloads)
                    at, parts = (file, block), Assembler()
                if fresh and not block:
                    continue  # what stands before the first magic of a file
                got = parts.feed(MAGIC + data)
                records += got
                size += 500 * len(got) + (sum(len(r[-1] or b"") for r in got) if payloads else 0)
                if size >= RUN:
                    yield _batch(records, [], payloads)
                    records, size = [], 0
        yield _batch(records, closed(), payloads)

    return run


def _mend(payloads: bool):
    """The members that go over the border of a byte range, from the fragments of one file."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*[table.column(c).to_pylist() for c in ("block", "seq", "kind", "raw")]))
        parts, found = Assembler(), []
        for _, _, kind, raw in rows:
            if kind == "tail":
                while parts.now is not None:
                    found += parts.flush()
            found += parts.feed(raw)
        while parts.now is not None:
            found += parts.flush()
        return pa.Table.from_batches([_batch(found, [], payloads).select(_FIELDS[: len(_FIELDS) if payloads else -1])])

    return run


def _pieces_of_files(batches):
    for batch in batches:
        for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            pieces, size, held = content.as_py().split(MAGIC), 0, []
            for k, p in enumerate(pieces):
                held.append(p)
                size += len(p)
                if size >= RUN or k == len(pieces) - 1:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary()), pa.array([file] * len(held)), pa.array([0] * len(held), pa.int64())], ["piece", "file", "block"])
                    size, held = 0, []


def read_warc(spark: SparkSession, path: str, payloads: bool = True, split: bool = True) -> DataFrame:
    """Every record of the gzipped WARC files at ``path``: see :func:`parse_record`; without ``payloads`` their bytes are left out.

    Tasks scan byte ranges (``spark.sql.files.maxPartitionBytes``) for the gzip magic. A candidate counts if its gzip header and
    data decode and what comes out begins as a WARC record; a magic inside a member fails that test and is put
    back into its member. A member belongs to the range in which it starts; the few that a false
    magic keeps open at the end of a range are finished from the fragments of their file. Empty members are
    skipped, members that do not end or whose length is wrong give a row of type ``broken`` with the number of
    bytes, and bytes that are no member are ignored. A folder of files without records gives no rows.

    Spark unpacks files whose names end in ``.gz`` by itself, as one stream; read those with ``split=False``: a task to a file.
    """
    if split:
        pieces = spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
        pieces = pieces.select(F.col("value").cast("binary").alias("piece"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    else:
        pieces = spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(_pieces_of_files, "piece binary, file string, block long")
    fields = _RECORD if payloads else _RECORD.rpartition(", ")[0]
    found = cut_lineage(pieces.mapInArrow(_scan(payloads), f"{fields}, file string, block long, seq long, kind string, raw binary"))
    records = found.where("kind IS NULL").drop("file", "block", "seq", "kind", "raw")
    open_ends = found.where("kind IS NOT NULL").select("file", "block", "seq", "kind", "raw")
    if open_ends.where("kind <> 'head'").isEmpty():
        return records
    return records.unionByName(open_ends.groupBy("file").applyInArrow(_mend(payloads), fields))


def page_records(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Write ``pages`` to archives below the shared folder and return what they hold: page_id, payload_bytes, payload_digest
    (hex), record_type and refers_to, a row per page."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_warc(pages, path, least)
    read = read_warc(spark, path, payloads=False)

    def page(c):
        return F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(-?[0-9]*)>$', 1) AS bigint)")

    return read.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))
